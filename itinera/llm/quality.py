"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover it whole.  Bytes are embedded,
learned filters slide over each chunk, every filter is max-pooled per chunk,
and the mean and the maximum over all chunks feed one logistic unit.  The
network is trained here, on the driver, on a bounded sample of labelled rows
(``TRAIN_ROWS`` rows of each label, ``TRAIN_CHUNKS`` chunks of each, spread
over the whole text); scoring always reads every chunk.  The sample's bounds
change the ratio of the labels, so the output bias is shifted back to the
ratio of all learnable labels: the same text scores alike at every size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import is_held_out, may_learn, table

CHUNK, STEP = 512, 384            # bytes of a chunk, and from one chunk's start to the next
WIDTH, STRIDE, EMB, FILTERS = 16, 2, 6, 24
TRAIN_ROWS = (1500, 4500)         # at most, of label 0 and of label 1
TRAIN_CHUNKS, EPOCHS = 6, 6
ACCEPT = 0.7


def chunks_of(text: str | None) -> np.ndarray:
    """(n, CHUNK) bytes; the last chunk is padded with zeros, empty text is one chunk of zeros."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-max(0, len(raw) - CHUNK) // STEP) + 1)
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[:len(raw)] = raw
    return sliding_window_view(padded, CHUNK)[::STEP]


class ByteCNN:
    """Parameters: byte embedding, filters with bias, output weights with bias."""

    def __init__(self, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.p = {
            "emb": rng.normal(0, 0.5, (256, EMB)), "conv": rng.normal(0, 0.2, (WIDTH * EMB, FILTERS)),
            "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.1, 2 * FILTERS), "c": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        flat = self.p["emb"][chunks].reshape(len(chunks), CHUNK * EMB)
        return np.ascontiguousarray(sliding_window_view(flat, WIDTH * EMB, axis=1)[:, ::STRIDE * EMB])

    def pooled(self, chunks: np.ndarray, keep: bool = False):
        """Max-pooled filter outputs (n, FILTERS); with keep also the argmax and its windows."""
        win = self.windows(chunks)
        z = (win.reshape(-1, WIDTH * EMB) @ self.p["conv"]).reshape(len(chunks), -1, FILTERS)
        if not keep:
            return np.maximum(z.max(axis=1) + self.p["bias"], 0)
        at = z.argmax(axis=1)
        h = np.maximum(np.take_along_axis(z, at[:, None, :], 1)[:, 0] + self.p["bias"], 0)
        return h, at, win[np.arange(len(chunks))[:, None], at]

    def logits(self, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = np.diff(np.append(starts, len(h)))[:, None]
        doc = np.concatenate([np.add.reduceat(h, starts) / n, np.maximum.reduceat(h, starts)], axis=1)
        return doc @ self.p["out"] + self.p["c"]

    def scores(self, texts, block: int = 256) -> np.ndarray:
        """Probability of label 1 for each text, over all of its chunks."""
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            chunks = chunks_of(text)
            total, most = np.zeros(FILTERS), np.zeros(FILTERS)
            for at in range(0, len(chunks), block):
                h = self.pooled(chunks[at:at + block])
                total += h.sum(axis=0)
                most = np.maximum(most, h.max(axis=0))
            z = np.concatenate([total / len(chunks), most]) @ self.p["out"] + self.p["c"][0]
            out[i] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return np.round(out, 6)

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 32,
            rate: float = 0.01, seed: int = 5) -> None:
        """Adam on the log loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), batch):
                pick = order[at:at + batch]
                step += 1
                grads = self.gradients([docs[i] for i in pick], labels[pick])
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                                  / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)

    def gradients(self, docs: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        sizes = np.array([len(d) for d in docs])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        chunks = np.concatenate(docs)
        seg = np.repeat(np.arange(len(docs)), sizes)
        h, at, win = self.pooled(chunks, keep=True)
        top = np.maximum.reduceat(h, starts)
        feats = np.concatenate([np.add.reduceat(h, starts) / sizes[:, None], top], axis=1)
        d = (1 / (1 + np.exp(-np.clip(feats @ self.p["out"] + self.p["c"], -40, 40))) - y) / len(docs)
        d_feat = d[:, None] * self.p["out"][None, :]
        is_top = h == top[seg]
        share = is_top / np.maximum(np.add.reduceat(is_top.astype(np.float32), starts), 1)[seg]
        dh = (d_feat[seg, :FILTERS] / sizes[seg][:, None] + d_feat[seg, FILTERS:] * share) * (h > 0)
        d_win = dh[:, :, None] * self.p["conv"].T[None]          # (n, filters, WIDTH*EMB)
        places = at[:, :, None] * STRIDE + np.arange(WIDTH)
        at_byte = chunks[np.arange(len(chunks))[:, None, None], places]
        d_emb = np.zeros_like(self.p["emb"])
        np.add.at(d_emb, at_byte.reshape(-1), d_win.reshape(-1, EMB))
        return {"emb": d_emb, "conv": np.einsum("nf,nfw->wf", dh, win), "bias": dh.sum(0),
                "out": feats.T @ d, "c": d.sum(keepdims=True)}


def learnable(labels: DataFrame, label_col: str) -> DataFrame:
    """doc_id and its label y, for every id that may be learned from."""
    return (labels.filter(may_learn(F.col("doc_id")) & F.col(label_col).isin(0, 1))
            .groupBy("doc_id").agg(F.min(label_col).cast("int").alias("y")))


def prior_shift(one: DataFrame, most: tuple[int, int]) -> float:
    """Log odds of label 1 over all learnable ids less those in the bounded sample."""
    n = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    over = [np.log(n[y] / min(n[y], most[y])) for y in (0, 1)]
    return float(over[1] - over[0])


def training_rows(docs: DataFrame, one: DataFrame, most: tuple[int, int]) -> DataFrame:
    """The bounded training sample: for each label at most that many ids, lowest in hash order,
    and of an id's texts the one of the smallest hash (null counts as empty)."""
    picks = [one.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in enumerate(most)]
    sample = picks[0].unionByName(picks[1])
    text = F.coalesce("text", F.lit(""))
    return (docs.filter(may_learn(F.col("doc_id"))).select("doc_id", text.alias("text"))
            .join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")))   # at most sum(most) rows


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
          most: tuple[int, int] = TRAIN_ROWS) -> ByteCNN | float:
    """The network; the share of label 1 if only one label is known, 1.0 if none."""
    @F.pandas_udf("binary")
    def some_chunks(texts: pd.Series) -> pd.Series:
        def spread(t):
            c = chunks_of(t)
            return c[np.unique(np.linspace(0, len(c) - 1, TRAIN_CHUNKS).round().astype(int))].tobytes()
        return texts.map(spread)

    one = learnable(labels, label_col)
    rows = (training_rows(docs, one, most)
            .select("doc_id", "y", some_chunks("text").alias("chunks"))
            .toPandas().sort_values(["doc_id", "chunks"]))
    y = rows["y"].to_numpy(np.float32)
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 1.0
    net = ByteCNN()
    net.fit([np.frombuffer(c, np.uint8).reshape(-1, CHUNK) for c in rows["chunks"]], y)
    net.p["c"] += np.float32(prior_shift(one, most))
    return net


def with_quality(docs: DataFrame, model: ByteCNN | float, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``name`` (null text counts as empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        net = shared.value
        if isinstance(net, float):
            return pd.Series(np.full(len(texts), net))
        return pd.Series(net.scores(texts.tolist()))

    return docs.withColumn(name, score(F.coalesce(F.col("text"), F.lit(""))))


def classify_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null and empty texts get the score of an empty chunk; repeated rows and ids
    are scored row by row; an empty table gives no rows; without labels every
    score is 1.0 (nothing is rejected).  Only doc_id and text are read.
    """
    scored = with_quality(docs.select("doc_id", "text"), train(docs, labels, label_col))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose score reaches ``ACCEPT``, with the columns they had."""
    name = next(c for i in range(99) if (c := f"quality_score_{i}") not in docs.columns)
    return (with_quality(docs, train(docs, labels), name)
            .filter(F.col(name) >= ACCEPT).drop(name))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
