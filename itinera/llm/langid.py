"""Language identification.

Character n-grams (1 to 3 code points, hashed to ``DIMS`` features) are weighted
by TF-IDF; a sparse multinomial logistic regression is trained by
follow-the-regularised-leader with elastic-net penalties; a temperature fitted
on rows left out of the training calibrates the probabilities.

Document frequencies cover every learnable document (one distributed pass, at
most ``DIMS`` sums).  The regression is fitted on a bounded sample
(``TRAIN_PER_LANG`` ids of each language, one text of each id), so the driver
takes that many rows times the number of languages.  It is sized for up to 50
languages; every language of the table is learned, however many there are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itinera.llm.common import is_held_out, may_learn, table

DIMS = 1 << 15
TRAIN_PER_LANG, EPOCHS = 800, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
PIECE = 1 << 20                       # code points hashed at a time


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and how often each occurs in the whole text."""
    total = np.zeros(DIMS, np.int64)
    for at in range(0, len(text), PIECE):
        c = np.frombuffer(text[at:at + PIECE + 2].lower().encode("utf-32-le", "replace"), np.uint32)
        own = min(len(c), PIECE)
        h = np.zeros(len(c), np.uint32)
        for n in range(1, 4):
            if len(c) < n:
                break
            h = h[:len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1:]
            x = (h[:own] ^ np.uint32(n * 0x3C6EF372)) * np.uint32(0x9E3779B1)
            x ^= x >> np.uint32(15)
            total += np.bincount((x * np.uint32(0x85EBCA77)) >> np.uint32(17), minlength=DIMS)
    at = np.flatnonzero(total)
    return at.astype(np.int32), total[at]


def weighted(idx: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(counts)) * idf[idx]
    return v / max(1e-12, np.sqrt((v * v).sum()))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_lang: int, seed: int = 3) -> np.ndarray:
    """FTRL-proximal with elastic net; returns sparse weights as a (DIMS + 1, n_lang) array
    whose last row is the bias."""
    z, n = np.zeros((DIMS + 1, n_lang)), np.zeros((DIMS + 1, n_lang))

    def current(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for r in rng.permutation(len(rows)):
            idx, val = rows[r]
            idx, val = np.append(idx, DIMS), np.append(val, 1.0)
            w = current(idx)
            p = softmax(val @ w)
            p[y[r]] -= 1
            g = val[:, None] * p[None, :]
            root = np.sqrt(n[idx])
            n[idx] += g * g
            z[idx] += g - (np.sqrt(n[idx]) - root) / ALPHA * w
    return current(np.arange(DIMS + 1))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature in 0.05 .. 20 with the least log loss (golden-section search on its logarithm)."""
    if not len(y):
        return 1.0

    def loss(t):
        return -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-300).mean()

    low, high, gold = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - gold * (high - low), low + gold * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class LanguageModel:
    def __init__(self, langs, idf, weights, heat):
        self.langs, self.idf, self.weights, self.heat = langs, idf, weights, heat

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not LETTER.search(text):
            return UNKNOWN, 0.0
        idx, counts = ngram_counts(text)
        z = weighted(idx, counts, self.idf) @ self.weights[idx] + self.weights[DIMS]
        p = softmax(z / self.heat)
        best = int(p.argmax())
        return self.langs[best], round(float(p[best]), 6)


def training_texts(rows: DataFrame, per_lang: int) -> DataFrame:
    """doc_id, lang, text: of each language at most ``per_lang`` ids, lowest in hash order,
    and of an id's texts the one of the smallest hash."""
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (rows.select("doc_id", "lang").distinct().withColumn("rn", F.row_number().over(w))
              .filter(F.col("rn") <= per_lang).select("doc_id", "lang"))
    return (rows.join(F.broadcast(picked), ["doc_id", "lang"])            # per_lang ids of each language at most
            .groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text")))


def train(docs: DataFrame, per_lang: int = TRAIN_PER_LANG) -> LanguageModel:
    """Learn from rows with a language whose id is known and not held out."""
    rows = (docs.filter(may_learn(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select("doc_id", "text", "lang"))

    def frequencies(batches):
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                df[ngram_counts(text)[0]] += 1
                n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"i": np.append(at, -1), "n": np.append(df[at], n)})

    df = (rows.select("text").mapInPandas(frequencies, "i long, n long")
          .groupBy("i").agg(F.sum("n").alias("n")).toPandas())           # at most DIMS + 1 rows
    n_docs = int(df.loc[df["i"] < 0, "n"].sum())
    idf = np.full(DIMS, np.log(1 + n_docs) + 1)
    known = df[df["i"] >= 0]
    idf[known["i"].to_numpy(int)] = np.log((1 + n_docs) / (1 + known["n"].to_numpy(float))) + 1

    @F.pandas_udf("i binary, c binary")
    def features(texts: pd.Series) -> pd.DataFrame:
        found = [ngram_counts(t) for t in texts]
        return pd.DataFrame({"i": [i.tobytes() for i, _ in found], "c": [c.tobytes() for _, c in found]})

    sample = (training_texts(rows, per_lang)
              .select("doc_id", "lang", features("text").alias("f")).select("doc_id", "lang", "f.i", "f.c")
              .toPandas().sort_values(["doc_id", "i"]))
    langs = sorted(sample["lang"].unique())
    if not langs:
        return LanguageModel([], idf, np.zeros((DIMS + 1, 0)), 1.0)
    y = sample["lang"].map({v: i for i, v in enumerate(langs)}).to_numpy(int)
    vecs = []
    for i, c in zip(sample["i"], sample["c"]):
        idx = np.frombuffer(i, np.int32)
        vecs.append((idx, weighted(idx, np.frombuffer(c, np.int64), idf)))
    left_out = np.arange(len(y)) % 5 == 4
    weights = ftrl([v for v, out in zip(vecs, left_out) if not out], y[~left_out], len(langs))
    logits = np.array([v @ weights[i] + weights[DIMS] for (i, v), out in zip(vecs, left_out) if out])
    heat = temperature(logits, y[left_out]) if left_out.any() else 1.0
    return LanguageModel(langs, idf, weights.astype(np.float32), heat)


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0, and so is
    everything if no language was learned.  Repeated rows are predicted row by
    row; an empty table gives no rows; further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return (docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
