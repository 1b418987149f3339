"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over a model's pieces finds, in one pass over the
text, every piece that ends at each position (its output links); the best
scoring segmentation up to that position is relaxed from them (Viterbi).
Characters that no piece covers become UTF-8 byte pieces, so decoding gives
back the exact text.

No piece spans the border between a non-space and a following space, so a text
splits exactly into units (spaces with the characters after them) that are
segmented on their own; units repeat, and each worker keeps a bounded cache.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from itinera.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"      # must exist at this path on every executor
SPACE = "▁"
CACHE = 150_000                 # units in each of the two generations of a worker's cache
ROWS = 256                      # rows encoded at a time: the lists of a larger batch take much memory beside the heap
UNKNOWN_PENALTY = 10.0
NEVER = float("-inf")


class PieceModel:
    def __init__(self, path: str):
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(p.get_piece_size())
        self.byte_ids = {int(p.id_to_piece(i)[3:-1], 16): i for i in ids if p.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError(f"{path} has no byte pieces: texts could not be decoded exactly")
        normal = [i for i in ids if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
        self.score = {p.id_to_piece(i): (i, p.get_score(i)) for i in normal}
        self.fallback = min(s for _, s in self.score.values()) - UNKNOWN_PENALTY
        self.alphabet = {x for x in self.score if len(x) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, (i, s) in self.score.items():
            self.automaton.add_word(piece, (i, len(piece), s))
        self.automaton.make_automaton()
        raw = [b""] * p.get_piece_size()
        for piece, (i, _) in self.score.items():
            raw[i] = piece.replace(SPACE, " ").encode("utf-8", "surrogatepass")
        for b, i in self.byte_ids.items():
            raw[i] = bytes([b])
        self.raw = pa.array(raw, pa.large_binary())
        whole = any(SPACE in x.lstrip(SPACE) or "\n" in x for x in self.score)
        self.units = re.compile(r"(?s).+" if whole else rf"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def viterbi(self, unit: str) -> list[int]:
        """Best segmentation; equal scores go to the longer last piece (the automaton
        gives the pieces that end at one place longest first)."""
        n = len(unit)
        # the place before the text is index -1
        best, size_at, id_at = [NEVER] * n + [0.0], [1] * n, [-1] * n
        if self.alphabet.issuperset(unit):
            for end, (i, size, score) in self.automaton.iter(unit):
                got = best[end - size] + score
                if got > best[end]:
                    best[end], size_at[end], id_at[end] = got, size, i
        else:
            done = 0
            for end, (i, size, score) in self.automaton.iter(unit):
                while done <= end:
                    best[done] = best[done - 1] + self.fallback
                    done += 1
                got = best[end - size] + score
                if got > best[end] or got == best[end] and size > size_at[end]:
                    best[end], size_at[end], id_at[end] = got, size, i
        out, at = [], n - 1
        while at >= 0:
            if id_at[at] < 0:
                out.extend(self.byte_ids[b] for b in reversed(unit[at].encode("utf-8", "surrogatepass")))
            else:
                out.append(id_at[at])
            at -= size_at[at]
        out.reverse()
        return out

    def learn(self, unit: str) -> bytes:
        """Ids of a unit that the young generation lacks; units in use outlive a change of generations."""
        ids = self.old.get(unit)
        if ids is None:
            ids = array("i", self.viterbi(unit)).tobytes()
        if len(unit) <= 64:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[unit] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """int32 ids of the whole text.  Empty text has none.  A literal space mark is spelled in bytes."""
        out: list[bytes] = []
        for k, part in enumerate(text.split(SPACE) if text else ()):
            if k:
                out.append(np.array([self.byte_ids[b] for b in SPACE.encode()], np.int32).tobytes())
            for unit in self.units.findall((" " + part if not k else part).replace(" ", SPACE)):
                out.append(self.young.get(unit) or self.learn(unit))
        return np.frombuffer(b"".join(out), np.int32)

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text; null for null."""
        found = [self.encode(t or "") for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        values = np.concatenate([np.zeros(0, np.int32), *found])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=texts.is_null())

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The text of every list of ids; null for null."""
        ends = ids.offsets.to_numpy()
        pieces = self.raw.take(ids.values[ends[0]:ends[-1]])
        if not len(pieces):
            return pa.array([None if n else "" for n in ids.is_null().to_pylist()], pa.string())
        _, starts, raw = pieces.buffers()
        at = np.frombuffer(starts, np.int64)[ends - ends[0]].tolist()
        raw = memoryview(raw)
        return pa.array([str(raw[a + 1:b], "utf-8", "surrogatepass") if ok else None     # without the space put before
                         for ok, a, b in zip(ids.is_valid().to_pylist(), at, at[1:])], pa.string())


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One automaton per worker process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode(docs: DataFrame, path: str = MODEL, text_col: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of the whole text in ``name`` (null for null text, [] for empty)."""
    run = F.arrow_udf(lambda texts: model(path).encode_all(texts), "array<int>")
    return docs.withColumn(name, run(F.col(text_col)))


def decode(docs: DataFrame, path: str = MODEL, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids stand for in ``name`` (null for null)."""
    run = F.arrow_udf(lambda ids: model(path).decode_all(ids), "string")
    return docs.withColumn(name, run(F.col(ids_col)))


def encode_and_decode(docs: DataFrame, path: str = MODEL, text_col: str = "text", name: str = "ids",
                      decoded: str = "decoded") -> DataFrame:
    """``docs`` with both columns, in one pass: chained UDFs whose ids are also kept would encode
    every text twice.  Like ``withColumn``, it replaces columns of the names that it is given."""
    docs = docs.drop(name, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids = m.encode_all(batch.column(text_col))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids, m.decode_all(ids)],
                                                 [*batch.schema.names, name, decoded])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, ArrayType(IntegerType())),
                                            StructField(decoded, StringType())]))


def round_trip(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (of the ids, comma-joined), decoded_sha256 and
    exact (the decoded text is the text) for every row.

    Null texts have no pieces, decode to null and count as exact; empty texts
    decode to empty.  Repeated rows give a row each; an empty table none; only
    doc_id and text are read.
    """
    done = encode_and_decode(docs.select("doc_id", "text"), path)
    return done.select(
        "doc_id", F.greatest(F.size(F.coalesce("ids", F.array().cast("array<int>"))), F.lit(0)).cast("long").alias("n_pieces"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("exact"))


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or with the first number from 2 on that makes it a new column."""
    return next(c for c in (name, *(f"{name}_{i}" for i in range(2, len(taken) + 3))) if c not in taken)


def tokenised(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` with piece_ids, n_pieces and exact (the ids decode to the text); columns that
    have such a name already stay as they are, and ours take the next free one (n_pieces_2).

    Null texts have null ids, no pieces and count as exact, empty texts an empty list; repeated
    rows stay; an empty table gives no rows.
    """
    ids, n, exact, decoded = (free_name(x, docs.columns) for x in ("piece_ids", "n_pieces", "exact", "decoded_text"))
    done = encode_and_decode(docs, path, name=ids, decoded=decoded)
    return (done.withColumn(n, F.coalesce(F.size(ids), F.lit(0)).cast("long"))
            .withColumn(exact, F.col(decoded).eqNullSafe(F.col("text"))).drop(decoded))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
