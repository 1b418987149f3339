"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Only the first ``LENGTH`` bytes of a suffix matter.  Suffixes are dealt by an
anchor: of the ``GRAM``-byte grams inside its first LENGTH bytes the one with the
least hash (the leftmost of equals), so equal windows have equal anchors at
equal offsets.  Consecutive suffixes mostly share their anchor and travel as
one region of text.  Regions whose anchor occurs once in the corpus cannot
repeat and stay where they are (a bitmap of fixed size drops them, what it lets
through does no harm).  The others meet by anchor; within a task the suffixes
are ordered most significant digit first, ``DIGIT`` bytes at a time, single ones
dropping out after each pass: what is left after LENGTH bytes are exactly the
repeated windows.

An anchor with more than ``HOT`` regions (or a millionth of all, so that at most a
million anchors are hot) would burden one task: its windows are
counted one by one instead, spread by their own hash with partial counts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import cut, mix64, table

LENGTH, GRAM, DIGIT = 200, 64, 100
HOT = 50_000
REGIONS = 20_000                       # of one task
BITS = 1 << 25
CHUNK = 1 << 20
_rng = np.random.default_rng(7)
CODE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0xD1342543DE82EF95
_tables: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    if len(_tables.get(name, ())) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        _tables[name] = np.multiply.accumulate(out)
    return _tables[name][:n]


def fingerprints(raw: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """Fingerprint of the ``size`` bytes from each position (or from those in ``at``)."""
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(CODE[raw] * _powers("up", BASE, len(raw)), out=total[1:])
    if at is None:
        at = np.arange(len(raw) - size + 1)
    return mix64((total[at + size] - total[at]) * _powers("down", pow(BASE, -1, 2 ** 64), len(raw) + 1)[at])


def runs(raw: np.ndarray):
    """(first start, windows, anchor position, anchor fingerprint) of each run of
    windows with one anchor, as arrays."""
    out = []
    width = LENGTH - GRAM + 1
    for c in range(0, max(0, len(raw) - LENGTH + 1), CHUNK):
        n = min(CHUNK, len(raw) - LENGTH + 1 - c)
        h = fingerprints(raw[c:c + n + LENGTH - 1], GRAM)
        key = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
        blocks = -(-len(key) // width)
        full = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        full[:len(key)] = key
        grid = full.reshape(blocks, width)
        ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
        anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        out.append((first + c, np.diff(np.append(first, n)), anchor[first] + c, h[anchor[first]].view(np.int64)))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def count_anchors(batches):
    for batch in batches:
        for at in range(0, len(batch), 1000):
            found = [runs(as_bytes(t))[3] for t in batch["text"].iloc[at:at + 1000]]
            anchor, n = np.unique(np.concatenate(found), return_counts=True)
            yield pd.DataFrame({"anchor": anchor, "n": n})


def repeated_windows(anchor, rel_anchor, n_windows, texts) -> list[np.ndarray]:
    """For each distinct region a mark per window: repeated among these regions.

    Most-significant-digit passes over suffixes grouped by anchor and offset.
    """
    raw = np.frombuffer(b"".join(texts), np.uint8)
    base = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]])
    region = np.repeat(np.arange(len(texts)), n_windows)
    ends = np.cumsum(n_windows)
    offset = np.arange(len(region)) - np.repeat(ends - n_windows, n_windows)
    group = mix64(anchor.astype(np.int64).view(np.uint64)[region] + (rel_anchor[region] - offset).astype(np.uint64) * np.uint64(BASE))
    alive = np.arange(len(region))
    for depth in range(0, LENGTH, DIGIT):
        place = base[region[alive]] + offset[alive] + depth
        group = mix64(group * np.uint64(BASE) + fingerprints(raw, DIGIT, place))
        order = np.argsort(group, kind="stable")
        same = group[order][1:] == group[order][:-1]
        twin = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        stay = order[twin]
        alive, group = alive[stay], group[stay]
        if not len(alive):
            break
    marks = np.zeros(len(region), bool)
    marks[alive] = True
    return np.split(marks, ends[:-1])


def spans_of(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - 1 + LENGTH


def sort_regions(pdf: pd.DataFrame) -> pd.DataFrame:
    """Covered spans (doc_id, key, start, end) of the regions of some anchors."""
    whole = pdf.groupby(["anchor", "bytes", "at"], sort=False).ngroup().to_numpy()
    copies = np.bincount(whole)
    _, rep = np.unique(whole, return_index=True)
    one = pdf.iloc[rep]
    marks = repeated_windows(one["anchor"].to_numpy(), one["at"].to_numpy(), one["n"].to_numpy(), one["bytes"].tolist())
    found = [spans_of(np.ones_like(m) if k > 1 else m) for m, k in zip(marks, copies)]
    per_row = [found[i] for i in whole]
    many = np.array([len(a) for a, _ in per_row])
    if not many.sum():
        return pd.DataFrame({"doc": [], "start": [], "end": []}).astype({"doc": object, "start": int, "end": int})
    first = np.repeat(pdf["first"].to_numpy(), many)
    return pd.DataFrame({"doc": np.repeat(pdf["doc"].to_numpy(), many),
                         "start": first + np.concatenate([a for a, _ in per_row]),
                         "end": first + np.concatenate([b for _, b in per_row])})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    Null and empty texts have no bytes; texts under LENGTH bytes lose nothing;
    repeated rows and copies repeat each other and lose everything from LENGTH
    bytes on.  An empty table gives no rows.  Only doc_id and text are read.
    """
    spark = docs.sparkSession
    # the document of a region: its id and a hash of its text
    doc = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.xxhash64("text").cast("string"))
    long_ = docs.filter(F.octet_length("text") >= LENGTH).select(doc.alias("doc"), "text")
    counts = (long_.select("text").mapInPandas(count_anchors, "anchor long, n long")
              .groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1"))
    counts = cut(counts)
    probes = counts.select(F.explode(F.array(F.col("anchor"), F.shiftrightunsigned("anchor", 32))).alias("h"))
    words = (probes.select(F.col("h").bitwiseAND(BITS - 1).alias("b"))
             .groupBy(F.shiftright("b", 6).cast("int").alias("i"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("bits")).toPandas())   # BITS / 64 rows at most
    bits = np.zeros(BITS // 64, np.int64)
    bits[words["i"].to_numpy(int)] = words["bits"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(bits)

    def may_repeat(anchor: np.ndarray) -> np.ndarray:
        ok = np.ones(len(anchor), bool)
        a = anchor.view(np.uint64)
        for h in (a, a >> np.uint64(32)):
            b = (h & np.uint64(BITS - 1)).astype(np.int64)
            ok &= (shared.value[b >> 6] >> (b & 63)) & 1 == 1
        return ok

    def regions(batches, want_hot):
        for batch in batches:
            rows, held = [], 0
            for d, t in zip(batch["doc"], batch["text"]):
                raw = as_bytes(t)
                text = raw.tobytes()
                first, n, at, anchor = runs(raw)
                ok = may_repeat(anchor)
                if len(hot_set.value):
                    ok &= np.isin(anchor, hot_set.value) == want_hot
                for f, k, a, h in zip(first[ok].tolist(), n[ok].tolist(), at[ok].tolist(), anchor[ok].tolist()):
                    rows.append((d, f, k, a - f, h, text[f:f + k - 1 + LENGTH]))
                    held += k + LENGTH
                if held > 8_000_000:
                    yield pd.DataFrame(rows, columns=["doc", "first", "n", "at", "anchor", "bytes"])
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=["doc", "first", "n", "at", "anchor", "bytes"])

    totals = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = max(1, -(-totals // REGIONS))
    hot = counts.filter(F.col("n") > max(HOT, totals // 1_000_000)).select("anchor").toPandas()["anchor"].to_numpy(np.int64)
    n_hot = len(hot)
    hot_set = spark.sparkContext.broadcast(np.sort(hot))
    spans = "doc string, start long, end long"
    region = "doc string, first long, n long, at long, anchor long, bytes binary"
    covered = (long_.mapInPandas(lambda batches: regions(batches, False), region).withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(parts)))
               .groupBy("part").applyInPandas(lambda pdf: sort_regions(pdf), spans))
    if n_hot:
        single = (long_.mapInPandas(lambda batches: regions(batches, True), region)
                  .select("doc", "first", "bytes", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("o"))
                  .select("doc", (F.col("first") + F.col("o")).alias("start"),
                          F.unhex(F.md5(F.substring("bytes", F.col("o") + 1, F.lit(LENGTH)))).alias("win")))
        single = cut(single)
        again = single.groupBy("win").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("win")
        covered = covered.unionByName(single.join(again, "win", "left_semi")
                                      .select("doc", "start", (F.col("start") + LENGTH).alias("end")))
    per_doc = (covered.groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("s"))
               .select("doc", F.col("s.start").alias("starts"), F.col("s.end").alias("ends")))

    @F.arrow_udf("n_removed long, n_spans long, kept_sha256 string")
    def rest(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        out = []
        for t, a, b in zip(texts, starts, ends):
            raw = as_bytes(t.as_py())
            gone = np.zeros(len(raw) + 1, np.int64)
            if a.is_valid:
                np.add.at(gone, a.values.to_numpy(), 1)
                np.add.at(gone, b.values.to_numpy(), -1)
            gone = np.cumsum(gone)[:-1] > 0
            n_spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
            out.append({"n_removed": int(gone.sum()), "n_spans": n_spans,
                        "kept_sha256": hashlib.sha256(raw[~gone].tobytes()).hexdigest()})
        return pa.array(out, pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select("doc_id", "text", doc.alias("doc")).join(per_doc, "doc", "left")
            .select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), rest(text, "starts", "ends").alias("r"))
            .select("doc_id", "n_bytes", "r.n_removed", "r.n_spans", "r.kept_sha256"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
