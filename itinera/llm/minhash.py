"""Near duplicates by circulant MinHash.

A document's set holds its distinct five-word shingles.  Two permutations make
the whole signature: the first scatters the shingles over 2**32 places, the
second, shifted circularly by 1 .. HASHES places, gives one minimum per shift.
Signatures are cut into bands.  Texts with equal sets are one class; classes that
share a band meet in blocks of bounded size, where signatures discard pairs
far below the threshold and full sets decide the rest.  Pairs already
connected are skipped, so a group of copies costs its members, not its pairs.

Buckets with the same members are looked at once.  Round one takes the buckets of
the first bands: a bucket falls into blocks that have a few of its members in
common, so a group of near copies becomes one component at a linear cost.  Round
two takes every bucket that still holds several components and compares what
lies outside its largest one with everything in it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import cut, mix64, table

SHINGLE = 5
HASHES, ROWS = 128, 4                 # 32 bands of 4: a pair at 0.85 shares none with probability 6e-11, at 0.8 5e-8
THRESHOLD = (85, 100)                 # the contract of op6
STAGE_THRESHOLD = (80, 100)           # of the pipeline's stage
BLOCK = 512
FIRST_BANDS = 4                       # bands of round one
BATCH = 4096
_rng = np.random.default_rng(20240611)
BYTE_CODE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)
PLACE = _rng.integers(1, 2 ** 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(STEP), -1, 2 ** 64))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word (A-Z lowered, split at white space)."""
    raw = LOWER[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    blank = np.concatenate([[True], BLANK[raw], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_CODE[raw] * _powers(len(raw), int(STEP)), dtype=np.uint64)])
    back = _powers(int(starts[-1]) + 1, int(_INVERSE))
    return mix64((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, without words none."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    n = min(SHINGLE, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h += w[j:len(w) - n + 1 + j] * PLACE[j]
    return np.unique(mix64(h))


def signature(sets: np.ndarray) -> np.ndarray:
    """HASHES minima: scatter (first permutation), then shift and permute again."""
    out = np.full(HASHES, np.uint32(0xFFFFFFFF), np.uint32)
    first = mix64(sets ^ STEP).astype(np.uint32)
    shifts = np.arange(1, HASHES + 1, dtype=np.uint32)
    for at in range(0, len(first), 2048):
        x = first[at:at + 2048, None] + shifts[None, :]
        x *= np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA77)
        x ^= x >> np.uint32(13)
        np.minimum(out, x.min(axis=0), out=out)
    return out


def bands(sigs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    s = sigs.astype(np.uint64).reshape(len(sigs), -1, ROWS)
    h = np.broadcast_to(np.arange(s.shape[1], dtype=np.uint64), s.shape[:2])
    for j in range(ROWS):
        h = mix64(h * STEP + s[:, :, j])
    return h.astype(np.int64)


def least_equal(threshold: tuple[int, int]) -> int:
    """Equal coordinates of HASHES that a pair at the threshold has: 6.5 deviations below the mean."""
    t = threshold[0] / threshold[1]
    return max(0, int(HASHES * t - 6.5 * (HASHES * t * (1 - t)) ** 0.5))


def link_block(label, sets, sigs, threshold: tuple[int, int] = THRESHOLD) -> np.ndarray:
    """For each member the first member of its component: exact Jaccard links within the block.

    Each member meets all later ones that are still apart, may reach the threshold
    by their sizes and agree in enough coordinates.
    """
    n = len(sets)
    _, first, at = np.unique(label, return_index=True, return_inverse=True)
    own = first[at]
    size = np.array([len(s) for s in sets])
    # shingles numbered within the block: a set is marked once and looked up by all others
    known, number = np.unique(np.concatenate(sets), return_inverse=True)
    numbers = np.split(number, np.cumsum(size)[:-1])
    marked = np.zeros(len(known), np.uint8)
    num, den = threshold
    least = least_equal(threshold)
    for i in range(n):
        fits = (np.minimum(size, size[i]) * den >= np.maximum(size, size[i]) * num) & (own != own[i])
        near = i + 1 + np.flatnonzero(fits[i + 1:])
        if len(near):
            near = near[(sigs[near] == sigs[i]).sum(axis=1) >= least]
        if not len(near):
            continue
        marked[numbers[i]] = 1
        starts = np.concatenate([[0], np.cumsum(size[near])[:-1]])
        common = np.add.reduceat(marked[np.concatenate([numbers[j] for j in near])], starts, dtype=np.int64)
        marked[numbers[i]] = 0
        joined = own[near[den * common >= num * (size[i] + size[near] - common)]]
        if len(joined):
            own[np.isin(own, np.append(joined, own[i]))] = min(joined.min(), own[i])
    return own


def _link(pdf: pd.DataFrame, threshold: tuple[int, int]) -> pd.DataFrame:
    """Links (first member of a label, first member of its component) of every block in ``pdf``."""
    links = []
    for _, block in pdf.groupby(["bucket", "i", "j"], sort=False):
        block = block.drop_duplicates("node").sort_values("node")
        if block["label"].nunique() < 2:
            continue
        node = block["node"].to_numpy()
        roots = link_block(block["label"].to_numpy(), [np.frombuffer(b, np.uint64) for b in block["sets"]],
                           np.frombuffer(b"".join(block["sig"]), np.uint32).reshape(-1, HASHES), threshold)
        first = np.unique(block["label"], return_index=True)[1]
        moved = first[roots[first] != first]
        links.append(pd.DataFrame({"a": node[moved], "b": node[roots[moved]]}))
    return pd.concat(links) if links else pd.DataFrame({"a": [], "b": []}).astype("int64")


def linked_blocks(blocks: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """All blocks (bucket, i, j, node, label) linked, about BATCH members to a task's group."""
    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        return _link(pdf, threshold)

    blocks = cut(blocks)
    parts = max(1, -(-blocks.count() // BATCH))
    return cut(blocks.join(sets, "node")
               .withColumn("part", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(parts)))
               .groupBy("part").applyInPandas(link, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) for all nodes of the edges, by spreading
    the least label along the edges and jumping to the label's label."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        seen = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = (labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = cut(step.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label")))
        moved = step.filter("old <> label").limit(1).count()
        labels = step.select("node", "label")
        if not moved:
            return labels


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; pairs whose
    similarity reaches ``threshold`` (a fraction) are linked.

    Texts without words and null texts have empty sets and link with nothing: their
    component is their own id.  Repeated rows are linked like any equal texts; null
    ids come last when a component takes its smallest id (null if there is no
    other) and are kept if so.  An empty table gives no rows.  Only doc_id and
    text are read.
    """
    rows, least = with_components(docs, threshold)
    per_class = cut(least.select("class", F.col("least.doc_id").alias("component_id")))
    out = rows.select("doc_id", "n", "class").join(per_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def with_components(docs: DataFrame, threshold: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Every row's doc_id, key (hash of the text), number of shingles n and class of
    equal sets (null without words); and for every class its component's label and the
    component's least member (no_id, doc_id, key), null ids last."""
    @F.pandas_udf("n long, class binary, bands array<long>")
    def featured(texts: pd.Series) -> pd.DataFrame:
        rows, sigs = [], []
        for t in texts:
            s = shingles(t)
            rows.append((len(s), hashlib.md5(s.tobytes()).digest() if len(s) else None))
            sigs.append(signature(s))
        out = pd.DataFrame(rows, columns=["n", "class"])
        out["bands"] = list(bands(np.stack(sigs))) if sigs else []
        return out

    @F.pandas_udf("sets binary, sig binary")
    def sets_of(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t) for t in texts]
        return pd.DataFrame({"sets": [x.tobytes() for x in sets], "sig": [signature(x).tobytes() for x in sets]})

    text = F.col("text")
    rows = (docs.select("doc_id", F.xxhash64(text).alias("key"), featured(text).alias("f"))
            .select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "f.n", "f.class", "f.bands"))
    rows = cut(rows)
    # one member of each class of equal sets stands for it
    classes = cut(rows.filter("n > 0").groupBy("class").agg(
        F.min("row").alias("node"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("least")))
    picked = cut(rows.join(classes.select(F.col("node").alias("row")), "row", "left_semi"))
    keyed = picked.select(F.col("row").alias("node"), F.posexplode("bands").alias("band", "bucket"))
    # of the buckets with the same members one stays: two 64-bit sums tell member sets apart
    mixed = F.xxhash64("node")
    buckets = (keyed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.min("band").alias("band"),
        F.bit_xor(mixed).alias("sum_a"), F.bit_xor(F.xxhash64(F.lit("b"), "node")).alias("sum_b"),
        F.array(F.min("node"), F.max("node"), F.min_by("node", mixed), F.max_by("node", mixed)).alias("common"))
        .filter("members > 1"))
    shared = cut(buckets.groupBy("members", "sum_a", "sum_b").agg(F.min_by(
        F.struct("bucket", "band", "common"), F.struct("band", "bucket")).alias("b")).select("members", "b.*"))
    met = cut(keyed.drop("band").join(shared.drop("common"), "bucket"))

    # the sets of the members only, read again from their texts
    asked = met.select(F.col("node").alias("row")).distinct()
    wanted = (picked.join(asked, "row", "left_semi")
              .select(F.col("row").alias("node"), F.col("doc_id").alias("wanted_id"), F.col("key").alias("wanted_key")))
    sets = cut(docs.select("doc_id", "text")
               .join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.xxhash64("text") == F.col("wanted_key")))
               .select("node", sets_of("text").alias("s")).select("node", "s.*"))

    # round one: the first bands, block by block; every block of a bucket has its common members
    n_blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    spread = F.pmod(F.xxhash64("node"), n_blocks).cast("int")
    own = met.filter(F.col("band") < FIRST_BANDS).select("bucket", spread.alias("i"), "node")
    everywhere = (shared.filter((F.col("band") < FIRST_BANDS) & (F.col("members") > BLOCK))
                  .select("bucket", "common", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("i"))
                  .select("bucket", "i", F.explode("common").alias("node")))
    found = linked_blocks(own.unionByName(everywhere).distinct()
                          .select("bucket", "i", F.col("i").alias("j"), "node", F.col("node").alias("label")), sets, threshold)
    labels = components(found)

    # round two: buckets that hold several components; all but the largest component against all
    named = cut(met.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label")))
    open_ = (named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("members"))
             .filter("main.n < members"))
    whole = F.col("members") <= BLOCK
    rest = F.when(whole, 1).otherwise(F.ceil((F.col("members") - F.col("main.n")) / BLOCK)).cast("int")
    large = F.when(whole, 0).otherwise(F.ceil(F.col("main.n") / BLOCK)).cast("int")
    of_main = ~whole & (F.col("label") == F.col("main.label"))
    blocks = (named.join(open_, "bucket").withColumn("rest", rest).withColumn("large", large).withColumn("of_main", of_main)
              .withColumn("own", F.when(F.col("of_main"), F.col("rest") + F.pmod(F.xxhash64("node"), "large"))
                          .otherwise(F.pmod(F.xxhash64("node"), "rest")).cast("int"))
              .withColumn("other", F.explode(F.sequence(
                  F.lit(0), F.when(F.col("of_main"), F.col("rest")).otherwise(F.col("rest") + F.col("large")) - 1)))
              .select("bucket", "node", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    labels = components(found.unionByName(linked_blocks(blocks, sets, threshold)))

    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = cut(named.groupBy("label").agg(F.min("least").alias("least")))
    return rows, named.select("class", "label").join(first, "label")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates (linked from ``STAGE_THRESHOLD`` on), with
    the columns ``docs`` had: that of the smallest id, null ids last, and of its texts the
    one of the smallest hash.  Rows of the same id with unrelated texts are documents of
    their own; texts without words fold only with the same text of the same id."""
    rows, least = with_components(docs, STAGE_THRESHOLD)
    kept = cut(least.select("least.doc_id", "least.key")
               .unionByName(rows.filter("class IS NULL").select("doc_id", "key")).distinct()
               .select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key")))
    name = next(c for i in range(99) if (c := f"own_text_{i}") not in docs.columns)
    own = docs.withColumn(name, F.xxhash64("text"))
    rows = own.join(kept, own["doc_id"].eqNullSafe(kept["kept_id"]) & (own[name] == kept["kept_key"]), "left_semi")
    return rows.dropDuplicates(["doc_id", name]).drop(name)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
r AS (SELECT doc_id AS root, doc_id AS v FROM d UNION SELECT root, y FROM r JOIN e ON e.x = r.v),
m AS (SELECT v AS doc_id, min(root) AS component_id FROM r GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.doc_id = d.doc_id
"""
