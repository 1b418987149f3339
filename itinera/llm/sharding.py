"""Sharding by longest-processing-time scheduling.

Documents with equal texts form one group that stays together.  Groups go,
largest first, to the least-loaded shard (a heap).  To keep this bounded at any
size, group sizes are read with ``DIGITS`` significant bits (exact up to
2**DIGITS): at most 2**(DIGITS-1) size classes per power of two, so the driver
sees a histogram of a few ten thousand rows however many groups there are, and
places the groups of one class together; inside a class the groups are
interchangeable and numbered in two levels (class and hash bucket).
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itinera.llm.common import cut, table

DIGITS = 11


def lpt_counts(loads: list[float], size: float, count: int) -> list[int]:
    """How many of ``count`` equal items each shard gets when every item goes to
    the least-loaded shard.  ``loads`` is updated.

    A common level is searched up to which all shards surely fill, the last few
    items go through the heap one by one.
    """
    n = len(loads)
    taken = [0] * n
    if count > 2 * n:
        low, high = min(loads), max(loads) + size * (count // n + 2)
        for _ in range(80):
            level = (low + high) / 2
            if sum(max(0, int((level - x) // size)) for x in loads) <= count - n:
                low = level
            else:
                high = level
        taken = [max(0, int((low - x) // size)) for x in loads]
    heap = [(x + k * size, i) for i, (x, k) in enumerate(zip(loads, taken))]
    heapq.heapify(heap)
    for _ in range(count - sum(taken)):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
        taken[i] += 1
    for i, k in enumerate(taken):
        loads[i] += k * size
    return taken


def lpt_plan(classes: list[tuple[int, int, int]], n_shards: int) -> list[tuple[int, list[int], list[int]]]:
    """classes: (size class, groups, their bytes).  Returns for each class the
    upper rank bounds and the shards they belong to."""
    loads, plan = [0.0] * n_shards, []
    for cls, count, total in sorted(classes, reverse=True):
        ends, shards, at = [], [], 0
        for shard, k in enumerate(lpt_counts(loads, total / count, count)):
            if k:
                at += k
                ends.append(at)
                shards.append(shard)
        plan.append((cls, ends, shards))
    return plan


def shard_documents(docs: DataFrame, n_shards: int = 24, buckets: int = 256) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard and slot.

    size is the text's UTF-8 bytes plus 8.  Null texts count as empty and go
    with the empty ones.  Repeated rows and ids are rows of their own.  Slots
    number each shard from 0 without gaps.  An empty table gives no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.col("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"), F.unhex(F.md5(text)).alias("grp"))
    groups = base.groupBy("grp").agg((F.count(F.lit(1)) * F.max("size")).alias("weight"))
    groups = (groups
              .withColumn("cut_bits", F.greatest(F.lit(0), F.length(F.bin("weight")) - DIGITS))
              .withColumn("cls", F.expr("shiftleft(shiftright(weight, cut_bits), cut_bits)"))
              .withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(buckets)).cast("int"))
              .drop("cut_bits"))
    groups = cut(groups)

    counts = groups.groupBy("cls", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"))
    hist = counts.groupBy("cls").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))
    plan = lpt_plan([(r.cls, r.n, r.weight) for r in hist.collect()], n_shards)
    plan_df = spark.createDataFrame(plan, "cls long, ends array<long>, shards array<int>")

    starts = counts.select(
        "cls", "bucket",
        F.coalesce(F.sum("n").over(Window.partitionBy("cls").orderBy("bucket")
                                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    in_bucket = Window.partitionBy("cls", "bucket").orderBy("grp")
    ranked = (groups.withColumn("rn", F.row_number().over(in_bucket))
              .join(starts, ["cls", "bucket"])
              .withColumn("rank", F.col("start") + F.col("rn") - 1)
              .join(F.broadcast(plan_df), "cls")          # a row per size class: bounded, see above
              .select("grp", F.expr("shards[size(filter(ends, e -> e <= rank))]").alias("shard")))
    ranked = cut(ranked)

    placed = (base.join(ranked, "grp")
              .withColumn("part", F.pmod(F.xxhash64("doc_id", "grp"), F.lit(buckets)).cast("int")))
    placed = cut(placed)
    offs = (placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
            .select("shard", "part",
                    F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part")
                                               .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first")))
    w = Window.partitionBy("shard", "part").orderBy("doc_id", "grp")
    return (placed.withColumn("rn", F.row_number().over(w)).join(offs, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                    F.col("shard").cast("int").alias("shard"),
                    (F.col("first") + F.col("rn") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
