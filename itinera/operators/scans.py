"""Ordered scans over keyed rows that stay parallel when one key is hot.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to
one task: with a key that holds a third of all rows, one task sorts a third
of the data.  Each scan here takes an optional ``bucket`` — a column that is
monotone in the scan order (e.g. the hour of the timestamp).  The scan then
runs in two levels:

1. inside each (key, bucket) with a window (bounded by the bucket width);
2. across buckets on a per-(key, bucket) summary table — one row per
   bucket, so a hot key contributes only as many rows as it has buckets —
   whose carry is joined back on (key, bucket).

The result equals the one-level window exactly.  Without ``bucket`` the
one-level window is used (right for groups bounded by the domain, e.g. the
segments of one ticket).

Scan order is given as column names, all ascending; the last ones must
break ties (make the order total).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from itinera.functions.dates import epoch_micros

Bucket = Callable[[Column], Column]


def time_bucket(seconds: int) -> Bucket:
    """Bucket function for a timestamp column: fixed-width time slices."""
    us = int(seconds) * 1_000_000

    def f(c: Column) -> Column:
        return F.floor(epoch_micros(c) / F.lit(us)).cast("long")
    return f


def value_bucket(width: float) -> Bucket:
    """Bucket function for a numeric column."""
    def f(c: Column) -> Column:
        return F.floor(c / F.lit(width)).cast("long")
    return f


class RangeBucket:
    """Data-driven buckets: ``repartitionByRange`` over (keys, order) samples
    the data and cuts it into ``n`` balanced ranges, so even a key holding a
    third of all rows is spread over many partitions; the partition id is
    monotone in the order within a key and serves as the bucket."""

    def __init__(self, n: int | None = None):
        self.n = n


def range_bucket(n: int | None = None) -> RangeBucket:
    return RangeBucket(n)


def _bucketed(df: DataFrame, keys, order, bucket) -> DataFrame:
    if "_b" in df.columns:          # chained scans reuse one bucket column,
        return df                   # so the (keys, _b) partitioning is reused too
    if isinstance(bucket, RangeBucket):
        # The partition id is physical: it is written once (a reliable
        # checkpoint under spark.checkpoint.dir, which also cuts the lineage)
        # so every branch of the scan reads the same bucket per row.
        from itinera.session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        n = bucket.n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return (df.repartitionByRange(n, *[F.col(k) for k in keys], *[F.col(o) for o in order])
                .withColumn("_b", F.spark_partition_id().cast("long")).checkpoint(eager=True))
    return df.withColumn("_b", bucket(F.col(order[0])))


def _w(keys, order, bucketed: bool):
    parts = list(keys) + (["_b"] if bucketed else [])
    return Window.partitionBy(*parts).orderBy(*order)


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                    bucket: Bucket | None = None, keep_bucket: bool = False) -> DataFrame:
    """1-based position of each row inside its key, in ``order``."""
    keys, order = list(keys), list(order)
    if bucket is None:
        return df.withColumn(out, F.row_number().over(_w(keys, order, False)).cast("long"))
    d = _bucketed(df, keys, order, bucket)
    d = d.withColumn("_loc", F.row_number().over(_w(keys, order, True)).cast("long"))
    counts = d.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*keys, "_b", F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_off"))
    return (_join_back(d, offs, keys + ["_b"])
            .withColumn(out, F.col("_loc") + F.col("_off"))
            .select(*_cols(df, keep_bucket), out))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                bucket: Bucket | None = None, keep_bucket: bool = False) -> DataFrame:
    """Sum of ``value`` over all rows of the key up to and including this row."""
    keys, order = list(keys), list(order)
    if bucket is None:
        w = _w(keys, order, False).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(w))
    d = _bucketed(df, keys, order, bucket)
    w = _w(keys, order, True).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_loc", F.sum(value).over(w))
    tot = d.groupBy(*keys, "_b").agg(F.sum(value).alias("_n"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*keys, "_b", F.sum("_n").over(wb).alias("_off"))
    return (_join_back(d, offs, keys + ["_b"])
            .withColumn(out, F.when(F.col("_off").isNull(), F.col("_loc"))
                        .otherwise(F.col("_loc") + F.col("_off")))
            .select(*_cols(df, keep_bucket), out))


def _join_back(d: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Null-safe join of a one-row-per-bucket summary: rows with a null key or a
    null time keep their place, as in the plain window."""
    named = side.select(*[F.col(c).alias(f"_j_{c}") for c in on], *[c for c in side.columns if c not in on])
    cond = None
    for c in on:
        same = F.col(c).eqNullSafe(F.col(f"_j_{c}"))
        cond = same if cond is None else cond & same
    return d.join(named, cond, "inner").drop(*[f"_j_{c}" for c in on])


def _cols(df: DataFrame, keep_bucket: bool) -> list[str]:
    cols = [c for c in df.columns if c != "_b"]
    return cols + ["_b"] if keep_bucket else cols


def _neighbour(df, keys, order, cols, out, bucket, forward: bool, keep_bucket: bool = False):
    keys, order = list(keys), list(order)
    payload = F.struct(*[F.col(c) for c in cols])
    fn = F.lead if forward else F.lag
    if bucket is None:
        return df.withColumn(out, fn(payload).over(_w(keys, order, False)))
    d = _bucketed(df, keys, order, bucket)
    d = d.withColumn("_loc", fn(payload).over(_w(keys, order, True)))
    edge = (F.min if forward else F.max)(F.struct(*[F.col(o) for o in order], payload.alias("_p")))
    summ = d.groupBy(*keys, "_b").agg(edge.alias("_e"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    carry = summ.select(*keys, "_b", fn(F.col("_e._p")).over(wb).alias("_c"))
    return (_join_back(d, carry, keys + ["_b"])
            .withColumn(out, F.coalesce(F.col("_loc"), F.col("_c")))
            .select(*_cols(df, keep_bucket), out))


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
              out: str = "next", bucket: Bucket | None = None) -> DataFrame:
    """Struct ``out`` with ``cols`` of the next row of the same key (null at
    the last row)."""
    return _neighbour(df, keys, order, cols, out, bucket, True)


def with_prev(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
              out: str = "prev", bucket: Bucket | None = None, keep_bucket: bool = False) -> DataFrame:
    """Struct ``out`` with ``cols`` of the previous row of the same key."""
    return _neighbour(df, keys, order, cols, out, bucket, False, keep_bucket)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str,
              right_time: str, right_cols: Sequence[str], right_order: Sequence[str] = (),
              out: str = "match", bucket: Bucket | None = None) -> DataFrame:
    """For every left row, the right row of the same key with the greatest
    (time, *right_order) at or before the left time; struct ``out`` holds
    ``right_cols`` (null when none).  Left rows are kept as they are.

    Built as one ordered scan over the union of both sides (no pairwise join,
    so a key with many rows on both sides stays linear).  Right rows without a
    time match nothing, left rows without a time find nothing.
    """
    keys = list(keys)
    rcols = list(right_cols)
    ro = list(right_order)
    lcols = left.columns
    l2 = left.select(*[F.col(c) for c in lcols], F.col(left_time).alias("_t"),
                     F.lit(1).alias("_side"))
    not_null = F.col(right_time).isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    r2 = (right.where(not_null)
          .select(*[F.col(k) for k in keys], F.col(right_time).alias("_t"), F.lit(0).alias("_side"),
                  *[F.col(o).alias(f"_o{i}") for i, o in enumerate(ro)],
                  F.struct(*[F.col(c) for c in rcols]).alias("_r")))
    for i in range(len(ro)):
        l2 = l2.withColumn(f"_o{i}", F.lit(None).cast(r2.schema[f"_o{i}"].dataType))
    l2 = l2.withColumn("_r", F.lit(None).cast(r2.schema["_r"].dataType))
    return _asof_scan(l2.unionByName(r2, allowMissingColumns=True), keys, len(ro), lcols, out, bucket)


def asof_within(df: DataFrame, keys: Sequence[str], time: str, is_left: Column, is_right: Column,
                right_cols: Sequence[str], right_order: Sequence[str] = (), out: str = "match",
                bucket: Bucket | None = None) -> DataFrame:
    """``asof_join`` of two row sets of one table: the rows where ``is_left`` holds, each with
    the latest row where ``is_right`` holds.  A row may be on both sides (it then finds itself
    or a later one of its time).  The table is read once for the scan and once, with the key,
    order and payload columns only, for the carries."""
    keys, ro, lcols = list(keys), list(right_order), df.columns
    known = F.col(time).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    sides = F.filter(F.array(F.when(is_right & known, F.lit(0)), F.when(is_left, F.lit(1))), lambda x: x.isNotNull())
    u = df.select(*lcols, F.explode(sides).alias("_side"))
    right = F.col("_side") == 0
    u = u.select(*lcols, "_side", F.col(time).alias("_t"),
                 *[F.when(right, F.col(o)).alias(f"_o{i}") for i, o in enumerate(ro)],
                 F.when(right, F.struct(*[F.col(c) for c in right_cols])).alias("_r"))
    return _asof_scan(u, keys, len(ro), lcols, out, bucket)


def _asof_scan(u: DataFrame, keys: list[str], n_order: int, lcols: list[str], out: str, bucket) -> DataFrame:
    """The ordered scan behind both as-of lookups over (time, side, order, payload) rows: side
    0 offers its payload ``_r``, side 1 is returned.  Equal offers go by their payload."""
    order = ["_t", "_side"] + [f"_o{i}" for i in range(n_order)] + ["_r"]
    if bucket is None:
        w = _w(keys, order, False).rowsBetween(Window.unboundedPreceding, 0)
        res = u.withColumn(out, F.when(F.col("_t").isNotNull(), F.last("_r", ignorenulls=True).over(w)))
        return res.where("_side = 1").select(*lcols, out)
    u = _bucketed(u, keys, order, bucket).withColumn("_kb", F.struct(*keys, "_b"))
    w = Window.partitionBy("_kb").orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    u = u.withColumn("_loc", F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ends = u.select(*keys, "_b", "_kb", F.row_number().over(w).alias("_pos"),
                    F.last("_r", ignorenulls=True).over(whole).alias("_end")).where("_pos = 1")
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("_kb", F.last("_end", ignorenulls=True).over(wb).alias("_c"))
    res = u.where("_side = 1").join(carry, "_kb").withColumn(
        out, F.when(F.col("_t").isNotNull(), F.coalesce(F.col("_loc"), F.col("_c"))))
    return res.select(*lcols, out)


def split_and_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], prev_cols: Sequence[str],
                     is_break: Callable[[Column], Column], out: str = "group_nbr", seq_out: str | None = None,
                     bucket: Bucket | None = None) -> DataFrame:
    """``split_by_gap``, and with ``seq_out`` the position of each row inside its group, in one
    scan.  Inside a (key, bucket) one window finds the breaks behind its first row; one row a
    bucket, its first, then decides whether it breaks from the bucket before, and carries the
    groups, the rows and the start of the open group; one join brings the carry back.  The
    bucket key is one struct, which equals itself whatever is null in it, so the rows stay where
    the window put them."""
    keys, order = list(keys), list(order)
    cols = [c for c in df.columns if c != "_b"]
    d = df.withColumn("_b", F.lit(0).cast("long")) if bucket is None else _bucketed(df, keys, order, bucket)
    d = d.withColumn("_kb", F.struct(*keys, "_b"))
    w = Window.partitionBy("_kb").orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    payload = F.struct(*[F.col(c) for c in prev_cols])
    brk = lambda prev: F.when(is_break(prev), F.lit(1)).otherwise(F.lit(0)).cast("long")
    d = d.withColumn("_pos", F.row_number().over(w).cast("long")).withColumn("_prev", F.lag(payload).over(w))
    d = d.withColumn("_brk", F.when(F.col("_pos") == 1, F.lit(0).cast("long")).otherwise(brk(F.col("_prev"))))
    at = F.when(F.col("_brk") == 1, F.col("_pos"))
    # the first row of each bucket, with what the bucket holds behind it
    firsts = d.select(*cols, "_b", "_kb", "_pos", F.sum("_brk").over(whole).alias("_breaks"),
                      F.count(F.lit(1)).over(whole).alias("_rows"), F.max(at).over(whole).alias("_start"),
                      F.last(payload).over(whole).alias("_last")).where("_pos = 1")
    by_bucket = Window.partitionBy(*keys).orderBy("_b")
    before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("_before", F.lag("_last").over(by_bucket))
    firsts = firsts.withColumn("_new", F.when(F.col("_before").isNull(), F.lit(1).cast("long")).otherwise(brk(F.col("_before"))))
    firsts = firsts.withColumn("_base", F.coalesce(F.sum(F.col("_breaks") + F.col("_new")).over(before), F.lit(0)) + F.col("_new"))
    firsts = firsts.withColumn("_skip", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    own = F.when(F.col("_new") == 1, F.col("_skip") + 1)
    firsts = firsts.withColumn("_opened", own).withColumn("_latest", F.coalesce(F.col("_skip") + F.col("_start"), own))
    carry = firsts.select("_kb", "_base", "_skip", F.coalesce("_opened", F.max("_latest").over(before)).alias("_open"))
    d = d.select(*cols, "_kb", "_pos", F.sum("_brk").over(so_far).alias("_breaks"), F.max(at).over(so_far).alias("_start"))
    d = d.join(carry, "_kb").withColumn(out, F.col("_base") + F.col("_breaks"))
    if seq_out is None:
        return d.select(*cols, out)
    start = F.coalesce(F.col("_skip") + F.col("_start"), F.col("_open"))
    return d.withColumn(seq_out, F.col("_skip") + F.col("_pos") - start + 1).select(*cols, out, seq_out)


def split_by_gap(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 prev_cols: Sequence[str], is_break: Callable[[Column], Column],
                 out: str = "group_nbr", bucket: Bucket | None = None) -> DataFrame:
    """Number consecutive runs: a new group starts at the first row of a key
    and wherever ``is_break(prev)`` holds (``prev`` is a struct of
    ``prev_cols`` of the previous row; current columns are plain columns).
    Replaces a recursive CTE carrying a counter with lag + running sum."""
    keys, order = list(keys), list(order)
    if bucket is not None:
        return split_and_number(df, keys, order, prev_cols, is_break, out, None, bucket)
    d = with_prev(df, keys, order, prev_cols, "_prev")
    d = d.withColumn("_brk", F.when(F.col("_prev").isNull(), F.lit(1))
                     .when(is_break(F.col("_prev")), F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return running_sum(d, keys, order, "_brk", out).drop("_prev", "_brk")
