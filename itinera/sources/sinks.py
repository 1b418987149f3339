"""Sinks.  A step rewrites whole batch partitions (dynamic partition
overwrite), so re-running a batch replaces its rows instead of appending
them twice."""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from itinera.operators.scans import range_bucket, sequence_number


def append_slice(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    df.write.mode("append").partitionBy(*partition_cols).parquet(path)


def replace_slice(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Overwrite exactly the partitions present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def replace_batch(df: DataFrame, path: str, batch_col: str, batch) -> None:
    """Overwrite one batch with ``df``, also when it has no rows: the batch's
    old rows go and the table stays readable."""
    df.where(F.col(batch_col) == F.lit(batch)).drop(batch_col).write.mode("overwrite").parquet(
        f"{path}/{batch_col}={batch}")


def apply_updates(base: DataFrame, upd: DataFrame, keys: Sequence[str],
                  cols: Sequence[str]) -> DataFrame:
    """``UPDATE base SET cols = upd.cols FROM upd WHERE keys match``.

    ``upd`` must hold one row per key (deduplicate first).  A matched row
    takes the new value even when it is null; unmatched rows keep theirs.
    All new values are computed from the old row (one projection).
    """
    u = upd.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_u_{c}") for c in cols])
    j = base.join(u, list(keys), "left")
    for c in cols:
        j = j.withColumn(c, F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(
            F.col(c) if c in base.columns else F.lit(None)))
    return j.drop("_hit", *[f"_u_{c}" for c in cols])


def insert_absent(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``src`` whose key is not yet in ``tgt``."""
    return src.join(tgt.select(*keys), list(keys), "left_anti")


def new_members(candidates: DataFrame, dim: DataFrame, natural_keys: Sequence[str]) -> DataFrame:
    """The distinct candidates that ``dim`` lacks.  Keys compare null-safely: a member with a
    null name part is still the same member."""
    nk = list(natural_keys)
    cand = candidates.select(*nk).distinct()
    d = dim.select(*[F.col(k).alias(f"_d_{k}") for k in nk])
    cond = [cand[k].eqNullSafe(d[f"_d_{k}"]) for k in nk]
    return cand.join(d, reduce(lambda a, b: a & b, cond), "left_anti")


def number_members(new: DataFrame, natural_keys: Sequence[str], key_col: str, first: int, kind) -> DataFrame:
    """Members with keys from ``first`` on in natural-key order, so a re-run gives the same
    keys.  The numbering is two-level (range buckets, then one row per bucket), so no task
    holds all new members."""
    nk = list(natural_keys)
    new = sequence_number(new.withColumn("_all", F.lit(1)), ["_all"], nk, "_nbr", bucket=range_bucket())
    return new.select(*nk, (F.col("_nbr") + F.lit(first - 1)).cast(kind).alias(key_col))


def insert_new_members(candidates: DataFrame, dim: DataFrame, natural_keys: Sequence[str],
                       key_col: str) -> DataFrame:
    """New dimension members with stable surrogate keys behind the largest one of ``dim``
    (one scalar).  They are not stored here; ``jobs.Job.members`` does that durably."""
    top = dim.agg(F.max(key_col)).first()[0] or 0
    return number_members(new_members(candidates, dim, natural_keys), natural_keys, key_col, top + 1,
                          dim.schema[key_col].dataType)


def register_keys(fact: DataFrame, keys: Sequence[str], type_id: int,
                  type_col: str = "fact_type_id") -> DataFrame:
    """Fact keys tagged with the source type (18 air file, 19 hotel,
    17 train, 28 air extract)."""
    return fact.select(*keys).distinct().withColumn(type_col, F.lit(type_id))


def log_step(spark: SparkSession, path: str, batch_id, step: str,
             start: _dt.datetime, end: _dt.datetime) -> None:
    """Append one run-log row (batch, step, start, end)."""
    row = spark.createDataFrame([(batch_id, step, start, end)],
                                "batch_id long, step string, started timestamp, ended timestamp")
    row.write.mode("append").parquet(path)


def drop_rows(df: DataFrame, predicate=None, anti: DataFrame | None = None,
              keys: Sequence[str] | None = None) -> DataFrame:
    """Delete by predicate and/or by an anti-list."""
    out = df if predicate is None else df.where(~predicate)
    if anti is not None:
        out = out.join(anti.select(*keys), list(keys), "left_anti")
    return out
