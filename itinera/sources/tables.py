"""Readers.  Every fact is a parquet table partitioned by its batch id, so a
run reads one slice through partition pruning and pushed-down filters."""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, root: str, name: str, schema: StructType | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """A parquet table by name under ``root`` (explicit schema when given)."""
    r = spark.read if schema is None else spark.read.schema(schema)
    try:
        df = r.parquet(f"{root}/{name.removesuffix('.parquet')}.parquet")
    except AnalysisException as e:          # Spark looks, so any shared file system will do
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = r.parquet(f"{root}/{name}")
    return df.select(*columns) if columns else df


def read_slice(df: DataFrame, batch_col: str, batch_id) -> DataFrame:
    """One batch of a fact or stage table (partition pruning on the column)."""
    return df.where(F.col(batch_col) == F.lit(batch_id))


def sales_lines(invoice: DataFrame, credit: DataFrame, tag_col: str = "doc_kind") -> DataFrame:
    """Invoice and credit lines as one relation with a type tag."""
    return (invoice.withColumn(tag_col, F.lit("I"))
            .unionByName(credit.withColumn(tag_col, F.lit("C")), allowMissingColumns=True))


def latest_extract(df: DataFrame, source_col: str, batch_col: str,
                   complete_col: str | None = None) -> DataFrame:
    """Rows of the newest (complete) extract of each source.  The per-source
    maximum is one row per source, so it is broadcast; nothing is collected."""
    src = df.where(F.col(complete_col)) if complete_col else df
    newest = src.groupBy(source_col).agg(F.max(batch_col).alias(batch_col))
    return df.join(F.broadcast(newest), [source_col, batch_col], "left_semi")


def literal_dim(spark: SparkSession, rows: list, schema) -> DataFrame:
    """A literal lookup table (fixed values), marked for broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def like(df: DataFrame, changes: dict | None = None) -> DataFrame:
    """Empty clone of a schema, optionally with columns re-typed."""
    out = df.limit(0)
    for c, t in (changes or {}).items():
        out = out.withColumn(c, F.col(c).cast(t))
    return out
