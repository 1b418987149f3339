"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.session import checkpoint_dir

# One word of the licence and decontamination contracts, after A-Z is lowered,
# and what stands between words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-/:-`{-\x7F]++"
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays (``lower`` is faster, and the same for ASCII)."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def words_of(text: Column) -> Column:
    """Array of words; null text has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2.  A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def may_learn(doc_id: Column) -> Column:
    """Rows that models may learn from: a known id that is not held out."""
    return doc_id.isNotNull() & ~is_held_out(doc_id)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 arrays (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x
