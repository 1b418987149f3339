"""Corpus pipeline over the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns documents; its result is written as Parquet and read again.  Null
and repeated rows, empty texts and tables are handled as the operators state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from itinera.llm.common import table
from itinera.llm.decontam import keep_uncontaminated
from itinera.llm.minhash import keep_one_of_each
from itinera.llm.pieces import tokenised
from itinera.llm.pii import mask_personal_data
from itinera.llm.quality import keep_good
from itinera.llm.queries import QUERIES as _OPERATORS, SQL
from itinera.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated with benchmark items."""
    return keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind."""
    return mask_personal_data(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the SentencePiece ids, and whether they decode to the text."""
    return tokenised(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("pieces", pieces)]
ORACLE_SQL = None          # trained and hashed stages: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    root = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}-{name}")
        docs = spark.read.parquet(f"{root}/{k}-{name}")
    return docs


QUERIES = {**_OPERATORS, "pipeline": run}
