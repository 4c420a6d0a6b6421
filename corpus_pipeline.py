"""A corpus pipeline over ``documents``: toxicity, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept, in Python in small batches; every stage but
the last returns the columns of ``documents``, further columns included, whatever their names.  A null text counts
as an empty one; rows with a null id stay unless they are copies; a table without rows gives no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dwkit.llm.exact_dedup import drop_exact_copies
from dwkit.llm.minhash import drop_near_copies
from dwkit.llm.packing import pack
from dwkit.llm.pii import redact
from dwkit.llm.toxicity import drop_toxic
from dwkit.session import bound_batches, materialize

#: The stages need Spark jobs between them (model fits, component rounds): no single statement.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts toxic go; empty texts have no toxic words, repeated rows share their fate."""
    bound_batches(spark)
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, empty ones too, the one with the smallest id stays; of rows that repeat id and text one stays."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts that share 0.8 of their five-word shingles the smallest id stays; texts without words are
    no copies of each other."""
    bound_batches(spark)
    return drop_near_copies(docs, words=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind in brackets; texts without any, null ones too, stay as they are."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows: one row per piece of a document; an empty text is its closing token."""
    bound_batches(spark)
    return pack(docs)


STAGES = [("toxicity", toxicity), ("exact_copies", exact_copies), ("near_copies", near_copies),
          ("personal_data", personal_data), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
