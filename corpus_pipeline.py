"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet and hands what it reads back to the next one. All stages but the
last return the columns of ``documents``. They work on all rows they are given,
with the operators' production parameters.

Nulls, empty texts, repeated rows, empty tables and extra columns are handled
as the operators' docstrings say; extra columns stay up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch.llm.common import stored, table
from riverwatch.llm.mixing import mixed_documents
from riverwatch.llm.packing import pack_documents
from riverwatch.llm.quality import kept_documents
from riverwatch.llm.secrets import without_secrets
from riverwatch.llm.simhash import first_of_each


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return kept_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that with the smallest doc_id."""
    return first_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; n_chars follows the text that has changed."""
    kept = docs.withColumn("__before", F.col("text"))
    masked = without_secrets(kept)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.when(
            F.col("text").eqNullSafe(F.col("__before")), F.col("n_chars"))
            .otherwise(F.length("text").cast(kind)))
    return masked.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is repeated or thinned to its target weight."""
    return mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return pack_documents(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("secret scans", secrets_stage),
    ("mixing sources", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL has no XXH64 and no tokenizer; the pipeline is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
