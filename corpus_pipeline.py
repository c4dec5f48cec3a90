"""The corpus pipeline: filters and dedup over ``documents``, then packing.

Each stage takes what its predecessor kept, written as Parquet and read again, so a lost
executor costs a stage at most. The classifiers learn from ``documents`` and ``labels`` of the
folder, whatever the stage's own input still holds of them.

Missing texts are empty ones, rows without doc_id are judged by their text and stay in near
deduplication, repeated rows are exact copies of which one stays, further columns come through as
they are under any name, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact, packing, quality, simhash, toxicity
from strata.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels")
    return quality.drop_poor(docs, quality.fit(table(spark, sf_dir, "documents"), labels))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, toxicity.fit(table(spark, sf_dir, "documents"), labels))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of the largest doc_id."""
    return exact.drop_duplicates(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-equal documents the one of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of what is left lies."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", simhash_stage),
    ("packing", packing_stage),
]

# SQL can express neither the classifiers nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the pieces of the documents that are left."""
    docs = table(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
