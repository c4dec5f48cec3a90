"""Readers for the stored layers."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources import avro
from strata.specs import REJECTED, TableSpec


def read_layer(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    fmt: str = "parquet",
    partition_by: str | None = None,
    only: Sequence[str | None] | None = None,
) -> DataFrame:
    """A layer path under its declared schema; ``only`` limits it to some partition values.

    Declaring the schema skips footer inference and keeps a date-like partition
    column STRING; filters on that column still prune directories. The Avro source is told the
    values, as filters do not reach it.
    """
    reader = spark.read.format(fmt).schema(schema)
    if fmt == avro.FORMAT:
        avro.register(spark)
        if partition_by is not None and only is not None:
            wanted = json.dumps(sorted(set(only), key=lambda v: (v is not None, v)))
            reader = reader.option("partition_by", partition_by).option("only", wanted)
    df = reader.load(path)
    return df if partition_by is None or only is None else df.where(among(partition_by, only))


def read_judged(spark: SparkSession, path: str, spec: TableSpec, verdict: str) -> DataFrame:
    """One side of what ``write_judged`` wrote, rejected rows with their motivos."""
    schema = spec.curated.add("motivos", "string").add("veredicto", "string")
    df = read_layer(spark, path, schema, partition_by="veredicto", only=[verdict])
    own = [*spec.curated.fieldNames(), *(["motivos"] if verdict == REJECTED else [])]
    return df.select(*own)


def among(column: str, values: Sequence[str | None]) -> Column:
    """Whether a column has one of the values, NULL among them if it is named."""
    named = F.col(column).isin([v for v in values if v is not None])
    return named | F.col(column).isNull() if None in values else named


def read_documents(
    spark: SparkSession,
    path: str | None,
    schema: StructType | None = None,
    *,
    fmt: str = "json",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Documents from any registered format; ``path`` is None for stores addressed by options."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()
