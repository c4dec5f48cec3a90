"""Column layout on the way from the raw to the landing layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.specs import partition_last


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def partition_column_last(df: DataFrame, partition_by: str | None) -> DataFrame:
    return df.select(*partition_last(df.columns, partition_by))


def partition_distribution(df: DataFrame, partition_by: str) -> DataFrame:
    """Rows per partition value. Counts are combined before the shuffle."""
    return df.groupBy(F.col(partition_by).alias("particion")).agg(F.count("*").alias("filas"))
