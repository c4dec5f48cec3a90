"""Layers as catalog tables: databases, tables, inserts, partitions and storage checks.

Works with the in-memory catalog as well as a metastore: tables are data source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sinks.layers import COMPRESSION
from strata.specs import partition_last


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def recreate_database(spark: SparkSession, name: str, location: str) -> str:
    """Full refresh of a layer: drop the database with all it holds and create it empty."""
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(name)} CASCADE")
    return create_database(spark, name, location)


def create_database(spark: SparkSession, name: str, location: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)} LOCATION {_literal(location)}")
    return name


def drop_table(spark: SparkSession, table: str) -> None:
    """Forget an external table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    location: str,
    *,
    partition_by: str | None = None,
    fmt: str = "parquet",
    incremental: bool = True,
    options: dict[str, str] | None = None,
) -> str:
    """An external table, its partition column matched without regard to case and put last.

    Whether an overwrite keeps the partitions it does not mention is a property of the
    table, so that inserts need no session setting.
    """
    ordered = partition_last(schema.fieldNames(), partition_by)
    columns = ", ".join(f"{_quoted(c)} {schema[c].dataType.simpleString()}" for c in ordered)
    partitioned = f"PARTITIONED BY ({_quoted(ordered[-1])})" if partition_by else ""
    settings = {
        "compression": COMPRESSION,
        "partitionOverwriteMode": "dynamic" if incremental else "static",
        **(options or {}),
    }
    listed = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in settings.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) USING {fmt} "
        f"OPTIONS ({listed}) {partitioned} LOCATION {_literal(location)}"
    )
    return table


def insert_overwrite(
    df: DataFrame, table: str, *, partition_by: str | None = None, clustered: bool = False
) -> None:
    """Insert by position, after putting ``df`` in the table's column order."""
    out = df.select(*df.sparkSession.table(table).columns)
    if partition_by is not None and not clustered:
        out = out.hint("rebalance", partition_by)
    out.write.insertInto(table, overwrite=True)


def register_partitions(spark: SparkSession, table: str) -> None:
    """Pick up partition folders written to the table's path by other means."""
    spark.sql(f"MSCK REPAIR TABLE {_quoted(table)}")


def table_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_quoted(table)}")


def layer_tables(spark: SparkSession, database: str) -> DataFrame:
    """The tables of a layer (tabla)."""
    return (
        spark.sql(f"SHOW TABLES IN {_quoted(database)}")
        .where("NOT isTemporary")
        .select(F.col("tableName").alias("tabla"))
    )


def append_or_create(rows: DataFrame, table: str, location: str) -> None:
    """Append to the audit table, made on first use."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        create_table(spark, table, rows.schema, location)
    # A run has one row per entity.
    rows.coalesce(1).select(*spark.table(table).columns).write.insertInto(table)


def storage_format(spark: SparkSession, table: str) -> DataFrame:
    """What the catalog says of a table (tabla, formato, compresion), as one row."""
    described = spark.sql(f"DESCRIBE FORMATTED {_quoted(table)}")

    def value_of(name: str):
        return F.max(F.when(F.col("col_name") == name, F.col("data_type")))

    return described.where(F.col("col_name").isin("Provider", "Storage Properties")).agg(
        F.lit(table.rsplit(".", 1)[-1]).alias("tabla"),
        value_of("Provider").alias("formato"),
        F.regexp_extract(value_of("Storage Properties"), r"compression=(\w+)", 1).alias(
            "compresion"
        ),
    )


def stored_files(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """Files and bytes per codec that really lie under ``location``; no file is opened."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{fmt}")
        .load(location)
        .select("path", "length")
    )
    codec = F.regexp_extract("path", rf"\.(\w+)\.{fmt}$", 1)
    return listing.groupBy(codec.alias("codec")).agg(
        F.count("*").alias("archivos"), F.sum("length").alias("bytes")
    )


def assert_storage(spark: SparkSession, table: str, location: str, fmt: str = "parquet") -> None:
    """Raise unless catalog and files agree on the format and on Snappy compression."""
    row = storage_format(spark, table).first()
    if (row["formato"], row["compresion"]) != (fmt, COMPRESSION):
        raise ValueError(f"{table} is declared {row['formato']} with {row['compresion']}")
    others = [r["codec"] for r in stored_files(spark, location, fmt).collect()]
    if any(codec != COMPRESSION for codec in others):
        raise ValueError(f"{table} holds files compressed as {others}")
