"""Pipe-delimited text, read under a fixed schema and never inferred by default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The text dialect, the same for reading and writing. Unquoted nothing reads as
# NULL and a quoted "" as empty text, which is also how the writer tells them apart.
DIALECT = {
    "sep": "|",
    "nullValue": r"\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
INPUT_ENCODING = "ISO-8859-1"
LAYER_ENCODING = "UTF-8"


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    header: bool = True,
    encoding: str = INPUT_ENCODING,
) -> DataFrame:
    """Delivered files: columns by position, header skipped, bad rows padded or cut.

    The scan is splittable (one record per line), so a single large file is read in parallel.
    """
    reader = spark.read.schema(schema).options(**DIALECT)
    return reader.option("header", header).option("encoding", encoding).csv(path)


def read_raw(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The raw layer as ``write_raw`` stores it: UTF-8 and without a header."""
    return read_delimited(spark, path, schema, header=False, encoding=LAYER_ENCODING)


def read_csv_export(
    spark: SparkSession, path: str, schema: StructType | None = None, *, infer: bool = False
) -> DataFrame:
    """An exported CSV: under ``schema``, or with inferred types when ``infer`` is set.

    Inference costs a second pass over the files and turns date text into DATE.
    """
    if infer == (schema is not None):
        raise ValueError("give either a schema or infer=True")
    reader = spark.read.option("header", True).option("encoding", LAYER_ENCODING)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)
