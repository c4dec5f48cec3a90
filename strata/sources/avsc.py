"""Avro record schemas as Spark schemas."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Avro primitive types and their Spark counterparts.
_PRIMITIVES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "float": FloatType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "bytes": BinaryType(),
}


def struct_from_avsc(text: str) -> StructType:
    """A flat Avro record to a ``StructType``; a union with ``null`` makes the field nullable."""
    record = json.loads(text)
    if record.get("type") != "record":
        raise ValueError("an Avro record schema is needed")
    return StructType([_field(f) for f in record["fields"]])


def _field(declared: dict) -> StructField:
    union = declared["type"] if isinstance(declared["type"], list) else [declared["type"]]
    kinds = [k for k in union if k != "null"]
    if len(kinds) != 1 or kinds[0] not in _PRIMITIVES:
        raise ValueError(f"unsupported Avro type for field {declared['name']}: {declared['type']}")
    return StructField(declared["name"], _PRIMITIVES[kinds[0]], "null" in union)


def read_avsc(spark: SparkSession, path: str) -> StructType:
    """Read one ``.avsc`` file from any file system Spark reaches."""
    return struct_from_avsc(spark.read.text(path, wholetext=True).first()[0])
