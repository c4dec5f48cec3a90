"""Raw to landing as a stream of files.

A run takes all files that have arrived since the last one, in batches, and ends. Which files
belong to a batch is in the checkpoint before the batch is written; the batch is written under
its own number, replacing what an earlier attempt of the same number has left. So a run that was
killed at any point is just run again, and rows come once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from strata.operators.layout import lower_names
from strata.plans.stages import LANDING, Lake
from strata.sinks.layers import COMPRESSION
from strata.sources.delimited import DIALECT, INPUT_ENCODING
from strata.specs import TableSpec

# The column, and folder, that names the batch a row came with.
BATCH = "lote"


def stream_path(lake: Lake, spec: TableSpec) -> str:
    return lake.path(f"{LANDING}_stream", spec.name)


def run_landing_stream(
    lake: Lake,
    spec: TableSpec,
    deliveries: str,
    *,
    header: bool = True,
    files_per_batch: int | None = None,
) -> None:
    """Land the delimited files under ``deliveries`` that no earlier run has landed.

    Files must appear there whole, under names of their own. Offsets are kept in the lake.
    """
    spark = lake.spark
    reader = spark.readStream.schema(spec.raw).options(**DIALECT)
    reader = reader.option("header", header).option("encoding", INPUT_ENCODING)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    target, by = stream_path(lake, spec), spec.partition_by and spec.partition_by.lower()

    def land(batch: DataFrame, number: int) -> None:
        numbered = lower_names(batch).withColumn(BATCH, F.lit(number))
        if by is not None:
            numbered = numbered.hint("rebalance", by)
        writer = numbered.write.mode("overwrite").option("compression", COMPRESSION)
        writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH, *([by] if by else [])).parquet(target)

    query = (
        reader.csv(deliveries)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", lake.path("control", f"stream_{spec.name}"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed(lake: Lake, spec: TableSpec) -> DataFrame:
    """What the stream has landed so far, in the columns of landing; ``lote`` prunes batches."""
    schema = spec.landing.add(BATCH, IntegerType())
    try:
        return lake.spark.read.schema(schema).parquet(stream_path(lake, spec))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return lake.spark.createDataFrame([], schema)
