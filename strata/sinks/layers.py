"""Writers for the stored layers."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.files import file_system
from strata.sources import avro
from strata.sources.delimited import DIALECT, LAYER_ENCODING
from strata.specs import ACCEPTED, REJECTED, VERDICT, partition_last

COMPRESSION = "snappy"
MODES = ("full", "incremental")
# Fixed value: the folder of rows whose partition value is NULL.
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def write_raw(
    df: DataFrame, path: str, *, header: bool = False, encoding: str = LAYER_ENCODING
) -> None:
    """Delimited text that keeps blanks, empty text and NULL apart; replaces what was there.

    A line is a row for every reader of the layer, so text must not hold a line break.
    """
    writer = df.write.mode("overwrite").options(**DIALECT)
    writer.option("header", header).option("encoding", encoding).csv(path)


def write_layer(
    df: DataFrame,
    path: str,
    *,
    partition_by: str | None = None,
    mode: str = "full",
    fmt: str = "parquet",
    clustered: bool = False,
    scope: Iterable[str | None] | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Write one entity of a layer.

    ``full`` replaces the entity; ``incremental`` replaces only the partitions that ``df``
    holds, as an option of this write and not of the session. ``scope`` names the partition
    values that an incremental write answers for, NULL among them: those for which ``df`` has
    no row are left without rows.

    A partitioned write first rebalances by the partition column, so that a task does not
    open a file in every partition. Adaptive execution splits a partition value that holds
    much of the data over several tasks and merges small ones. Pass ``clustered=True`` when
    ``df`` was read from storage partitioned the same way: that spares the shuffle.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "incremental" and partition_by is None:
        raise ValueError("an incremental write needs a partition column")
    out = df.select(*partition_last(df.columns, partition_by))
    spark, wanted = df.sparkSession, None if scope is None else set(scope)
    before = []
    if mode == "incremental" and wanted:
        before = _listed(spark, path, partition_by, wanted)
    if partition_by is not None and not clustered:
        out = out.hint("rebalance", partition_by)
    writer = out.write.format(fmt).mode("overwrite").option("compression", COMPRESSION)
    if partition_by is not None:
        overwrite = "dynamic" if mode == "incremental" else "static"
        writer = writer.option("partitionOverwriteMode", overwrite)
    if fmt == avro.FORMAT:
        avro.register(spark)
        if partition_by is not None:
            writer = writer.option("partition_by", out.columns[-1])
    elif partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.options(**(options or {})).save(path)
    if before:
        _drop_stale(before, _listed(spark, path, partition_by, wanted))


def write_judged(
    df: DataFrame,
    path: str,
    *,
    partition_by: str | None = None,
    mode: str = "full",
    scope: Iterable[str | None] | None = None,
) -> None:
    """Accepted and rejected rows (``operators.quality.judged``) in one pass, each side a layer
    of its own under ``judged_path``. ``mode`` and ``scope`` are those of ``write_layer``."""
    columns = partition_last([c for c in df.columns if c != VERDICT], partition_by)
    by = [VERDICT, *([partition_by] if partition_by else [])]
    spark, wanted = df.sparkSession, None if scope is None else set(scope)
    sides = [judged_path(path, verdict) for verdict in (ACCEPTED, REJECTED)]
    before = []
    if mode == "incremental" and wanted:
        before = [f for side in sides for f in _listed(spark, side, partition_by, wanted)]
    out = df.select(*columns, VERDICT)
    if partition_by is not None:
        out = out.hint("rebalance", *by)
    overwrite = "dynamic" if mode == "incremental" else "static"
    writer = out.write.mode("overwrite").option("compression", COMPRESSION)
    writer.option("partitionOverwriteMode", overwrite).partitionBy(*by).parquet(path)
    if before:
        after = [f for side in sides for f in _listed(spark, side, partition_by, wanted)]
        _drop_stale(before, after)
    for side in sides:
        system, base = file_system(side)
        system.create_dir(base, recursive=True)


def judged_path(path: str, verdict: str) -> str:
    """Where the rows of a verdict lie under the path of their entity."""
    return f"{path}/{VERDICT}={verdict}"


def stored_partitions(
    spark: SparkSession,
    path: str,
    partition_by: str,
    wanted: Iterable[str | None] | None = None,
) -> list[str | None]:
    """The partition values that have files under ``path``, from the listing alone.

    With ``wanted`` only the folders of those values are listed. The values are made distinct
    before they reach the driver, files never do.
    """
    return list({value for value, _, _ in _listed(spark, path, partition_by, wanted)})


def _listed(
    spark: SparkSession,
    path: str,
    partition_by: str,
    wanted: Iterable[str | None] | None = None,
) -> list[tuple[str | None, str, str]]:
    """(partition value, folder, its least file) per folder with files under ``path``.

    Values are unescaped, the default partition is NULL.
    """
    wanted = None if wanted is None else set(wanted)
    if wanted is not None and not wanted:
        return []
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    try:
        files = reader.load(f"{path}/{_pattern(partition_by, wanted)}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    name = F.regexp_extract("path", rf"(?i)/{partition_by}=([^/]*)/[^/]*$", 1)
    value = F.when(name != DEFAULT_PARTITION, unescaped(name))
    rows = files.groupBy(value.alias("value"), folder.alias("folder")).agg(F.min("path"))
    return [tuple(r) for r in rows.collect()]


def _pattern(partition_by: str, wanted: set[str | None] | None) -> str:
    """A glob for the folders of partition values, whatever the case of the column."""
    column = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in partition_by)
    if wanted is None:
        return f"{column}=*"
    names = [avro.folder_name("", value)[1:] for value in sorted(wanted, key=str)]
    escaped = [re.sub(r"([\\{}\[\]*?,^])", r"\\\1", n) for n in names]
    return f"{column}={{{','.join(escaped)}}}"


def unescaped(name: Column) -> Column:
    """A partition value from its folder's name, in which %XX stands for a character."""
    return F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _drop_stale(before: list[tuple], after: list[tuple]) -> None:
    """Remove the folders that an overwrite, having no rows for them, left as they were.

    Every write names its files anew, so a folder whose least file is still there was left.
    """
    for _, folder, _ in set(before) & set(after):
        system, base = file_system(folder)
        system.delete_dir(base)


def append_audit(rows: DataFrame, path: str) -> None:
    """Add one run to the audit table, which no full refresh of a layer touches."""
    # A run has one row per entity.
    rows.coalesce(1).write.mode("append").option("compression", COMPRESSION).parquet(path)
