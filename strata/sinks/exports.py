"""Exports of the gold layer: CSV and documents."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.files import file_system, join_files
from strata.operators.changes import content_differences
from strata.sources.layers import read_documents


class EmptyExport(ValueError):
    """Nothing to export."""


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise EmptyExport("the data to export has no rows")


def export_csv(df: DataFrame, path: str, *, parts: int | None = None) -> None:
    """CSV with a header, replacing ``path``; written in parallel, in ``parts`` files if given.

    Text with a line break is quoted; read it back with the option multiLine.
    """
    if parts is not None:
        # Unlike coalesce, this leaves the work before it as parallel as it was.
        df = df.repartition(parts)
    df.write.mode("overwrite").option("header", True).csv(path)


def export_single_csv(df: DataFrame, parts_path: str, target: str) -> None:
    """One CSV file with a header, at ``target``: parts are written in parallel to
    ``parts_path`` and then joined by copying their bytes, a block at a time."""
    df.write.mode("overwrite").option("header", False).csv(parts_path)
    listed = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*")
    names = sorted(r["path"] for r in listed.load(parts_path).select("path").collect())
    quoted = ['"' + c.replace('"', '\\"') + '"' if "," in c else c for c in df.columns]
    join_files(names, target, (",".join(quoted) + "\n").encode("utf-8"))


def export_documents(
    df: DataFrame,
    path: str | None,
    *,
    fmt: str = "json",
    options: dict[str, str] | None = None,
) -> None:
    """Documents, replacing the target; any format Spark has registered, such as a document store's."""
    require_rows(df)
    writer = df.write.format(fmt).mode("overwrite").options(**(options or {}))
    writer.save(path) if path else writer.save()


class DifferentContent(ValueError):
    """Documents that do not say what they were made from."""


def export_checked(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    fmt: str = "json",
    options: dict[str, str] | None = None,
) -> None:
    """Documents at ``path`` only once they have been read back and hold what ``df`` holds.

    They are written beside the target, compared by content and moved in whole; the former ones
    stay until then, and a failed run leaves them. Raises ``DifferentContent`` otherwise.
    """
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    target = {"fmt": fmt, "options": options}
    export_documents(df, staged, **target)
    copy = read_documents(df.sparkSession, staged, df.schema, **target)
    wrong = content_differences(df, copy, keys).groupBy("cubo").agg(F.count("*").alias("n"))
    found = wrong.orderBy("cubo").limit(10).collect()
    system, new = file_system(staged)
    if found:
        system.delete_dir(new)
        buckets = ", ".join(str(r["cubo"]) for r in found)
        raise DifferentContent(f"documents differ from their source in the buckets {buckets}")
    _, old = file_system(path)
    if system.get_file_info(old).type != fs.FileType.NotFound:
        system.move(old, f"{new}.old")
        system.move(new, old)
        system.delete_dir(f"{new}.old")
    else:
        system.move(new, old)


def verify_documents(
    df: DataFrame,
    path: str | None,
    *,
    fmt: str = "json",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Exported against read-back count (formato, origen, leidos, coincide), in one row."""
    read_back = read_documents(df.sparkSession, path, df.schema, fmt=fmt, options=options)
    zero = F.lit(0).cast("bigint")
    return (
        df.agg(F.count("*").alias("origen"), zero.alias("leidos"))
        .unionByName(read_back.agg(zero.alias("origen"), F.count("*").alias("leidos")))
        .agg(F.sum("origen").alias("origen"), F.sum("leidos").alias("leidos"))
        .select(
            F.lit(fmt).alias("formato"),
            "origen",
            "leidos",
            (F.col("origen") == F.col("leidos")).alias("coincide"),
        )
    )
