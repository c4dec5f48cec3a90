"""Session, SQL engine and row comparison shared by the tests and ``check.py``."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("strata")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str, tables=TABLES):
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df: DataFrame, con, sql: str | None) -> str | None:
    """What differs between a query and its SQL, as text; None when nothing does."""
    if sql is None:
        return None if df.count() >= 0 else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    wanted, found = _bag(result.fetchall(), names), _bag(df.collect(), df.columns)
    if wanted == found:
        return None
    missing, extra = wanted - found, found - wanted
    return (
        f"rows {sum(found.values())} against {sum(wanted.values())}; "
        f"missing {list(missing)[:2]}; extra {list(extra)[:2]}"
    )


def rows(df: DataFrame) -> Counter:
    """The rows of ``df`` without their order."""
    return _bag(df.collect(), df.columns)


def plan(df: DataFrame) -> str:
    """The physical plan as text, before anything runs."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted"
    )
