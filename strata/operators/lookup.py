"""Attribute lookup: join a fact to a dimension and take named columns from it.

Strategies
----------
auto       Leave it to Spark: broadcast below its size threshold, otherwise a shuffled
           join whose skewed partitions adaptive execution splits.
broadcast  Measure the columns needed; broadcast if they are within the bound,
           otherwise go on as ``isolate``.
shuffle    Force the sort-merge join.
isolate    Keys holding a large share of the fact join their few dimension rows by
           broadcast, and no longer by their key; the other keys join as in ``auto``.

Every strategy gives the same rows. Duplicate dimension keys multiply fact rows in all of them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

STRATEGIES = ("auto", "broadcast", "shuffle", "isolate")

# A dimension is small below this many rows and up to this many bytes.
SMALL_ROWS = 100_000
SMALL_BYTES = 104_857_600

# A key is hot above this share of the fact's rows.
HOT_SHARE = 0.01
_MOST_HOT = 100
# Sketch entries; its counts are then off by less than a thousandth of the rows.
_TRACKED = 10_000

_KEY = "_lookup_key"
_HOT_KEY, _HOT_ROW, _COLD_ROW = "_hot_key", "_hot_row", "_cold_row"
_LANE, _COLD_LANE = "_lane", "_cold_lane"
_ROW_OVERHEAD = 64
_FIXED_WIDTH = 16


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> bool:
    """Whether ``df`` is within a broadcast bound, by measuring it.

    Rows are counted first, which for a stored dimension reads no column; only few rows are
    then read for their size.
    """
    if df.count() >= max_rows:
        return False
    sizes = [
        F.coalesce(F.octet_length(f.name), F.lit(0)) + _FIXED_WIDTH
        if isinstance(f.dataType, StringType | BinaryType)
        else F.lit(_FIXED_WIDTH)
        for f in df.schema
    ]
    row_size = reduce(lambda a, b: a + b, sizes, F.lit(_ROW_OVERHEAD))
    return (df.agg(F.sum(row_size)).first()[0] or 0) <= max_bytes


def hot_keys(df: DataFrame, *keys: str) -> dict[str, list]:
    """For each key column the values, NULL included, that hold more than ``HOT_SHARE`` of all rows.

    One pass with a frequent-items sketch per column: bounded memory, no shuffle by key and at
    most ``1 / HOT_SHARE`` values each. Counts are approximate, which is enough: the list
    decides how rows travel, never which rows come out.
    """
    sketches = [
        F.call_function("approx_top_k", F.col(k), F.lit(_MOST_HOT), F.lit(_TRACKED)).alias(k)
        for k in keys
    ]
    row = df.agg(F.count("*").alias("_rows"), *sketches).first()
    limit = row["_rows"] * HOT_SHARE
    return {k: [i["item"] for i in row[k] if i["count"] > limit] for k in keys}


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    attributes: Mapping[str, str],
    how: str = "left",
    strategy: str = "auto",
    hot: list | None = None,
) -> DataFrame:
    """``fact`` plus ``attributes`` (dimension column -> new name) of the matching rows.

    Keys compare as they are: no trimming and no cast. ``hot`` spares ``isolate`` the pass
    over the fact that finds the hot keys.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    right = dimension.select(
        F.col(dimension_key).alias(_KEY), *[F.col(c).alias(n) for c, n in attributes.items()]
    )
    if strategy == "broadcast":
        if is_small(right):
            return _join(fact, F.broadcast(right), fact_key, how)
        strategy = "isolate"
    if strategy == "isolate":
        hot = hot_keys(fact, fact_key)[fact_key] if hot is None else hot
        return _join_isolated(fact, right, fact_key, how, hot)
    return _join(fact, right.hint("merge") if strategy == "shuffle" else right, fact_key, how)


def _join(fact: DataFrame, right: DataFrame, fact_key: str, how: str) -> DataFrame:
    return fact.join(right, F.col(fact_key) == F.col(_KEY), how).drop(_KEY)


def _join_isolated(
    fact: DataFrame, right: DataFrame, fact_key: str, how: str, hot: list
) -> DataFrame:
    """Hot keys meet their dimension rows by broadcast, the others by the usual join.

    The fact is read once and passes both joins: a row with a hot key enters the second one
    under a lane that no dimension row has, so that its key does not gather it in one task.
    Lanes come from the row and the number of its input partition, so that they are the same
    when a task is retried and copies of a row still spread.
    """
    key = F.col(fact_key)
    values = [v for v in hot if v is not None]
    hot_right = right.where(F.col(_KEY).isin(values))
    if not (values or None in hot) or not is_small(hot_right):
        return _join(fact, right, fact_key, how)
    attributes = [c for c in right.columns if c != _KEY]
    first = hot_right.select(
        F.col(_KEY).alias(_HOT_KEY), F.struct(*attributes).alias(_HOT_ROW)
    )
    # Missing keys match nothing, yet a shuffle would send them all to one partition.
    apart = F.coalesce(key.isin(values), F.lit(False)) | key.isNull()
    spread = F.xxhash64(*fact.columns, F.spark_partition_id()).bitwiseOR(F.lit(1))
    lanes = fact.join(F.broadcast(first), key == F.col(_HOT_KEY), "left").withColumn(
        _LANE, F.when(apart, spread).otherwise(F.lit(0).cast("bigint"))
    )
    second = right.where(~F.col(_KEY).isin(values)).select(
        _KEY, F.struct(*attributes).alias(_COLD_ROW), F.lit(0).cast("bigint").alias(_COLD_LANE)
    )
    met = lanes.join(
        second, (key == F.col(_KEY)) & (F.col(_LANE) == F.col(_COLD_LANE)), "left"
    ).withColumn(_HOT_ROW, F.coalesce(_HOT_ROW, _COLD_ROW))
    if how == "inner":
        met = met.where(F.col(_HOT_ROW).isNotNull())
    return met.select(*fact.columns, *[F.col(f"{_HOT_ROW}.{c}").alias(c) for c in attributes])
