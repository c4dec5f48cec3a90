"""Lookups in time: the state of a key that holds at the moment of a fact.

Histories become intervals, and intervals are cut at the edges of time buckets: a fact then
finds its interval by key and bucket, an equality, and no row meets all of another table. The
intervals of a key and bucket are one row, so a lookup never repeats a fact, and a key that holds
much of the fact is spread over its buckets and, as in any lookup here, set apart when it is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.lookup import is_small, lookup

# Fixed value: joins a key and the first day of a bucket; no date begins with it.
_SEPARATOR = "@"


def as_intervals(history: DataFrame, key: str, since: str, until: str = "hasta") -> DataFrame:
    """``history`` (a row from ``since`` on, per key) with ``until``, where the next one begins.

    The last one of a key is open (NULL). Rows of a key that begin on the same day hold for no
    time but the one that comes last by its other columns; rows without key or day are left out.
    """
    others = [c for c in history.columns if c not in (key, since)]
    order = Window.partitionBy(key).orderBy(since, *others)
    known = history.where(F.col(key).isNotNull() & F.col(since).isNotNull())
    return known.withColumn(until, F.lead(since).over(order))


def interval_lookup(
    fact: DataFrame,
    intervals: DataFrame,
    fact_key: str,
    fact_day: Column,
    key: str,
    since: str,
    until: str,
    attributes: Sequence[str],
    *,
    unit: str = "month",
    strategy: str = "auto",
) -> DataFrame:
    """``fact`` with ``attributes`` of the interval of its key that holds its day, NULL if none.

    An interval holds from ``since`` up to but without ``until``, NULL for open; those of a key
    must not overlap. Intervals are cut to the days that the fact has, so an open one has as many
    pieces as the fact has buckets. A fact without key or day finds nothing. Pieces are counted
    first; only few are ever broadcast.
    """
    edges = fact.agg(F.min(fact_day).alias("first"), F.max(fact_day).alias("last")).first()
    first, last = F.lit(edges["first"]).cast("date"), F.lit(edges["last"]).cast("date")
    held = intervals.where(
        F.col(key).isNotNull()
        & (F.col(since) <= last)
        & (F.col(until).isNull() | (F.col(until) > first) & (F.col(until) > F.col(since)))
    )
    start = F.trunc(F.greatest(F.col(since), first), unit)
    end = F.least(F.coalesce(F.date_sub(F.col(until), 1), last), last)
    step = F.expr(f"INTERVAL 1 {unit}")
    pieces = held.withColumn("_bucket", F.explode(F.sequence(start, end, step)))
    found = F.struct(F.col(since).alias("_since"), F.col(until).alias("_until"), *attributes)
    cells = pieces.groupBy(_cell(F.col(key), F.col("_bucket")).alias("_cell")).agg(
        F.collect_list(found).alias("_held")
    )
    # Spark takes exploded rows for no larger than their source, so by its own estimate it would
    # broadcast any number of cells.
    if not is_small(pieces.select(key, "_bucket", since, until, *attributes)):
        cells = cells.hint("merge")
    own = _cell(F.col(fact_key), F.trunc(fact_day, unit))
    met = lookup(
        fact.withColumn("_own", own), cells, "_own", "_cell", {"_held": "_held"}, "left", strategy
    )

    def holds(x: Column) -> Column:
        return (x["_since"] <= fact_day) & (x["_until"].isNull() | (x["_until"] > fact_day))

    one = F.get(F.filter("_held", holds), 0)
    return met.select(*fact.columns, *[one[a].alias(a) for a in attributes])


def _cell(key: Column, bucket: Column) -> Column:
    return F.concat(key.cast("string"), F.lit(_SEPARATOR), bucket.cast("string"))


def as_of(
    fact: DataFrame,
    history: DataFrame,
    fact_key: str,
    fact_day: Column,
    key: str,
    since: str,
    attributes: Sequence[str],
    **how,
) -> DataFrame:
    """``fact`` with ``attributes`` of the latest row of its key's history that had begun by then."""
    intervals = as_intervals(history.select(key, since, *attributes), key, since)
    return interval_lookup(
        fact, intervals, fact_key, fact_day, key, since, "hasta", attributes, **how
    )
