"""What differs between two states of a table: keys, partitions, rows.

Bags of rows are compared, so a lost copy counts like a changed value. Digests are sums of two
64-bit hashes per row and do not depend on the order of rows; sums are combined before they are
shuffled, so a partition or bucket that holds a third of all rows is a few rows by then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.lookup import is_small

# Names of what a digest holds.
DIGEST = ("filas", "huella_a", "huella_b")


def _marked(columns: Sequence[str]) -> list[Column]:
    """Columns with a flag each, as a hash passes over NULL and would mix up its neighbours."""
    return [x for c in columns for x in (F.col(c), F.col(c).isNull())]


def bag_digest(columns: Sequence[str]) -> list[Column]:
    """Aggregates (filas, huella_a, huella_b) that are equal for equal bags of rows, and for
    others with a chance of about 2^-128 only."""
    hashes = (F.xxhash64(*_marked(columns)), F.xxhash64(F.lit(1), *_marked(columns)))
    sums = [F.sum(h.cast("decimal(20,0)")).alias(n) for h, n in zip(hashes, DIGEST[1:], strict=True)]
    return [F.count("*").alias(DIGEST[0]), *sums]


def partition_digests(df: DataFrame, by: str) -> DataFrame:
    """(particion, filas, huella_a, huella_b) per value of ``by``, NULL among them."""
    others = sorted(c for c in df.columns if c != by)
    return df.groupBy(F.col(by).alias("particion")).agg(*bag_digest(others))


def differing(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Digests by ``key`` that are in one table only or differ: the key and both row counts.

    Both sides become one table and are grouped, so NULL keys meet and nothing is joined.
    """

    def side(df: DataFrame, own: str) -> DataFrame:
        filled = [
            (F.col(c) if name == own else F.lit(None).cast(df.schema[c].dataType)).alias(f"{name}_{c}")
            for name in ("antes", "despues")
            for c in DIGEST
        ]
        return df.select(key, *filled)

    both = side(before, "antes").unionByName(side(after, "despues"))
    met = both.groupBy(key).agg(*[F.max(c).alias(c) for c in both.columns if c != key])
    same = F.lit(True)
    for c in DIGEST:
        same = same & F.col(f"antes_{c}").eqNullSafe(F.col(f"despues_{c}"))
    return met.where(~same).select(
        key, *[F.coalesce(f"{n}_filas", F.lit(0)).alias(f"{n}_filas") for n in ("antes", "despues")]
    )


def row_differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """Every row whose number of copies differs, with ``veces``: copies after less copies before."""
    columns = before.columns
    both = before.withColumn("veces", F.lit(-1)).unionByName(
        after.select(columns).withColumn("veces", F.lit(1))
    )
    return both.groupBy(*columns).agg(F.sum("veces").alias("veces")).where("veces <> 0")


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """The keys, not NULL, whose rows differ between two snapshots of a dimension."""
    return row_differences(before, after).where(F.col(key).isNotNull()).select(key).distinct()


def values_of(fact: DataFrame, fact_key: str, keys: DataFrame, key: str, wanted: str) -> DataFrame:
    """The distinct values of ``wanted`` among the fact rows with one of ``keys``.

    The fact is made distinct by key and value first, so a hot key meets the join once a value.
    """
    pairs = fact.select(fact_key, wanted).distinct()
    right = keys.select(F.col(key).alias("_key"))
    right = F.broadcast(right) if is_small(right) else right
    return pairs.join(right, F.col(fact_key) == F.col("_key"), "left_semi").select(wanted).distinct()


# --- documents --------------------------------------------------------------------------

BUCKETS = 4096


def bucket_digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(cubo, filas, huella_a, huella_b) by a hash of the keys."""
    bucket = F.pmod(F.xxhash64(*_marked(keys)), F.lit(buckets)).cast("int")
    return df.groupBy(bucket.alias("cubo")).agg(*bag_digest(sorted(df.columns)))


def content_differences(
    source: DataFrame, copy: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Rows that a copy has lost, doubled or changed: all columns, ``cubo`` and ``veces``.

    First only digests by bucket are compared. Rows are then looked at in the buckets that
    differ, which for a good copy are none; there are at most ``buckets`` of them, so they are
    broadcast. A changed row shows as one lost and one in excess, in the same bucket if the
    change spared its keys.
    """
    bucket = F.pmod(F.xxhash64(*_marked(keys)), F.lit(buckets)).cast("int")
    wrong = differing(
        bucket_digests(source, keys, buckets), bucket_digests(copy, keys, buckets), "cubo"
    ).select("cubo")

    def suspects(df: DataFrame) -> DataFrame:
        return df.select(source.columns).withColumn("cubo", bucket).join(F.broadcast(wrong), "cubo")

    return row_differences(suspects(source), suspects(copy))
