"""Summaries that are made once and merged: sketches per date, cubes, samples per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Logarithm of the registers of a distinct count, and the standard error that comes with it.
DISTINCT_BITS = 12
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)
# Size of a quantile sketch; a rank is then off by at most this share, in 99 of 100 cases.
QUANTILE_SIZE = 400
RANK_ERROR = 0.0075


# --- sketches ---------------------------------------------------------------------------


def sketches(df: DataFrame, by: str, entity: str, amount: str) -> DataFrame:
    """Per value of ``by``: rows, amounts (count, sum, least, greatest), and two sketches, of the
    distinct ``entity`` and of the quantiles of ``amount``. One pass; a date is one row."""
    value = F.col(amount)
    return df.groupBy(by).agg(
        F.count("*").alias("filas"),
        F.count(value).alias("importes"),
        F.sum(value).alias("suma"),
        F.min(value).alias("minimo"),
        F.max(value).alias("maximo"),
        F.hll_sketch_agg(entity, DISTINCT_BITS).alias("distintos"),
        F.kll_sketch_agg_double(value.cast("double"), QUANTILE_SIZE).alias("cuantiles"),
    )


def merged(parts: DataFrame, *keys: str | Column, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Metrics by ``keys`` (of everything without) from ``sketches``: filas, promedio, minimo,
    maximo, distintos (estimate) and one column a quantile (cuantil_50 for 0.5)."""
    whole = parts.groupBy(*keys).agg(
        F.sum("filas").alias("filas"),
        F.sum("importes").alias("importes"),
        F.sum("suma").alias("suma"),
        F.min("minimo").alias("minimo"),
        F.max("maximo").alias("maximo"),
        F.hll_sketch_estimate(F.hll_union_agg("distintos")).alias("distintos"),
        F.kll_merge_agg_double("cuantiles", F.lit(QUANTILE_SIZE)).alias("_cuantiles"),
    )
    names = [c for c in whole.columns if c not in ("filas", "importes", "suma", "minimo", "maximo", "distintos", "_cuantiles")]
    found = [
        F.when(
            F.col("importes") > 0, F.kll_sketch_get_quantile_double("_cuantiles", F.lit(float(q)))
        ).alias(f"cuantil_{round(q * 100)}")
        for q in quantiles
    ]
    average = F.when(F.col("importes") > 0, F.col("suma") / F.col("importes"))
    return whole.select(
        *names, "filas", average.alias("promedio"), "minimo", "maximo", "distintos", *found
    )


# --- cubes ------------------------------------------------------------------------------


def cube(df: DataFrame, keys: Sequence[str], entity: str, amount: str) -> DataFrame:
    """Metrics of every subset of ``keys``: keys, nivel, filas, importes (rows with an amount),
    suma, promedio, minimo, maximo and the exact number of distinct ``entity`` (distintos).

    ``nivel`` has a bit per key, the first the highest, set where the key is summed up; a key that
    is NULL itself stays apart. The fact is aggregated once, by all keys and the entity. Coarser
    cells come from those sums, first by entity and then without, so even the cell of everything
    is combined before it meets one task.
    """
    value = F.col(amount)
    finest = df.groupBy(*keys, entity).agg(
        F.count("*").alias("filas"),
        F.count(value).alias("importes"),
        F.sum(value).alias("suma"),
        F.min(value).alias("minimo"),
        F.max(value).alias("maximo"),
    )
    levels = []
    for level in range(1 << len(keys)):
        kept = [not level >> (len(keys) - 1 - i) & 1 for i in range(len(keys))]
        own = [
            (F.col(k) if keep else F.lit(None).cast(df.schema[k].dataType)).alias(k)
            for k, keep in zip(keys, kept, strict=True)
        ]
        levels.append(F.struct(*own, F.lit(level).alias("nivel")))
    sums = [
        F.sum("filas").alias("filas"),
        F.sum("importes").alias("importes"),
        F.sum("suma").alias("suma"),
        F.min("minimo").alias("minimo"),
        F.max("maximo").alias("maximo"),
    ]
    spread = finest.select(
        F.explode(F.array(*levels)).alias("_cell"), *[c for c in finest.columns if c not in keys]
    ).select("_cell.*", *[c for c in finest.columns if c not in keys])
    by_entity = spread.groupBy(*keys, "nivel", entity).agg(*sums)
    cells = by_entity.groupBy(*keys, "nivel").agg(*sums, F.count(entity).alias("distintos"))
    average = F.when(F.col("importes") > 0, F.col("suma") / F.col("importes"))
    return cells.withColumn("promedio", average)


# --- samples ----------------------------------------------------------------------------


def row_hash(columns: Sequence[str]) -> Column:
    """md5 of a row: each value as text with its length in front, a dash where it is missing."""
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(*parts).cast("binary"))


def fair_sample(df: DataFrame, by: str, count: int) -> DataFrame:
    """``count`` rows of every value of ``by``, or all it has: those of least row hash.

    The same rows at any partitioning, and of a union those of the samples. A task keeps
    ``count`` rows a value while it reads, so what it holds, and what is shuffled and ranked
    afterwards, does not grow with the rows of a value.
    """
    columns, order = df.columns, "_hash"
    hashed = df.withColumn(order, row_hash(columns))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            if table.num_rows:
                kept = _first(table.combine_chunks(), by, order, count)
        if kept is not None:
            yield from kept.to_batches()

    few = hashed.mapInArrow(least, hashed.schema)
    rank = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= count).select(*columns)


def _first(table: pa.Table, by: str, order: str, count: int) -> pa.Table:
    """The first ``count`` rows of each value."""
    table = table.take(pc.sort_indices(table, [(by, "ascending"), (order, "ascending")]))
    codes = table[by].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    start = [0, *((codes[1:] != codes[:-1]).nonzero()[0] + 1).tolist(), len(codes)]
    rows = [i for a, b in zip(start, start[1:], strict=False) for i in range(a, min(b, a + count))]
    return table.take(pa.array(rows, pa.int64()))
