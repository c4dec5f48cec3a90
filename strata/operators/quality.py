"""Typing, quality rules and the acceptance report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import lenient
from strata.specs import ACCEPTED, AUDIT, REJECTED, TableSpec

REPORT_COLUMNS = ["tabla", "origen", "curated", "rechazados", "calidad_pct"]


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with the columns, order and types of the curated schema; bad values become NULL."""
    by_name = {c.lower(): c for c in df.columns}
    return df.select(
        *[lenient(F.col(by_name[f.name.lower()]), f.dataType).alias(f.name) for f in spec.curated]
    )


def accepted(spec: TableSpec) -> Column:
    """Whether a typed row passes every rule; a rule that yields NULL fails."""
    verdict = F.lit(True)
    for rule in spec.rules.values():
        verdict = verdict & F.expr(rule)
    return F.coalesce(verdict, F.lit(False))


def apply_rules(df: DataFrame, spec: TableSpec, *, validate: bool = True) -> DataFrame:
    """Type ``df`` and keep the rows that pass; ``validate=False`` only types it."""
    out = typed(df, spec)
    if validate:
        for rule in spec.rules.values():
            out = out.where(rule)
    return out


def broken_rules(spec: TableSpec) -> Column:
    """The rules that a typed row fails, as bits in the order of the rules; 0 if it is accepted."""
    mask = F.lit(0)
    for bit, rule in enumerate(spec.rules.values()):
        passed = F.coalesce(F.expr(rule), F.lit(False))
        mask = mask + F.when(passed, 0).otherwise(1 << bit)
    return mask.cast("int")


def reasons(spec: TableSpec, mask: Column) -> Column:
    """The names of the rules whose bits are set, comma-joined."""
    names = [
        F.when(mask.bitwiseAND(1 << bit) != 0, F.lit(name)) for bit, name in enumerate(spec.rules)
    ]
    return F.concat_ws(",", *names)


def judged(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every row of ``df``, typed, with ``veredicto`` and the names of the rules it fails
    (``motivos``, NULL for accepted rows)."""
    mask = F.col("_mask")
    return (
        typed(df, spec)
        .withColumn("_mask", broken_rules(spec))
        .withColumn("motivos", F.when(mask != 0, reasons(spec, mask)))
        .withColumn("veredicto", F.when(mask == 0, ACCEPTED).otherwise(REJECTED))
        .drop("_mask")
    )


def quality_reasons(sources: Iterable[tuple[TableSpec, DataFrame]]) -> DataFrame:
    """(tabla, motivos, filas): rows by the set of rules they fail, from one pass per entity.

    Accepted rows have no motivos. There are at most 2^rules sets, summed before the shuffle.
    """
    parts = []
    for spec, df in sources:
        counts = (
            typed(df, spec)
            .groupBy(broken_rules(spec).alias("_mask"))
            .agg(F.count("*").alias("filas"))
        )
        named = F.when(F.col("_mask") != 0, reasons(spec, F.col("_mask")))
        parts.append(counts.select(F.lit(spec.name).alias("tabla"), named.alias("motivos"), "filas"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def quality_report(sources: Iterable[tuple[TableSpec, DataFrame]]) -> DataFrame:
    """One row per entity, each from a single pass over its untyped source."""
    return _stack(
        typed(df, spec)
        .agg(F.count("*").alias("origen"), F.count_if(accepted(spec)).alias("curated"))
        .select(F.lit(spec.name).alias("tabla"), "origen", "curated")
        for spec, df in sources
    )


def stored_report(pairs: Iterable[tuple[TableSpec, DataFrame, DataFrame]]) -> DataFrame:
    """The same report from (spec, source layer, curated layer) as they lie in storage.

    Both sides are bare row counts, which a columnar scan answers without reading a column,
    and which stay right when tasks of the write were retried.
    """
    return _stack(
        source.agg(F.count("*").alias("origen"), F.lit(0).cast("bigint").alias("curated"))
        .unionByName(
            curated.agg(F.lit(0).cast("bigint").alias("origen"), F.count("*").alias("curated"))
        )
        .agg(F.sum("origen").alias("origen"), F.sum("curated").alias("curated"))
        .select(F.lit(spec.name).alias("tabla"), "origen", "curated")
        for spec, source, curated in pairs
    )


def audit_rows(report: DataFrame, executed_at: str) -> DataFrame:
    """A report stamped with its run, in the layout of the audit table."""
    return report.withColumn("ejecucion", F.lit(executed_at)).select(*AUDIT.fieldNames())


def _stack(parts: Iterable[DataFrame]) -> DataFrame:
    first, *others = list(parts)
    for other in others:
        first = first.unionByName(other)
    ratio = F.col("curated").cast("double") / F.col("origen") * 100
    return first.select(
        "tabla",
        "origen",
        "curated",
        (F.col("origen") - F.col("curated")).alias("rechazados"),
        F.when(F.col("origen") > 0, ratio).otherwise(F.lit(100.0)).alias("calidad_pct"),
    )
