"""Metrics and integrity checks, each a small DataFrame and none a driver-side loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.lookup import lookup

# Fixed value: enriched rows below this share of the source raise the loss alert.
KEPT_SHARE = 0.95

# The columns of the metrics.
_METRICS = ["etapa", "total_registros", "monto_promedio", "monto_min", "monto_max"]


def step_metrics(df: DataFrame, stage: str) -> DataFrame:
    """Row count and average, least and greatest amount of one enrichment step."""
    amount = F.col("MONTO_TRANSACCION")
    return df.agg(
        F.count("*").alias("total_registros"),
        F.avg(amount).alias("monto_promedio"),
        F.min(amount).alias("monto_min"),
        F.max(amount).alias("monto_max"),
    ).select(F.lit(stage).alias("etapa"), *_METRICS[1:])


def chain_metrics(
    transaccion: DataFrame, persona: DataFrame, empresa: DataFrame, stages: tuple[str, str, str]
) -> DataFrame:
    """``step_metrics`` of all three steps from one pass over the fact.

    A left lookup never drops a row, it can only repeat one. So the later steps are the
    first step with each row weighted by how often its keys occur in the dimension.
    """
    matched = _per_person(transaccion, persona, empresa).where("copies IS NOT NULL")
    weights = (
        ("n", "copies", "amount_n", "amount"),
        ("n", "copies_employed", "amount_n", "amount"),
        ("n_merchant", "copies_employed", "amount_n_merchant", "amount_merchant"),
    )
    totals = matched.agg(
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        *[
            F.sum(F.col(source) * F.col(copies)).alias(f"{name}_{i}")
            for i, (rows, copies, known, amount) in enumerate(weights)
            for name, source in (("rows", rows), ("known", known), ("amount", amount))
        ],
    )
    steps = [
        F.struct(
            F.lit(stage).alias("etapa"),
            F.coalesce(F.col(f"rows_{i}"), F.lit(0)).alias("total_registros"),
            F.when(F.col(f"known_{i}") > 0, F.col(f"amount_{i}") / F.col(f"known_{i}")).alias(
                "monto_promedio"
            ),
            F.col("least").alias("monto_min"),
            F.col("greatest").alias("monto_max"),
        )
        for i, stage in enumerate(stages)
    ]
    return totals.select(F.inline(F.array(*steps)))


def match_report(transaccion: DataFrame, persona: DataFrame, empresa: DataFrame) -> DataFrame:
    """Why the enriched count differs from the source: rows lost and rows repeated, apart."""
    per_person = _per_person(transaccion, persona, empresa)
    found = F.col("copies").isNotNull()
    return per_person.agg(
        F.sum("n").alias("origen"),
        F.sum(F.when(~found, F.col("n")).otherwise(0)).alias("sin_persona"),
        F.sum(F.when(found, F.col("n") * (F.col("copies") - 1)).otherwise(0)).alias(
            "repetidas_persona"
        ),
        F.sum(
            F.when(
                found,
                F.col("n_merchant") * F.col("copies_employed") - F.col("n") * F.col("copies"),
            ).otherwise(0)
        ).alias("repetidas_empresa"),
    ).na.fill(0)


def _per_person(transaccion: DataFrame, persona: DataFrame, empresa: DataFrame) -> DataFrame:
    """The fact summed per person key, next to how often that key occurs in the dimension.

    The fact is summed by person and company before anything joins it, and sums are combined
    before they are shuffled. So a company or a person that holds a third of the fact is a row
    per pair by then. Company keys that occur once have weight 1, so only repeated ones are
    looked up.
    """
    repeated = (
        empresa.where("ID IS NOT NULL").groupBy("ID").agg(F.count("*").alias("k")).where("k > 1")
        # Where the lookups are shuffled, this gives them a side of its own exchange: adaptive
        # execution then splits a company with very many persons, as it would not beside a sum.
        .hint("rebalance")
    )
    weight = F.coalesce("k", F.lit(1))
    amount = F.col("MONTO")
    pairs = transaccion.groupBy("ID_PERSONA", "ID_EMPRESA").agg(
        F.count("*").alias("rows"),
        F.count(amount).alias("known"),
        F.sum(amount).alias("total"),
        F.min(amount).alias("least"),
        F.max(amount).alias("greatest"),
    )
    fact = (
        lookup(pairs, repeated, "ID_EMPRESA", "ID", {"k": "k"})
        .groupBy("ID_PERSONA")
        .agg(
            F.sum("rows").alias("n"),
            F.sum(F.col("rows") * weight).alias("n_merchant"),
            F.sum("known").alias("amount_n"),
            F.sum("total").alias("amount"),
            F.sum(F.col("known") * weight).alias("amount_n_merchant"),
            F.sum(F.col("total") * weight).alias("amount_merchant"),
            F.min("least").alias("least"),
            F.max("greatest").alias("greatest"),
        )
    )
    people = (
        lookup(
            persona.where("ID IS NOT NULL").select("ID", "ID_EMPRESA"),
            repeated,
            "ID_EMPRESA",
            "ID",
            {"k": "k"},
        )
        .groupBy("ID")
        .agg(F.count("*").alias("copies"), F.sum(weight).alias("copies_employed"))
    )
    return fact.join(people, F.col("ID_PERSONA") == F.col("ID"), "left")


def integrity_check(
    transaccion: DataFrame, enriched: DataFrame, kept_share: float = KEPT_SHARE
) -> DataFrame:
    """Source and enriched counts, missing names and the loss alert, in one row.

    Run it over the stored layers: it reads three columns of gold and none of the source.
    """
    return _integrity(transaccion, enriched, [], kept_share)


def key_counts(transaccion: DataFrame, *by: str) -> DataFrame:
    """The fact as a row per person and company (and ``by``), its rows counted as ``MONTO``.

    Store it and look names up in it: the checks of ``counted`` then need the fact once, and a
    hot person or company is a row per pair.
    """
    counts = transaccion.groupBy("ID_PERSONA", "ID_EMPRESA", *by).agg(F.count("*").alias("MONTO"))
    return counts if "FECHA" in by else counts.withColumn("FECHA", F.lit(None).cast("string"))


def integrity_counted(
    counts: DataFrame, enriched: DataFrame, *, by_date: bool = False, kept_share: float = KEPT_SHARE
) -> DataFrame:
    """``integrity_check``, or ``integrity_by_date``, from ``key_counts`` and their enrichment."""
    keys = ["fecha"] if by_date else []
    source = counts.withColumn("fecha", F.col("FECHA")) if by_date else counts
    target = enriched.withColumn("fecha", F.col("FECHA_TRANSACCION")) if by_date else enriched
    return _integrity(source, target, keys, kept_share, ("MONTO", "MONTO_TRANSACCION"))


def integrity_by_date(
    transaccion: DataFrame, enriched: DataFrame, kept_share: float = KEPT_SHARE
) -> DataFrame:
    """The same per date (fecha), so that a date that loses its rows is not lost among others."""
    return _integrity(
        transaccion.withColumn("fecha", F.col("FECHA")),
        enriched.withColumn("fecha", F.col("FECHA_TRANSACCION")),
        ["fecha"],
        kept_share,
    )


# Names of the counts, and the columns whose missing values they count.
_NULLS = {
    "nulos_nombre": "NOMBRE_PERSONA",
    "nulos_trabajo": "TRABAJO_PERSONA",
    "nulos_empresa": "EMPRESA_TRANSACCION",
}


def _integrity(
    transaccion: DataFrame,
    enriched: DataFrame,
    keys: list[str],
    kept_share: float,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """Each row counts one, or what the column of ``counts`` for its side says."""
    own, theirs = (F.lit(1), F.lit(1)) if counts is None else map(F.col, counts)

    def total(weight: Column, name: str) -> Column:
        return F.coalesce(F.sum(weight), F.lit(0)).cast("bigint").alias(name)

    zero = F.lit(0).cast("bigint")
    names = ["origen", "enriquecidas", *_NULLS]
    source = transaccion.groupBy(*keys).agg(
        total(own, "origen"), *[zero.alias(n) for n in names if n != "origen"]
    )
    target = enriched.groupBy(*keys).agg(
        zero.alias("origen"),
        total(theirs, "enriquecidas"),
        *[total(F.when(F.col(c).isNull(), theirs), n) for n, c in _NULLS.items()],
    )
    counts = source.unionByName(target).groupBy(*keys)
    counts = counts.agg(*[F.sum(n).alias(n) for n in names])
    return counts.withColumn("alerta", _alert(kept_share))


def loss_alert(check: DataFrame, kept_share: float = KEPT_SHARE) -> DataFrame:
    """The alert with the share lost, from an ``integrity_check`` row."""
    lost = (1 - F.col("enriquecidas").cast("double") / F.col("origen")) * 100
    return check.select(
        "origen",
        "enriquecidas",
        F.when(F.col("origen") > 0, lost).otherwise(F.lit(0.0)).alias("perdida_pct"),
        _alert(kept_share).alias("alerta"),
    )


def _alert(kept_share: float) -> Column:
    return F.col("enriquecidas") < F.col("origen") * F.lit(kept_share)
