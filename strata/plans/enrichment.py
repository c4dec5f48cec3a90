"""Transactions enriched with the person, the person's employer and the merchant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import lenient_int
from strata.operators.lookup import hot_keys, is_small, lookup
from strata.specs import GOLD

# Columns of the dimensions that the steps use.
PERSON_COLUMNS = ("ID", "NOMBRE", "EDAD", "SALARIO", "ID_EMPRESA")
COMPANY_COLUMNS = ("ID", "NOMBRE")

_PERSON = {"NOMBRE": "NOMBRE_PERSONA", "EDAD": "EDAD_PERSONA", "SALARIO": "SALARIO_PERSONA"}


def with_person(transaccion: DataFrame, persona: DataFrame, strategy: str = "auto") -> DataFrame:
    """Step 1: the person of each transaction; transactions without one are dropped."""
    attributes = {**_PERSON, "ID_EMPRESA": "ID_EMPRESA_PERSONA"}
    joined = lookup(transaccion, persona, "ID_PERSONA", "ID", attributes, "inner", strategy)
    return joined.select(
        # Keys match as text, so the number is made only afterwards.
        lenient_int(F.col("ID_PERSONA")).alias("ID_PERSONA"),
        *attributes.values(),
        F.col("MONTO").alias("MONTO_TRANSACCION"),
        F.col("FECHA").alias("FECHA_TRANSACCION"),
        F.col("ID_EMPRESA").alias("ID_EMPRESA_TRANSACCION"),
    )


def with_employer(step1: DataFrame, empresa: DataFrame, strategy: str = "auto") -> DataFrame:
    """Step 2: the employer's name in place of its key; NULL where unknown."""
    joined = lookup(
        step1, empresa, "ID_EMPRESA_PERSONA", "ID", {"NOMBRE": "TRABAJO_PERSONA"}, "left", strategy
    )
    return joined.select(
        "ID_PERSONA",
        *_PERSON.values(),
        "TRABAJO_PERSONA",
        "MONTO_TRANSACCION",
        "FECHA_TRANSACCION",
        "ID_EMPRESA_TRANSACCION",
    )


def with_merchant(step2: DataFrame, empresa: DataFrame, strategy: str = "auto") -> DataFrame:
    """Step 3: the merchant's name in place of its key; NULL where unknown."""
    return lookup(
        step2,
        empresa,
        "ID_EMPRESA_TRANSACCION",
        "ID",
        {"NOMBRE": "EMPRESA_TRANSACCION"},
        "left",
        strategy,
    ).drop("ID_EMPRESA_TRANSACCION")


def small_dimensions(persona: DataFrame, empresa: DataFrame) -> tuple[bool, bool]:
    """Whether each dimension, in the columns the steps use, is within the broadcast bound."""
    return (
        is_small(persona.select(*PERSON_COLUMNS)),
        is_small(empresa.select(*COMPANY_COLUMNS)),
    )


def enrich(
    transaccion: DataFrame,
    persona: DataFrame,
    empresa: DataFrame,
    strategy: str = "auto",
    small: tuple[bool, bool] | None = None,
) -> DataFrame:
    """All three steps in one lazy plan, in the gold column order.

    With ``auto`` the steps follow each other, so that Spark sees each dimension's own size.
    Where companies are too many to broadcast, the employer joins the persons beforehand:
    it depends on the person alone, and the fact then meets two shuffled joins in place of
    three. Both ways give the same rows, duplicate dimension keys included. ``small``, from
    ``small_dimensions``, spares ``broadcast`` its own measuring.
    """
    by_person = by_company = strategy
    employer_first = strategy in ("shuffle", "isolate")
    if strategy == "broadcast":
        small_person, small_company = small or small_dimensions(persona, empresa)
        if not small_company:
            employer_first, by_company = True, "isolate"
        else:
            empresa, by_company = F.broadcast(empresa), "auto"
            by_person = "auto" if small_person else "isolate"
            persona = F.broadcast(persona) if small_person else persona
    if not employer_first:
        step1 = with_person(transaccion, persona, by_person)
        step3 = with_merchant(with_employer(step1, empresa, by_company), empresa, by_company)
        return step3.select(*GOLD.fieldNames())

    # One pass over the stored fact serves both of its keys.
    hot = hot_keys(transaccion, "ID_PERSONA", "ID_EMPRESA") if by_company == "isolate" else {}
    employer = {"NOMBRE": "TRABAJO_PERSONA"}
    employed = lookup(persona, empresa, "ID_EMPRESA", "ID", employer, "left", by_company)
    attributes = {**_PERSON, "TRABAJO_PERSONA": "TRABAJO_PERSONA"}
    people = lookup(
        transaccion,
        employed,
        "ID_PERSONA",
        "ID",
        attributes,
        "inner",
        by_person,
        hot.get("ID_PERSONA"),
    )
    complete = lookup(
        people,
        empresa,
        "ID_EMPRESA",
        "ID",
        {"NOMBRE": "EMPRESA_TRANSACCION"},
        "left",
        by_company,
        hot.get("ID_EMPRESA"),
    )
    return (
        complete.withColumn("ID_PERSONA", lenient_int(F.col("ID_PERSONA")))
        .withColumnsRenamed({"MONTO": "MONTO_TRANSACCION", "FECHA": "FECHA_TRANSACCION"})
        .select(*GOLD.fieldNames())
    )
