import re

import pytest
from pyspark.sql import functions as F

from strata.operators.checks import (
    chain_metrics,
    integrity_check,
    loss_alert,
    match_report,
    step_metrics,
)
from strata.operators.layout import partition_distribution
from strata.plans.enrichment import enrich, with_employer, with_merchant, with_person
from tests.support import plan, rows
from tests.test_enrichment import entities  # noqa: F401

STAGES = ("one", "two", "three")


@pytest.mark.parametrize("small", [True, False])
def test_chain_metrics_equal_the_steps(entities, small, setting):  # noqa: F811
    if not small:
        setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    transaccion, persona, empresa = entities
    step1 = with_person(transaccion, persona)
    step2 = with_employer(step1, empresa)
    step3 = with_merchant(step2, empresa)
    wanted = [step_metrics(s, n) for s, n in zip((step1, step2, step3), STAGES, strict=True)]
    found = chain_metrics(transaccion, persona, empresa, STAGES)
    expected = wanted[0].unionByName(wanted[1]).unionByName(wanted[2])
    assert rows(found.withColumn("monto_promedio", F.round("monto_promedio", 9))) == rows(
        expected.withColumn("monto_promedio", F.round("monto_promedio", 9))
    )


def test_chain_metrics_with_missing_amounts_and_no_match(entities):  # noqa: F811
    transaccion, persona, empresa = entities
    unknown = transaccion.withColumn("MONTO", F.lit(None).cast("double"))
    for r in chain_metrics(unknown, persona, empresa, STAGES).collect():
        assert r.total_registros > 0 and r.monto_promedio is r.monto_min is r.monto_max is None
    for r in chain_metrics(transaccion, persona.limit(0), empresa, STAGES).collect():
        assert (r.total_registros, r.monto_promedio) == (0, None)


def test_match_report_separates_lost_from_repeated(entities):  # noqa: F811
    transaccion, persona, empresa = entities
    row = match_report(*entities).first()
    joined = with_person(transaccion, persona).count()
    assert row.origen == 6
    assert row.sin_persona == 2
    assert row.origen - row.sin_persona + row.repetidas_persona == joined
    assert joined + row.repetidas_empresa == enrich(*entities).count()
    empty = match_report(transaccion.limit(0), persona, empresa).first()
    assert tuple(empty) == (0, 0, 0, 0)


@pytest.mark.parametrize(("kept", "alert"), [(95, False), (94, True), (120, False)])
def test_loss_alert_threshold(spark, kept, alert):
    source = spark.range(100)
    gold = spark.range(kept).select(
        F.lit("n").alias("NOMBRE_PERSONA"),
        F.when(F.col("id") < 3, None).otherwise("t").alias("TRABAJO_PERSONA"),
        F.lit(None).cast("string").alias("EMPRESA_TRANSACCION"),
    )
    check = integrity_check(source, gold)
    assert tuple(check.first()) == (100, kept, 0, 3, kept, alert)
    found = loss_alert(check).first()
    assert found.alerta is alert
    assert found.perdida_pct == pytest.approx(100 - kept)


def test_integrity_of_nothing(spark):
    gold = spark.createDataFrame(
        [], "NOMBRE_PERSONA STRING, TRABAJO_PERSONA STRING, EMPRESA_TRANSACCION STRING"
    )
    check = integrity_check(spark.range(0), gold)
    assert tuple(check.first()) == (0, 0, 0, 0, 0, False)
    assert loss_alert(check).first().perdida_pct == 0.0


def test_partition_distribution_counts_the_missing_date(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "FECHA STRING")
    assert {tuple(r) for r in partition_distribution(df, "FECHA").collect()} == {("a", 2), (None, 1)}


def test_metrics_sum_the_fact_before_they_look_companies_up(spark, setting):
    """So a company that holds half of the fact is a row per person by then."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact = spark.range(1000).selectExpr(
        "CAST(id % 10 AS STRING) AS ID_PERSONA",
        "IF(id % 2 = 0, 'hot', CAST(id AS STRING)) AS ID_EMPRESA",
        "CAST(id AS DOUBLE) AS MONTO",
    )
    persons = spark.range(10).selectExpr("CAST(id AS STRING) AS ID", "'hot' AS ID_EMPRESA")
    companies = spark.sql("SELECT 'hot' AS ID, 'n' AS NOMBRE UNION ALL SELECT 'hot', 'm'")
    report = match_report(fact, persons, companies)
    assert tuple(report.first()) == (1000, 0, 0, 500 * 4 + 500 * 2 - 1000)
    # Summed per task before the shuffle and again after it, and only then looked up.
    assert len(re.findall(r"Keys \[2\]: \[ID_PERSONA#\d+, ID_EMPRESA#\d+\]", plan(report))) == 2


def test_counted_checks_are_those_of_every_row(spark, tmp_path):
    """The fact once, as counts by person and company, gives what all its rows give."""
    from strata.operators.checks import integrity_by_date, integrity_counted, key_counts
    from strata.plans.enrichment import enrich

    fact = spark.createDataFrame(
        [("1", "7", 5.0, "d1")] * 20 + [("2", "8", None, "d1"), ("9", "7", 1.0, "d2"), (None, "7", 1.0, None), ("3", None, 2.0, "d2")],
        "ID_PERSONA string, ID_EMPRESA string, MONTO double, FECHA string",
    )
    persona = spark.createDataFrame(
        [("1", "Ana", 30, 1.0, "7"), ("2", None, 31, 1.0, "0"), ("2", "Dos", 31, 1.0, "7"), ("3", "Tres", 5, 1.0, None)],
        "ID string, NOMBRE string, EDAD int, SALARIO double, ID_EMPRESA string",
    )
    empresa = spark.createDataFrame([("7", "Siete"), ("7", "Otra")], "ID string, NOMBRE string")
    for by_date, plain in ((False, integrity_check), (True, integrity_by_date)):
        counts = key_counts(fact, *(["FECHA"] if by_date else []))
        found = integrity_counted(counts, enrich(counts, persona, empresa), by_date=by_date)
        assert rows(found) == rows(plain(fact, enrich(fact, persona, empresa)))
        assert found.schema == plain(fact, enrich(fact, persona, empresa)).schema
    none = key_counts(fact.where("false"))
    assert tuple(integrity_counted(none, enrich(none, persona, empresa)).first())[:2] == (0, 0)
