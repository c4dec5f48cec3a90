import math

import pytest

from strata.operators.quality import apply_rules, audit_rows, quality_report, stored_report, typed
from strata.specs import AUDIT, EMPRESA, PERSONA, TRANSACCION


def _person(key="1", age="30", salary="10", employer="1"):
    return (key, "n", "t", "c", "2020-01-01", age, salary, employer)


def _people(spark, *people):
    return spark.createDataFrame(list(people), PERSONA.raw)


@pytest.mark.parametrize(
    ("person", "kept"),
    [
        (_person(age="1"), True),
        (_person(age="99"), True),
        (_person(age="99.9"), True),
        (_person(age="0"), False),
        (_person(age="100"), False),
        (_person(age="abc"), False),
        (_person(age=None), False),
        (_person(salary="0.01"), True),
        (_person(salary="9999999.99"), True),
        (_person(salary="0"), False),
        (_person(salary="10000000"), False),
        (_person(salary="NaN"), False),
        (_person(key=None), False),
        (_person(key=""), True),
        (_person(employer=None), False),
    ],
)
def test_person_rules(spark, person, kept):
    assert apply_rules(_people(spark, person), PERSONA).count() == int(kept)


@pytest.mark.parametrize(
    ("amount", "kept"),
    [("0", True), ("-0.01", False), ("NaN", True), ("err", False), (None, False), ("1e3", True)],
)
def test_amount_rule(spark, amount, kept):
    df = spark.createDataFrame([("1", "2", amount, "2024-01-01")], TRANSACCION.raw)
    assert apply_rules(df, TRANSACCION).count() == int(kept)


def test_missing_date_and_company_name_pass(spark):
    transactions = spark.createDataFrame([("1", "2", "3", None)], TRANSACCION.raw)
    companies = spark.createDataFrame([("1", None), (None, "x")], EMPRESA.raw)
    assert apply_rules(transactions, TRANSACCION).count() == 1
    assert apply_rules(companies, EMPRESA).count() == 1


def test_validation_can_be_turned_off(spark):
    df = apply_rules(_people(spark, _person(None, "abc", "x", None)), PERSONA, validate=False)
    assert tuple(df.first())[5:] == (None, None, None)


def test_typing_takes_lower_case_columns_in_any_order(spark):
    columns = ["fecha", "monto", "id_persona", "id_empresa"]
    df = spark.createDataFrame([("2024-01-01", "7", "1", "2")], columns)
    out = typed(df, TRANSACCION)
    assert out.columns == ["ID_PERSONA", "ID_EMPRESA", "MONTO", "FECHA"]
    assert tuple(out.first()) == ("1", "2", 7.0, "2024-01-01")


def test_report_counts_rejects_and_empty_sources(spark):
    people = _people(spark, _person(), _person(age="0"), _person(age=None))
    nothing = spark.createDataFrame([], EMPRESA.raw)
    report = quality_report([(PERSONA, people), (EMPRESA, nothing)])
    found = {r.tabla: tuple(r)[1:] for r in report.collect()}
    assert found["PERSONA"][:3] == (3, 1, 2)
    assert math.isclose(found["PERSONA"][3], 100 / 3)
    assert found["EMPRESA"] == (0, 0, 0, 100.0)


def test_stored_report_equals_the_one_from_rules(spark):
    people = _people(spark, _person(), _person(age="0"))
    stored = stored_report([(PERSONA, people, apply_rules(people, PERSONA))])
    assert stored.collect() == quality_report([(PERSONA, people)]).collect()


def test_audit_layout(spark):
    report = quality_report([(PERSONA, _people(spark, _person()))])
    stamped = audit_rows(report, "2024-01-01 00:00:00")
    assert [(f.name, f.dataType) for f in stamped.schema] == [(f.name, f.dataType) for f in AUDIT]
    assert stamped.first()["ejecucion"] == "2024-01-01 00:00:00"
