import pytest

from strata.operators.lookup import STRATEGIES
from strata.plans.enrichment import enrich, with_employer, with_merchant, with_person
from strata.specs import EMPRESA, GOLD, PERSONA, TRANSACCION
from tests.support import plan, rows


@pytest.fixture(scope="module")
def entities(spark):
    people = [
        ("1", "Ana", None, None, None, 30, 10.0, "1"),
        ("2", "Luz", None, None, None, 40, 20.0, "9"),
        ("x", "Leo", None, None, None, 50, 30.0, "2"),
        ("1", "Ana bis", None, None, None, 31, 11.0, "2"),
    ]
    companies = [("1", "Uno"), ("2", "Dos"), ("2", "Dos bis"), ("3", None)]
    facts = [
        ("1", "1", 5.0, "2024-01-01"),
        ("1", "2", 6.0, "2024-01-01"),
        ("2", "3", 7.0, None),
        ("x", "8", 8.0, "2024-01-02"),
        ("01", "1", 9.0, "2024-01-02"),
        ("5", "1", 1.0, "2024-01-03"),
    ]
    return (
        spark.createDataFrame(facts, TRANSACCION.curated),
        spark.createDataFrame(people, PERSONA.curated),
        spark.createDataFrame(companies, EMPRESA.curated),
    )


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_every_strategy_equals_the_three_steps(entities, strategy):
    transaccion, persona, empresa = entities
    steps = with_merchant(with_employer(with_person(transaccion, persona), empresa), empresa)
    found = enrich(*entities, strategy)
    assert found.columns == GOLD.fieldNames()
    assert [f.dataType for f in found.schema] == [f.dataType for f in GOLD]
    assert rows(found) == rows(steps.select(*GOLD.fieldNames()))


@pytest.mark.parametrize("small", [(True, True), (False, True), (True, False), (False, False)])
def test_measured_sizes_change_the_way_and_not_the_rows(entities, small, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = enrich(*entities, "broadcast", small)
    assert ("SortMergeJoin" in plan(found)) == (not all(small))
    assert rows(found) == rows(enrich(*entities))


def test_step_layouts(entities):
    transaccion, persona, empresa = entities
    step1 = with_person(transaccion, persona)
    step2 = with_employer(step1, empresa)
    head = ["ID_PERSONA", "NOMBRE_PERSONA", "EDAD_PERSONA", "SALARIO_PERSONA"]
    tail = ["MONTO_TRANSACCION", "FECHA_TRANSACCION"]
    assert step1.columns == [*head, "ID_EMPRESA_PERSONA", *tail, "ID_EMPRESA_TRANSACCION"]
    assert step2.columns == [*head, "TRABAJO_PERSONA", *tail, "ID_EMPRESA_TRANSACCION"]
    assert with_merchant(step2, empresa).columns == [
        *head,
        "TRABAJO_PERSONA",
        *tail,
        "EMPRESA_TRANSACCION",
    ]


def test_keys_match_as_text_and_become_numbers_afterwards(entities):
    found = enrich(*entities).collect()
    assert {r.NOMBRE_PERSONA for r in found if r.ID_PERSONA is None} == {"Leo"}
    assert not [r for r in found if r.MONTO_TRANSACCION in (9.0, 1.0)]


def test_repeated_keys_multiply_and_unknown_companies_stay(entities):
    found = enrich(*entities).collect()
    # Two persons "1", the second with two employers; merchant "2" twice as well.
    assert len([r for r in found if r.MONTO_TRANSACCION == 5.0]) == 3
    assert len([r for r in found if r.MONTO_TRANSACCION == 6.0]) == 6
    [unknown] = [r for r in found if r.MONTO_TRANSACCION == 7.0]
    assert (unknown.TRABAJO_PERSONA, unknown.EMPRESA_TRANSACCION) == (None, None)
