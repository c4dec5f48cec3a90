import pytest
from pyspark.sql import functions as F

from strata.operators import changes
from strata.operators.quality import judged, quality_reasons
from strata.plans.stages import (
    Lake,
    dates_behind,
    run_changed,
    run_curated,
    run_functional,
    run_landing,
    run_raw,
)
from strata.sinks.exports import DifferentContent, export_checked
from strata.sinks.layers import write_judged, write_layer
from strata.sources.layers import read_documents, read_judged
from strata.specs import ACCEPTED, PERSONA, REJECTED, TRANSACCION
from tests.support import plan, rows
from tests.test_stages import COMPANIES, FACTS, PEOPLE

TABLE = "a string, b string, n int"


def _table(spark, *data):
    return spark.createDataFrame(list(data), TABLE)


def _digest(spark, *data):
    return tuple(_table(spark, *data).agg(*changes.bag_digest(["a", "b", "n"])).first())


def test_digests_tell_bags_apart_and_not_orders(spark):
    one, two = ("x", None, 1), (None, "x", 1)
    assert _digest(spark, one, two) == _digest(spark, two, one)
    kinds = [_digest(spark, *d) for d in ([one], [two], [one, one], [one, two], [("", "x", 1)], [])]
    assert len(set(kinds)) == len(kinds)


def test_partitions_that_differ(spark):
    before = _table(spark, ("p", "x", 1), ("p", "y", 2), ("q", "z", 3), (None, "n", 1), ("gone", "x", 1))
    after = _table(spark, ("p", "y", 2), ("p", "x", 1), ("q", "z", 4), (None, "n", 1), (None, "n", 1), ("new", "x", 1))
    found = changes.differing(
        changes.partition_digests(before, "a"), changes.partition_digests(after, "a"), "particion"
    )
    assert {tuple(r) for r in found.collect()} == {("q", 1, 1), (None, 1, 2), ("gone", 1, 0), ("new", 0, 1)}


def test_rows_and_keys_that_differ(spark):
    before = _table(spark, ("1", "x", 1), ("1", "x", 1), ("2", None, 1), (None, "x", 1), ("3", "x", 1))
    after = _table(spark, ("1", "x", 1), ("2", None, None), (None, "y", 1), ("3", "x", 1), ("4", "x", 1))
    found = {tuple(r) for r in changes.row_differences(before, after).collect()}
    assert found == {
        ("1", "x", 1, -1), ("2", None, 1, -1), ("2", None, None, 1),
        (None, "x", 1, -1), (None, "y", 1, 1), ("4", "x", 1, 1),
    }
    assert {r.a for r in changes.changed_keys(before, after, "a").collect()} == {"1", "2", "4"}
    assert changes.changed_keys(before, before, "a").collect() == []


def _deliver(lake, tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode("iso-8859-1"))
    specs = [s for s in (PERSONA, *_others()) if s.name in texts]
    run_raw(lake, {n: str(tmp_path / n) for n in texts}, specs)
    run_landing(lake, specs)


def _others():
    from strata.specs import EMPRESA

    return EMPRESA, TRANSACCION


@pytest.fixture
def followed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    _deliver(lake, tmp_path, PERSONA=PEOPLE, EMPRESA=COMPANIES, TRANSACCION=FACTS)
    assert sorted(run_changed(lake, "t1")) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    return lake


def _files(tmp_path, layer, table):
    return {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in (tmp_path / "lake" / layer / table).rglob("*.parquet")}


def test_only_changed_dates_are_made_again(followed, tmp_path):
    lake = followed
    before = {t: _files(tmp_path, *t) for t in (("curated", "transaccion"), ("functional", "transaccion_enriquecida"))}
    # The same facts in another order, one amount of one date changed.
    head, *lines = FACTS.splitlines()
    again = "\n".join([head, *reversed(lines)]).replace("2|7|0|", "2|7|1|") + "\n"
    _deliver(lake, tmp_path, TRANSACCION=again)
    assert run_changed(lake, "t2") == ["2024-01-02"]
    for table, files in before.items():
        after = _files(tmp_path, *table)
        assert {f.parent.name.partition("=")[2] for f in after.keys() - files.keys()} == {"2024-01-02"}
        assert {f.parent.name.partition("=")[2] for f in files.keys() - after.keys()} == {"2024-01-02"}
    made = rows(lake.gold())
    run_curated(lake, "t3")
    run_functional(lake)
    assert rows(lake.gold()) == made
    assert run_changed(lake, "t4") == []


def test_lost_dates_are_emptied_and_failed_runs_done_again(followed, tmp_path, monkeypatch):
    lake = followed
    _deliver(lake, tmp_path, TRANSACCION="".join(x + "\n" for x in FACTS.splitlines() if "01-01" not in x))
    from strata.plans import stages

    with monkeypatch.context() as broken:
        broken.setattr(stages, "run_functional", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_changed(lake, "t2")
    assert run_changed(lake, "t3") == ["2024-01-01"]
    assert {r.FECHA_TRANSACCION for r in lake.gold().collect()} == {"2024-01-02"}


def test_gold_follows_its_dimensions(followed, tmp_path):
    lake = followed
    assert dates_behind(lake) == []
    # Only person 2 works for company 9, which is new; company 2 is the merchant of one date.
    _deliver(lake, tmp_path, EMPRESA="ID|NOMBRE\n1|Uno\n2|Dos\n9|Nueve\n")
    run_curated(lake, "t2", [*_others()][:1])
    assert sorted(dates_behind(lake)) == ["2024-01-01", "2024-01-02"]
    _deliver(lake, tmp_path, EMPRESA="ID|NOMBRE\n1|Uno\n2|Otra\n")
    run_curated(lake, "t2", [*_others()][:1])
    assert dates_behind(lake) == ["2024-01-01"]
    curated = tmp_path / "lake" / "curated" / "transaccion" / "FECHA=2024-01-02"
    untouched = _files(tmp_path, "functional", "transaccion_enriquecida")
    run_functional(lake, mode="incremental", dates=[], follow_dimensions=True)
    after = _files(tmp_path, "functional", "transaccion_enriquecida")
    assert {f.parent.name.partition("=")[2] for f in after.keys() ^ untouched.keys()} == {"2024-01-01"}
    assert curated.exists() and dates_behind(lake) == []
    made = rows(lake.gold())
    assert {r.EMPRESA_TRANSACCION for r in lake.gold().collect()} == {"Otra", "Uno", None}
    run_functional(lake)
    assert rows(lake.gold()) == made
    # What is read for a scope names its partitions.
    assert "PartitionFilters: [" in plan(lake.curated(TRANSACCION, ["2024-01-01"]))
    assert "2024-01-01" in plan(lake.curated(TRANSACCION, ["2024-01-01"])).split("PartitionFilters")[1][:80]


def test_without_memory_all_dates_are_made(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    _deliver(lake, tmp_path, PERSONA=PEOPLE, EMPRESA=COMPANIES, TRANSACCION=FACTS)
    run_curated(lake, "t1")
    assert dates_behind(lake) is None
    with pytest.raises(ValueError):
        run_functional(lake, mode="incremental", follow_dimensions=True)
    run_functional(lake, mode="incremental", dates=[], follow_dimensions=True)
    assert lake.gold().count() == 3 and dates_behind(lake) == []


# --- reasons ----------------------------------------------------------------------------

DIRTY = [("1", "1", "5", "d1"), (None, "1", "-1", "d1"), (None, None, "x", None), ("1", None, "1", "d2"), ("1", "1", None, "d2")]


def test_reasons_name_every_rule_that_fails(spark, tmp_path):
    df = spark.createDataFrame(DIRTY, "id_persona string, id_empresa string, monto string, fecha string")
    found = {r.motivos: r.filas for r in quality_reasons([(TRANSACCION, df)]).collect()}
    assert found == {
        None: 1,
        "person_present,amount_not_negative": 1,
        "person_present,company_present,amount_not_negative": 1,
        "company_present": 1,
        "amount_not_negative": 1,
    }
    out = judged(df, TRANSACCION)
    assert plan(out).count("Scan ExistingRDD") <= 2
    write_judged(out, str(tmp_path / "j"), partition_by="FECHA")
    accepted = read_judged(spark, str(tmp_path / "j"), TRANSACCION, ACCEPTED)
    rejected = read_judged(spark, str(tmp_path / "j"), TRANSACCION, REJECTED)
    assert [tuple(r) for r in accepted.collect()] == [("1", "1", 5.0, "d1")]
    assert accepted.schema == TRANSACCION.curated
    assert accepted.count() + rejected.count() == df.count()
    assert {r.motivos for r in rejected.collect()} == set(found) - {None}
    people = spark.createDataFrame([(None,) * 8], PERSONA.raw)
    [row] = quality_reasons([(PERSONA, people)]).collect()
    assert row.motivos == "id_present,employer_present,age_in_range,salary_in_range"


def test_the_curated_stage_keeps_what_it_rejects(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), keep_rejected=True)
    _deliver(lake, tmp_path, PERSONA=PEOPLE, EMPRESA=COMPANIES, TRANSACCION=FACTS)
    report = {r.tabla: (r.origen, r.curated) for r in run_curated(lake, "t1").collect()}
    assert report == {"PERSONA": (3, 2), "EMPRESA": (2, 2), "TRANSACCION": (7, 4)}
    found = sorted((r.MONTO or 0, r.FECHA, r.motivos) for r in lake.rejected(TRANSACCION).collect())
    assert found == [
        (-1.0, "2024-01-03", "amount_not_negative"),
        (0, "2024-01-03", "amount_not_negative"),
        (1.0, "2024-01-03", "person_present"),
    ]
    assert [r.motivos for r in lake.rejected(PERSONA).collect()] == ["age_in_range"]
    assert lake.rejected(_others()[0]).collect() == []
    run_functional(lake)
    assert lake.gold().count() == 3
    # A corrected date: what was rejected is accepted, and the other way round.
    swapped = "ID_PERSONA|ID_EMPRESA|MONTO|FECHA\n1|1|4|2024-01-03\n1|2|-5|2024-01-01\n"
    (tmp_path / "TRANSACCION").write_text(swapped)
    run_raw(lake, {"TRANSACCION": str(tmp_path / "TRANSACCION")}, [TRANSACCION])
    run_landing(lake, [TRANSACCION], mode="incremental")
    dates = ["2024-01-01", "2024-01-03"]
    run_curated(lake, "t2", [TRANSACCION], mode="incremental", dates=dates)
    assert sorted((r.MONTO, r.FECHA) for r in lake.curated(TRANSACCION).collect()) == [
        (0.0, "2024-01-02"), (4.0, "2024-01-03"), (9.0, "2024-01-02"),
    ]
    assert [(r.MONTO, r.FECHA) for r in lake.rejected(TRANSACCION).collect()] == [(-5.0, "2024-01-01")]
    assert lake.rejected(TRANSACCION, ["2024-01-03"]).collect() == []


# --- documents --------------------------------------------------------------------------


def _documents(spark, count=500):
    return spark.range(count).selectExpr("CAST(id % 300 AS INT) AS k", "id / 8 AS x", "IF(id % 3 = 0, NULL, 'é') AS t")


def test_each_kind_of_difference_is_named(spark):
    df = _documents(spark)
    keys = ["k"]
    assert changes.content_differences(df, df.repartition(3), keys).collect() == []
    changed = df.withColumn("x", F.when(F.col("k") == 299, -1.0).otherwise(F.col("x")))
    found = changes.content_differences(df, changed, keys).collect()
    assert {(r.x, r.veces) for r in found} == {(299 / 8, -1), (-1.0, 1)}
    assert len({r.cubo for r in found}) == 1
    lost = changes.content_differences(df, df.where("k <> 250"), keys).collect()
    assert [(r.k, r.veces) for r in lost] == [(250, -1)]
    doubled = changes.content_differences(df, df.unionByName(df.where("k = 260")), keys).collect()
    assert [(r.k, r.veces) for r in doubled] == [(260, 1)]


def test_documents_are_published_once_they_are_right(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "docs"), _documents(spark)
    export_checked(df, path, ["k"])
    assert rows(read_documents(spark, path, df.schema)) == rows(df)
    export_checked(df.where("k < 5"), path, ["k"])
    assert rows(read_documents(spark, path, df.schema)) == rows(df.where("k < 5"))
    from strata.sinks import exports

    write = exports.export_documents
    monkeypatch.setattr(exports, "export_documents", lambda d, *a, **k: write(d.where("k <> 7"), *a, **k))
    with pytest.raises(DifferentContent, match="buckets"):
        export_checked(df, path, ["k"])
    assert rows(read_documents(spark, path, df.schema)) == rows(df.where("k < 5"))
    assert [p.name for p in tmp_path.iterdir()] == ["docs"]


def test_one_date_is_listed_and_stale_dates_run_no_job(spark, tmp_path):
    """An incremental write looks into the folders of its scope only, whatever else is broken."""
    path = str(tmp_path / "t")
    facts = spark.createDataFrame([("1", f"d{i}") for i in range(40)], "a string, FECHA string")
    write_layer(facts, path, partition_by="FECHA")
    status, group = spark.sparkContext.statusTracker(), "stale"
    spark.sparkContext.setJobGroup(group, "")
    scope = [f"d{i}" for i in range(30)]
    write_layer(facts.where("FECHA = 'd0'"), path, partition_by="FECHA", mode="incremental", scope=scope)
    spark.sparkContext.setJobGroup("", "")
    assert len(status.getJobIdsForGroup(group)) < 8
    assert {p.name for p in (tmp_path / "t").glob("FECHA=*")} == {"FECHA=d0", *(f"FECHA=d{i}" for i in range(30, 40))}
