import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.operators.summaries import (
    DISTINCT_ERROR,
    RANK_ERROR,
    cube,
    fair_sample,
    merged,
    row_hash,
    sketches,
)
from strata.operators.temporal import as_intervals, as_of, interval_lookup
from strata.plans.stages import CONTROL, Lake
from strata.specs import PERSONA, TRANSACCION
from strata.streaming.landing import BATCH, landed, run_landing_stream, stream_path
from tests.support import plan, rows

# --- time -------------------------------------------------------------------------------


def day(text):
    return dt.date.fromisoformat(text)


HISTORY = [
    ("1", "2024-01-05", "a"), ("1", "2024-01-20", "b"), ("1", "2024-03-01", "c"),
    ("2", "2023-01-01", None), ("3", "2024-02-29", "z"), ("4", "2024-01-10", "x"), ("4", "2024-01-10", "y"),
    (None, "2024-01-01", "n"), ("5", None, "n"), ("6", "2030-01-01", "late"),
]
FACTS = [
    (k, f"2024-{m:02d}-{d:02d}", n)
    for k in ("1", "2", "3", "4", "5", "6", "7", None)
    for m, d in ((1, 1), (1, 4), (1, 5), (1, 19), (1, 20), (2, 28), (2, 29), (3, 1), (12, 31))
    for n in (1, 2)
] + [("1", None, 1)]


@pytest.mark.parametrize("strategy", ["auto", "shuffle", "isolate"])
@pytest.mark.parametrize("unit", ["month", "week", "year"])
def test_the_state_of_a_day(spark, strategy, unit):
    fact = spark.createDataFrame(FACTS, "k string, f string, n int").repartition(3)
    history = spark.createDataFrame([(k, d and day(d), v) for k, d, v in HISTORY], "id string, since date, v string")
    found = as_of(fact, history, "k", F.to_date("f"), "id", "since", ["v", "since"][:1], unit=unit, strategy=strategy)

    def plainly(k, f):
        begun = [(d, v or "") for key, d, v in HISTORY if key == k and k and d and f and d <= f]
        return (max(begun)[1] or None) if begun else None

    assert rows(found) == rows(spark.createDataFrame([(*r, plainly(*r[:2])) for r in FACTS], "k string, f string, n int, v string"))
    assert "CartesianProduct" not in plan(found) and "NestedLoop" not in plan(found)


def test_closed_intervals_and_empty_sides(spark):
    intervals = spark.createDataFrame(
        [("1", day("2024-01-03"), day("2024-01-05"), "x"), ("1", day("2024-01-05"), day("2024-01-05"), "never"), ("1", day("2024-02-01"), None, "y")],
        "id string, a date, b date, v string",
    )
    fact = spark.createDataFrame([("1", day(f"2024-0{m}-0{d}")) for m in (1, 2) for d in (1, 3, 4, 5)], "k string, d date")
    how = ("k", F.col("d"), "id", "a", "b", ["v"])
    found = {(r.d.month, r.d.day): r.v for r in interval_lookup(fact, intervals, *how).collect()}
    assert found == {(1, 1): None, (1, 3): "x", (1, 4): "x", (1, 5): None, (2, 1): "y", (2, 3): "y", (2, 4): "y", (2, 5): "y"}
    assert interval_lookup(fact.where("false"), intervals, *how).collect() == []
    assert {r.v for r in interval_lookup(fact, intervals.where("false"), *how).collect()} == {None}


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "isolate"])
def test_many_pieces_of_few_intervals_are_not_broadcast(spark, strategy):
    history = spark.range(120).selectExpr("CAST(id AS STRING) AS id", "DATE '2000-01-01' AS since", "CAST(id % 7 AS STRING) AS v")
    fact = spark.range(3000).selectExpr("CAST(id % 150 AS STRING) AS k", "date_add(DATE '1999-12-31', CAST(id * 3 AS INT)) AS d")
    how = ("k", F.col("d"), "id", "since", ["v"])
    found = as_of(fact, history, *how, unit="week", strategy=strategy)
    assert "BroadcastHashJoin" not in plan(found) and "SortMergeJoin" in plan(found)
    wanted = fact.selectExpr("k", "d", "IF(INT(k) < 120 AND d >= DATE '2000-01-01', STRING(INT(k) % 7), NULL) AS v")
    assert rows(found) == rows(wanted)
    few = as_of(fact.where("d < DATE '2000-06-01'"), history, *how, unit="week", strategy=strategy)
    assert "BroadcastHashJoin" in plan(few)


def test_intervals_end_where_the_next_begins(spark):
    history = spark.createDataFrame([(k, d and day(d), v) for k, d, v in HISTORY], "id string, since date, v string")
    found = {(r.id, str(r.since), r.v): r.hasta for r in as_intervals(history, "id", "since").collect()}
    assert found["1", "2024-01-05", "a"] == day("2024-01-20") and found["1", "2024-03-01", "c"] is None
    assert found["4", "2024-01-10", "x"] == day("2024-01-10") and len(found) == 8


# --- sketches, cubes, samples -----------------------------------------------------------


def _facts(spark, count=60_000):
    return spark.range(count).selectExpr(
        "CAST(id % 20 AS STRING) AS d", "CAST(pmod(id * 7919, 9001) AS INT) AS p", "IF(id % 13 = 0, NULL, pmod(id * 31, 10007) / 8) AS m"
    )


def test_merged_sketches_are_as_near_as_stated(spark, tmp_path):
    df = _facts(spark)
    sketches(df, "d", "p", "m").write.parquet(str(tmp_path / "s"))
    parts = spark.read.parquet(str(tmp_path / "s"))
    assert parts.count() == 20
    whole = merged(parts, quantiles=(0.1, 0.5, 0.99)).first()
    once = merged(sketches(df.withColumn("d", F.lit("all")), "d", "p", "m"), quantiles=(0.1, 0.5, 0.99)).first()
    exact = df.agg(F.count("*"), F.avg("m"), F.min("m"), F.max("m"), F.count_distinct("p")).first()
    assert (whole.filas, whole.minimo, whole.maximo) == (exact[0], exact[2], exact[3])
    assert whole.promedio == pytest.approx(exact[1])
    for found in (whole, once):
        assert abs(found.distintos - exact[4]) <= 3 * DISTINCT_ERROR * exact[4]
        for name, share in (("cuantil_10", 0.1), ("cuantil_50", 0.5), ("cuantil_99", 0.99)):
            value = found[name]
            below = df.agg(F.avg((F.col("m") < value).cast("int")), F.avg((F.col("m") <= value).cast("int"))).first()
            assert below[0] - RANK_ERROR <= share <= below[1] + RANK_ERROR
    by = merged(parts, (F.col("d").cast("int") % 2).alias("odd")).collect()
    assert sorted(r.filas for r in by) == [30_000, 30_000]
    none = merged(sketches(df.withColumn("m", F.lit(None).cast("double")), "d", "p", "m")).first()
    assert none.promedio is None and none.cuantil_50 is None


def test_cubes_equal_a_grouping_of_each_subset(spark):
    data = [("a", "x", 1, 1.0), ("a", None, 1, 2.0), ("a", "x", 2, None), (None, "x", 2, 4.0), (None, None, None, 8.0), ("a", "x", 1, 1.0)]
    df = spark.createDataFrame(data, "k1 string, k2 string, e int, m double")
    found = {(r.k1, r.k2, r.nivel): (r.filas, r.suma, r.distintos, r.minimo, r.promedio) for r in cube(df, ["k1", "k2"], "e", "m").collect()}
    wanted = defaultdict(list)
    for k1, k2, e, m in data:
        for level in range(4):
            wanted[None if level & 2 else k1, None if level & 1 else k2, level].append((e, m))
    assert found.keys() == wanted.keys()
    for key, cell in wanted.items():
        amounts = [m for _, m in cell if m is not None]
        distinct = len({e for e, _ in cell} - {None})
        average = sum(amounts) / len(amounts) if amounts else None
        assert found[key] == (len(cell), sum(amounts) if amounts else None, distinct, min(amounts, default=None), average)
    assert plan(cube(df, ["k1", "k2"], "e", "m")).split("(1)")[0].count("Scan ExistingRDD") == 1


def test_samples_are_the_rows_of_least_hash_at_any_partitioning(spark):
    df = spark.range(5000).selectExpr(
        "IF(id % 3 = 0, 'hot', IF(id % 50 = 1, NULL, CAST(id % 7 AS STRING))) AS g", "id AS n", "IF(id % 2 = 0, NULL, 'é') AS t"
    )
    wanted = defaultdict(list)
    for r in df.withColumn("h", row_hash(df.columns)).collect():
        wanted[r.g].append((r.h, r.n))
    wanted = sorted(n for some in wanted.values() for _, n in sorted(some)[:4])
    for parts in (1, 13):
        found = fair_sample(df.repartition(parts), "g", 4)
        assert found.columns == df.columns
        assert sorted(r.n for r in found.collect()) == wanted
    # Samples of two halves make the sample of the whole.
    halves = fair_sample(df.where("n < 700"), "g", 4).unionByName(fair_sample(df.where("n >= 700"), "g", 4))
    assert sorted(r.n for r in fair_sample(halves, "g", 4).collect()) == wanted
    assert fair_sample(df.where("false"), "g", 4).collect() == []
    few = spark.createDataFrame([("a", 1), ("a", 1)], "g string, n int")
    assert fair_sample(few, "g", 5).count() == 2


# --- streams ----------------------------------------------------------------------------


def _delivered(tmp_path, name, lines):
    (tmp_path / "in").mkdir(exist_ok=True)
    text = "ID_PERSONA|ID_EMPRESA|MONTO|FECHA\n" + "".join(f"{x}\n" for x in lines)
    (tmp_path / "in" / name).write_bytes(text.encode("iso-8859-1"))


def test_files_land_once_even_if_a_batch_is_done_again(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert landed(lake, TRANSACCION).collect() == []
    _delivered(tmp_path, "a", ["1|1|5|2024-01-01", "2|1|6|2024-01-02", r"\N|1||é"])
    _delivered(tmp_path, "b", ["3|1|7|2024-01-01"])
    source = str(tmp_path / "in")
    run_landing_stream(lake, TRANSACCION, source, files_per_batch=1)
    first = rows(landed(lake, TRANSACCION))
    assert sum(first.values()) == 4 and {r[BATCH] for r in landed(lake, TRANSACCION).collect()} == {0, 1}
    # Killed after its last batch was written, before that was committed: the batch is repeated.
    commits = tmp_path / "lake" / CONTROL / "stream_transaccion" / "commits"
    for file in [commits / "1", commits / ".1.crc"]:
        file.unlink()
    run_landing_stream(lake, TRANSACCION, source, files_per_batch=1)
    assert rows(landed(lake, TRANSACCION)) == first
    # Killed while it wrote: half a batch is there.
    for file in [commits / "1", commits / ".1.crc"]:
        file.unlink()
    for file in (tmp_path / "lake" / "landing_stream" / "transaccion" / "lote=1").rglob("*.parquet"):
        file.unlink()
    _delivered(tmp_path, "c", ["9|9|9|2024-01-09"])
    run_landing_stream(lake, TRANSACCION, source)
    found = landed(lake, TRANSACCION)
    assert rows(found.where(f"{BATCH} < 2")) == first and found.count() == 5
    run_landing_stream(lake, TRANSACCION, source)
    assert landed(lake, TRANSACCION).count() == 5


def test_entities_without_partition_stream_too(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p").write_bytes("1|José|1|a|2020-01-01|30|1|2\n".encode("iso-8859-1"))
    run_landing_stream(lake, PERSONA, str(tmp_path / "in"), header=False)
    [row] = landed(lake, PERSONA).collect()
    assert (row.nombre, row.edad, row[BATCH]) == ("José", "30", 0)
    assert stream_path(lake, PERSONA).endswith("landing_stream/persona")
