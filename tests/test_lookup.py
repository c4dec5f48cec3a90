import pytest
from pyspark.sql import functions as F

from strata.operators.lookup import STRATEGIES, hot_keys, is_small, lookup
from tests.support import plan, rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, all of them copies; a tenth without a key."""
    n = F.col("id")
    key = (
        F.when(n % 3 == 0, "hot")
        .when(n % 10 == 1, F.lit(None).cast("string"))
        .otherwise((n % 400).cast("string"))
    )
    return spark.range(6000).select(key.alias("k"), F.when(n % 3 == 0, 0).otherwise(n).alias("v"))


@pytest.fixture(scope="module")
def dimension(spark):
    """Most keys once, some not at all, the hot one and a few others twice."""
    named = [(str(i), f"n{i}") for i in range(0, 300)]
    repeated = [("hot", "h1"), ("hot", "h2"), ("7", "again"), (None, "nobody"), ("01", "untrimmed")]
    return spark.createDataFrame(named + repeated, "ID STRING, NOMBRE STRING")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("strategy", STRATEGIES)
def test_strategies_give_the_plain_join(skewed, dimension, how, strategy):
    plain = skewed.join(dimension, skewed.k == dimension.ID, how).select("k", "v", "NOMBRE")
    found = lookup(skewed, dimension, "k", "ID", {"NOMBRE": "NOMBRE"}, how, strategy)
    assert rows(found) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_isolated_without_any_hot_key(spark, dimension, how):
    fact = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    plain = fact.join(dimension, fact.k == dimension.ID, how).select("k", "NOMBRE")
    found = lookup(fact, dimension, "k", "ID", {"NOMBRE": "NOMBRE"}, how, "isolate")
    assert "Union" not in plan(found)
    assert rows(found) == rows(plain)


def test_hot_keys_are_found(skewed):
    found = hot_keys(skewed, "k", "v")
    assert set(found["k"]) == {"hot", None}
    assert found["v"] == [0]


def test_a_large_dimension_is_not_broadcast(spark, skewed, dimension, monkeypatch):
    monkeypatch.setattr("strata.operators.lookup.is_small", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup(skewed, dimension, "k", "ID", {"NOMBRE": "NOMBRE"}, "left", "broadcast")
        assert "BroadcastHashJoin" not in plan(found)
        plain = skewed.join(dimension, skewed.k == dimension.ID, "left")
        assert found.count() == plain.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_do_not_cross_the_network(spark, skewed, dimension, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(lookup(skewed, dimension, "k", "ID", {"NOMBRE": "N"}, "inner", "isolate"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" in text


def test_forced_strategies_show_in_the_plan(skewed, dimension, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    named = {"NOMBRE": "N"}
    assert "BroadcastHashJoin" in plan(lookup(skewed, dimension, "k", "ID", named, "left", "broadcast"))
    assert "SortMergeJoin" in plan(lookup(skewed, dimension, "k", "ID", named, "left", "shuffle"))


def test_size_bounds(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "a STRING")
    assert is_small(df)
    assert not is_small(df, max_rows=10)
    assert is_small(df, max_rows=11)
    assert not is_small(df, max_bytes=1000)
    assert is_small(df.limit(0))


def test_bad_arguments(skewed, dimension):
    with pytest.raises(ValueError):
        lookup(skewed, dimension, "k", "ID", {}, "left", "guess")
    with pytest.raises(ValueError):
        lookup(skewed, dimension, "k", "ID", {}, "outer")


def test_isolated_lookups_read_the_fact_once(spark, tmp_path, setting):
    """Both keys hot, no automatic broadcast: one scan of the fact, and rows as of a plain join."""
    fact = spark.range(4000).selectExpr(
        "IF(id % 2 = 0, 'a', CAST(id % 50 AS STRING)) AS k1",
        "IF(id % 3 = 0, NULL, IF(id % 3 = 1, 'b', CAST(id % 40 AS STRING))) AS k2",
        "id AS v",
    )
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dimension = spark.range(30).selectExpr("CAST(id AS STRING) AS ID", "CAST(id AS STRING) AS N")
    dimension = dimension.union(spark.sql("VALUES ('a', 'x'), ('a', 'y'), ('b', 'z')"))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")

    def both(strategy):
        one = lookup(fact, dimension, "k1", "ID", {"N": "n1"}, "inner", strategy)
        return lookup(one, dimension, "k2", "ID", {"N": "n2"}, "left", strategy)

    assert rows(both("isolate")) == rows(both("auto"))
    text = plan(both("isolate"))
    assert len([x for x in text.splitlines() if x.startswith("Location") and "/fact]" in x]) == 1
