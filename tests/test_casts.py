import math
import random

import pytest
from pyspark.sql import functions as F

from strata.functions.casts import lenient, lenient_double, lenient_int

INTS = {
    "32": 32,
    "32.7": 32,
    " 32 ": 32,
    "\t32.7\t": 32,
    "+7": 7,
    "-0.5": 0,
    "-32.9": -32,
    ".5": 0,
    "5.": 5,
    ".": 0,
    "+.": 0,
    "0000000000012.5": 12,
    "2147483647.9": 2147483647,
    "-2147483648.9": -2147483648,
    "2147483648.5": None,
    "99999999999": None,
    "9999999999": None,
    "1e2": None,
    "abc": None,
    "": None,
    "+": None,
    "1.2.3": None,
    "3 2": None,
    "NaN": None,
    None: None,
}
DOUBLES = {
    "1e2": 100.0,
    " 1.5 ": 1.5,
    "Infinity": math.inf,
    "-Infinity": -math.inf,
    "1.0d": 1.0,
    "abc": None,
    "": None,
    ".": None,
    None: None,
}


def _cast(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize("on", [True, False])
def test_int_edges_in_both_modes(spark, ansi, on):
    ansi(on)
    assert _cast(spark, INTS, lenient_int(F.col("v"))) == list(INTS.values())


@pytest.mark.parametrize("on", [True, False])
def test_double_edges_in_both_modes(spark, ansi, on):
    ansi(on)
    assert _cast(spark, DOUBLES, lenient_double(F.col("v"))) == list(DOUBLES.values())
    assert math.isnan(_cast(spark, ["NaN"], lenient_double(F.col("v")))[0])


def test_casts_agree_with_the_legacy_ones_on_random_text(spark, ansi):
    chance = random.Random(7)
    alphabet = "0123456789.+-eEdDf \t\x00\x7f\x0bxnaif"
    values = [
        "".join(chance.choice(alphabet) for _ in range(chance.randint(0, 7))) for _ in range(20_000)
    ]
    source = spark.createDataFrame([(v,) for v in values], "v STRING")
    value = F.col("v")
    new = source.select("v", lenient_int(value).alias("i"), lenient_double(value).alias("d"))
    found = sorted((r.v, str(r.i), str(r.d)) for r in new.collect())
    ansi(False)
    old = source.select("v", value.cast("int").alias("i"), value.cast("double").alias("d"))
    assert found == sorted((r.v, str(r.i), str(r.d)) for r in old.collect())


def test_lenient_follows_the_declared_type(spark):
    df = spark.createDataFrame([("7.9",)], "v STRING")
    kinds = [f.dataType for f in spark.createDataFrame([], "a INT, b DOUBLE, c STRING").schema]
    row = df.select(*[lenient(F.col("v"), k) for k in kinds]).first()
    assert tuple(row) == (7, 7.9, "7.9")
