"""The given tables in the roles of the three entities, all text as a delivery would be.

The dirty roles add bad numbers, blanks, empty text and missing keys by rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _person(spark: SparkSession, sf_dir: str, age: str, salary: str, employer: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS ID",
        "c_name AS NOMBRE",
        "lpad(CAST(c_custkey AS STRING), 9, '0') AS TELEFONO",
        "concat(lower(c_mktsegment), '@example.org') AS CORREO",
        "CAST(date_add(DATE '2000-01-01', CAST(c_custkey % 3650 AS INT)) AS STRING) AS FECHA_INGRESO",
        f"{age} AS EDAD",
        f"{salary} AS SALARIO",
        f"{employer} AS ID_EMPRESA",
    )


def persona(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as persons; age 0 and balances up to 0 will be rejected."""
    return _person(
        spark,
        sf_dir,
        age="CAST(c_custkey % 100 AS STRING)",
        salary="CAST(c_acctbal AS STRING)",
        employer="CAST(c_nationkey AS STRING)",
    )


def persona_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later delivery of ``persona``: some renamed, some at another employer, some gone."""
    number = "CAST(ID AS BIGINT)"
    return (
        persona(spark, sf_dir)
        .where(f"{number} % 11 <> 5")
        .withColumns(
            {
                "NOMBRE": F.expr(f"IF({number} % 7 = 3, concat(NOMBRE, ' II'), NOMBRE)"),
                "ID_EMPRESA": F.expr(f"IF({number} % 13 = 2, '6', ID_EMPRESA)"),
            }
        )
    )


def empresa_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later delivery of ``empresa``: one renamed, one under another key."""
    return empresa(spark, sf_dir).selectExpr(
        "IF(ID = '9', 'Y9', ID) AS ID", "IF(ID = '7', concat(NOMBRE, ' SA'), NOMBRE) AS NOMBRE"
    )


def employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' employers over time: three each, the last of some unknown."""
    first = "date_add(DATE '2023-12-29', CAST(c_custkey % 15 AS INT))"
    states = [
        f"struct(date_add({first}, {days}) AS desde, {employer} AS empleador)"
        for days, employer in (
            (0, "CAST(c_nationkey AS STRING)"),
            (8, "CAST((c_nationkey + 1) % 25 AS STRING)"),
            (20, "IF(c_custkey % 4 = 0, NULL, CAST((c_nationkey + 2) % 25 AS STRING))"),
        )
    ]
    rows = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS ID", f"explode(array({', '.join(states)})) AS estado"
    )
    return rows.select("ID", "estado.desde", "estado.empleador")


def persona_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _person(
        spark,
        sf_dir,
        age="""CASE c_custkey % 10
          WHEN 0 THEN '' WHEN 1 THEN '32.7' WHEN 2 THEN 'abc' WHEN 3 THEN NULL
          WHEN 4 THEN ' 41 ' WHEN 5 THEN '100' WHEN 6 THEN '0'
          ELSE CAST(18 + c_custkey % 53 AS STRING) END""",
        salary="IF(c_custkey % 11 = 0, 'n/a', CAST(c_acctbal AS STRING))",
        employer="IF(c_custkey % 13 = 0, NULL, CAST(c_nationkey AS STRING))",
    )


def empresa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as companies; those of region 0 under another key, so that some keys dangle."""
    return table(spark, sf_dir, "nation").selectExpr(
        "IF(n_regionkey = 0, concat('X', n_nationkey), CAST(n_nationkey AS STRING)) AS ID",
        "n_name AS NOMBRE",
    )


def empresa_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as companies, every seventh without its key."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "IF(s_suppkey % 7 = 3, NULL, CAST(s_suppkey AS STRING)) AS ID", "s_name AS NOMBRE"
    )


def empresa_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the companies of their nations: every key many times over."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_nationkey AS STRING) AS ID", "s_name AS NOMBRE"
    )


def transaccion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: bought by the order's customer from the supplier's nation."""
    lines, orders, suppliers = (
        table(spark, sf_dir, name) for name in ("lineitem", "orders", "supplier")
    )
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .selectExpr(
            "CAST(o_custkey AS STRING) AS ID_PERSONA",
            "CAST(s_nationkey AS STRING) AS ID_EMPRESA",
            "CAST(l_extendedprice AS STRING) AS MONTO",
            "CAST(to_date(o_orderdate) AS STRING) AS FECHA",
        )
    )


def transaccion_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions over a month of dates."""
    return table(spark, sf_dir, "events").selectExpr(
        "IF(event_id % 19 = 0, NULL, CAST(user_id AS STRING)) AS ID_PERSONA",
        "CAST(event_id % 30 AS STRING) AS ID_EMPRESA",
        """CASE WHEN event_type = 'error' THEN 'err'
          WHEN event_id % 17 = 0 THEN concat('-', CAST(value AS STRING))
          ELSE CAST(value AS STRING) END AS MONTO""",
        "CAST(to_date(ts) AS STRING) AS FECHA",
    )
