import pytest

from strata.sinks import catalog
from strata.sinks.layers import write_layer
from strata.specs import AUDIT, GOLD, TRANSACCION
from tests.support import rows


@pytest.fixture
def database(spark, tmp_path):
    name = "strata_test"
    yield catalog.recreate_database(spark, name, str(tmp_path / "db"))
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _facts(spark, *pairs):
    rows_ = [("1", "2", amount, date) for date, amount in pairs]
    return spark.createDataFrame(rows_, TRANSACCION.curated)


def _table(spark, database, tmp_path, **kwargs):
    return catalog.create_table(
        spark,
        f"{database}.t",
        TRANSACCION.curated,
        str(tmp_path / "t"),
        partition_by="fecha",
        **kwargs,
    )


def test_insert_orders_columns_and_keeps_other_partitions(spark, database, tmp_path):
    table = _table(spark, database, tmp_path)
    first = _facts(spark, ("2024-01-01", 1.0), ("2024-01-02", 2.0))
    catalog.insert_overwrite(first.select("FECHA", "MONTO", "ID_EMPRESA", "ID_PERSONA"), table)
    catalog.insert_overwrite(_facts(spark, ("2024-01-02", 3.0)), table, partition_by="FECHA")
    assert rows(spark.table(table)) == rows(_facts(spark, ("2024-01-01", 1.0), ("2024-01-02", 3.0)))
    assert catalog.table_partitions(spark, table).count() == 2
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_static_table_is_replaced_whole(spark, database, tmp_path):
    table = _table(spark, database, tmp_path, incremental=False)
    catalog.insert_overwrite(_facts(spark, ("2024-01-01", 1.0)), table)
    catalog.insert_overwrite(_facts(spark, ("2024-01-02", 2.0)), table)
    assert rows(spark.table(table)) == rows(_facts(spark, ("2024-01-02", 2.0)))


def test_partitions_written_by_path_are_picked_up(spark, database, tmp_path):
    table = _table(spark, database, tmp_path)
    facts = _facts(spark, ("2024-01-01", 1.0), ("2024-01-02", 2.0))
    write_layer(facts, str(tmp_path / "t"), partition_by="FECHA")
    assert spark.table(table).count() == 0
    catalog.register_partitions(spark, table)
    assert rows(spark.table(table)) == rows(facts)


def test_full_refresh_empties_the_layer(spark, database, tmp_path):
    _table(spark, database, tmp_path)
    assert [r.tabla for r in catalog.layer_tables(spark, database).collect()] == ["t"]
    catalog.recreate_database(spark, database, str(tmp_path / "db"))
    assert catalog.layer_tables(spark, database).isEmpty()


def test_audit_table_is_made_once_and_then_grows(spark, database, tmp_path):
    one = spark.createDataFrame([(100.0, 1, 1, "PERSONA", "t1")], AUDIT)
    for _ in range(2):
        catalog.append_or_create(one, f"{database}.auditoria_calidad", str(tmp_path / "audit"))
    assert spark.table(f"{database}.auditoria_calidad").count() == 2


def test_storage_is_asserted_and_not_assumed(spark, database, tmp_path):
    table = _table(spark, database, tmp_path)
    location = str(tmp_path / "t")
    catalog.insert_overwrite(_facts(spark, ("2024-01-01", 1.0)), table)
    assert tuple(catalog.storage_format(spark, table).first()) == ("t", "parquet", "snappy")
    [files] = catalog.stored_files(spark, location).collect()
    assert (files.codec, files.archivos) == ("snappy", 1) and files.bytes > 0
    catalog.assert_storage(spark, table, location)
    _facts(spark, ("2024-01-02", 1.0)).write.mode("append").partitionBy("FECHA").option(
        "compression", "gzip"
    ).parquet(location)
    with pytest.raises(ValueError, match="gz"):
        catalog.assert_storage(spark, table, location)
    catalog.create_table(spark, f"{database}.j", TRANSACCION.raw, str(tmp_path / "j"), fmt="json")
    with pytest.raises(ValueError, match="json"):
        catalog.assert_storage(spark, f"{database}.j", str(tmp_path / "j"))


def test_odd_names_are_quoted(spark, database, tmp_path):
    location = str(tmp_path / "it's")
    table = catalog.create_table(spark, f"{database}.select", GOLD, location)
    assert spark.catalog.tableExists(table)
