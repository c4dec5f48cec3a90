import pytest
from pyspark.sql import functions as F

from strata.operators.layout import lower_names, partition_column_last
from strata.scratch import scratch_path
from strata.sinks.layers import append_audit, write_layer
from strata.sources.layers import read_layer
from strata.specs import AUDIT, TRANSACCION
from tests.support import plan, rows

SCHEMA = TRANSACCION.curated


def _facts(spark, *pairs):
    return spark.createDataFrame([("1", "2", amount, date) for date, amount in pairs], SCHEMA)


def _stored(spark, path):
    found = read_layer(spark, str(path), SCHEMA).select("FECHA", "MONTO").collect()
    return sorted(((r.FECHA, r.MONTO) for r in found), key=str)


def test_static_and_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(_facts(spark, ("2024-01-01", 1.0), ("2024-01-02", 2.0)), path, partition_by="FECHA")
    newer = _facts(spark, ("2024-01-02", 3.0))
    write_layer(newer, path, partition_by="FECHA", mode="incremental")
    assert _stored(spark, path) == [("2024-01-01", 1.0), ("2024-01-02", 3.0)]
    write_layer(newer, path, partition_by="FECHA", mode="incremental")
    assert _stored(spark, path) == [("2024-01-01", 1.0), ("2024-01-02", 3.0)]
    write_layer(newer, path, partition_by="FECHA")
    assert _stored(spark, path) == [("2024-01-02", 3.0)]


def test_overwrite_mode_is_not_a_session_matter(spark, tmp_path, setting):
    path = str(tmp_path / "t")
    setting("spark.sql.sources.partitionOverwriteMode", "dynamic")
    write_layer(_facts(spark, ("2024-01-01", 1.0)), path, partition_by="FECHA")
    write_layer(_facts(spark, ("2024-01-02", 2.0)), path, partition_by="FECHA")
    assert _stored(spark, path) == [("2024-01-02", 2.0)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"


def test_a_missing_date_is_kept(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(_facts(spark, (None, 1.0), ("2024-01-01", 2.0)), str(path), partition_by="FECHA")
    assert (path / "FECHA=__HIVE_DEFAULT_PARTITION__").is_dir()
    assert _stored(spark, path) == [("2024-01-01", 2.0), (None, 1.0)]


def test_a_hot_date_is_split_over_files(spark, tmp_path, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    amounts = spark.range(60_000).select(
        F.lit("1").alias("ID_PERSONA"),
        F.lit("2").alias("ID_EMPRESA"),
        F.rand(1).alias("MONTO"),
        F.when(F.col("id") % 3 > 0, "2024-01-01")
        .otherwise(F.concat(F.lit("2024-02-"), (10 + F.col("id") % 19).cast("string")))
        .alias("FECHA"),
    )
    write_layer(amounts, str(tmp_path / "t"), partition_by="FECHA")
    assert len(list((tmp_path / "t" / "FECHA=2024-01-01").glob("*.snappy.parquet"))) > 1
    assert read_layer(spark, str(tmp_path / "t"), SCHEMA).count() == 60_000


def test_partition_column_stays_text_and_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(_facts(spark, ("2024-01-01", 1.0), ("2024-01-02", 2.0)), path, partition_by="FECHA")
    stored = read_layer(spark, path, SCHEMA)
    assert stored.schema == SCHEMA
    text = plan(stored.where("FECHA = '2024-01-02' AND MONTO >= 2").select("ID_PERSONA"))
    assert "PartitionFilters: [isnotnull(FECHA" in text
    assert "GreaterThanOrEqual(MONTO,2.0)" in text
    assert "ReadSchema: struct<ID_PERSONA:string,MONTO:double>" in text


def test_clustered_writes_do_not_shuffle(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    facts = _facts(spark, *[(f"2024-01-{d:02d}", float(d)) for d in range(1, 29)])
    write_layer(facts, source, partition_by="FECHA")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("clustered", "")
    write_layer(read_layer(spark, source, SCHEMA), target, partition_by="FECHA", clustered=True)
    spark.sparkContext.setJobGroup("", "")
    jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup("clustered")]
    assert jobs and all(len(job.stageIds) == 1 for job in jobs)
    assert rows(read_layer(spark, target, SCHEMA)) == rows(facts)


def test_bad_modes(spark, tmp_path):
    with pytest.raises(ValueError):
        write_layer(_facts(spark, ("a", 1.0)), str(tmp_path / "t"), mode="merge")
    with pytest.raises(ValueError):
        write_layer(_facts(spark, ("a", 1.0)), str(tmp_path / "t"), mode="incremental")


def test_unpartitioned_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(_facts(spark, ("a", 1.0)), path)
    write_layer(_facts(spark, ("b", 2.0)), path)
    assert _stored(spark, path) == [("b", 2.0)]


def test_layout(spark):
    df = spark.createDataFrame([("d", "x")], "FECHA STRING, MONTO STRING")
    assert lower_names(df).columns == ["fecha", "monto"]
    assert partition_column_last(df, "fecha").columns == ["MONTO", "FECHA"]
    assert partition_column_last(df, None).columns == ["FECHA", "MONTO"]


def test_audit_only_grows(spark, tmp_path):
    one = spark.createDataFrame([(100.0, 1, 1, "PERSONA", "t1")], AUDIT)
    append_audit(one, str(tmp_path / "audit"))
    append_audit(one, str(tmp_path / "audit"))
    assert read_layer(spark, str(tmp_path / "audit"), AUDIT).count() == 2


def test_unknown_formats_are_refused_by_spark(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)avro"):
        write_layer(_facts(spark, ("a", 1.0)), str(tmp_path / "t"), fmt="avro")


class _Session:
    """The one part of a session that scratch paths need; its folder setting is static."""

    def __init__(self, **settings):
        self.conf = {f"spark.{k.replace('_', '.')}": v for k, v in settings.items()}


def test_scratch_uses_the_named_folder():
    session = _Session(master="yarn", checkpoint_dir="/shared/checkpoints/")
    first, second = scratch_path(session, "gold"), scratch_path(session, "gold")
    assert first.startswith("/shared/checkpoints/strata/gold-")
    assert first != second


def test_scratch_without_a_folder_is_for_one_machine():
    with pytest.raises(RuntimeError):
        scratch_path(_Session(master="yarn"), "gold")
    assert "strata" in scratch_path(_Session(master="local[2]"), "gold")
