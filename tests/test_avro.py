import datetime as dt
import json
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.plans.stages import Lake, run_curated, run_functional, run_landing, run_raw, storage_report
from strata.plans.tables import register_layers
from strata.sinks.layers import write_layer
from strata.sources import avro
from strata.sources.layers import read_layer
from tests.support import rows

FACTS = "ID_PERSONA STRING, MONTO DOUBLE, FECHA STRING"


def made(count, seed=1):
    rng = random.Random(seed)
    choices = {
        "text": (pa.string(), [None, "", "a", "é" * 70, "x" * 20_000]),
        "whole": (pa.int32(), [None, 0, -1, 63, 64, -64, -65, 2**31 - 1, -(2**31)]),
        "long": (pa.int64(), [None, 2**63 - 1, -(2**63), 5]),
        "double": (pa.float64(), [None, 1.5, float("inf"), -0.0]),
        "single": (pa.float32(), [None, 0.25]),
        "flag": (pa.bool_(), [None, True, False]),
        "raw": (pa.binary(), [None, b"", b"\x00\xff"]),
        "day": (pa.date32(), [None, dt.date(1950, 1, 1), dt.date(2024, 2, 29)]),
        "at": (pa.timestamp("us", "UTC"), [None, 1, -5]),
    }
    weights = {"text": [4, 4, 4, 2, 0.1]}
    return pa.RecordBatch.from_pydict(
        {
            name: pa.array(rng.choices(values, weights.get(name), k=count), kind)
            for name, (kind, values) in choices.items()
        }
    )


def written(path, batch, codec="snappy"):
    file = avro.ContainerWriter(str(path), batch.schema, codec)
    file.write(batch.slice(0, 0))
    file.write(batch.slice(0, 10))
    file.write(batch.slice(10))
    file.close()
    return str(path), path.stat().st_size


def plainly(data):
    """The rows of a container file by the letter of the format, one value after the other."""
    at = 0

    def take(n):
        nonlocal at
        at += n
        assert at <= len(data)
        return data[at - n : at]

    def long():
        value = shift = 0
        while True:
            byte = take(1)[0]
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return (value >> 1) ^ -(value & 1)

    assert take(4) == b"Obj\x01"
    meta = {}
    while count := long():
        for _ in range(count):
            key = take(long()).decode()
            meta[key] = take(long())
    assert meta["avro.codec"] == b"null"
    fields, mark = json.loads(meta["avro.schema"])["fields"], take(16)
    import struct

    while at < len(data):
        count, size = long(), long()
        end = at + size
        for _ in range(count):
            row = []
            for f in fields:
                kind = f["type"][long()]
                kind = kind["type"] if isinstance(kind, dict) else kind
                if kind == "null":
                    row.append(None)
                elif kind in ("int", "long"):
                    row.append(long())
                elif kind in ("string", "bytes"):
                    row.append(take(long()))
                elif kind == "boolean":
                    row.append(take(1) == b"\x01")
                else:
                    row.append(struct.unpack("<d" if kind == "double" else "<f", take(8 if kind == "double" else 4))[0])
            yield tuple(row)
        assert at == end and take(16) == mark


@pytest.mark.parametrize("codec", ["snappy", "deflate", "null"])
def test_files_come_back_however_they_are_cut(tmp_path, codec):
    batch = made(3000)
    path, size = written(tmp_path / "f.avro", batch, codec)
    whole = pa.Table.from_batches(list(avro.read_stretch(path, 0, size))).combine_chunks()
    assert whole.equals(pa.Table.from_batches([batch]))
    for step in (size // 3, 5000, 331):
        parts = [b for a in range(0, size, step) for b in avro.read_stretch(path, a, min(a + step, size))]
        assert pa.Table.from_batches(parts).combine_chunks().equals(whole)


def test_bytes_are_those_of_the_format(tmp_path):
    batch = made(500)
    path, _ = written(tmp_path / "f.avro", batch, "null")
    columns = []
    for name, values in zip(batch.schema.names, batch.columns, strict=True):
        kind = {"text": pa.binary(), "day": pa.int32(), "at": pa.int64()}.get(name)
        columns.append((values if kind is None else values.view(kind) if name != "text" else values.cast(kind)).to_pylist())
    assert list(plainly((tmp_path / "f.avro").read_bytes())) == list(zip(*columns, strict=True))


def test_a_union_with_null_last_and_plain_fields(tmp_path):
    fields = [{"name": "a", "type": ["string", "null"]}, {"name": "b", "type": "long"}]
    schema = json.dumps({"type": "record", "name": "r", "fields": fields}).encode()
    rows_ = b"\x00\x04hi\x06" + b"\x02\x01"
    mark = bytes(range(16))
    head = b"Obj\x01\x02\x16avro.schema" + avro._long(len(schema)) + schema + b"\x00" + mark
    (tmp_path / "f.avro").write_bytes(head + avro._long(2) + avro._long(len(rows_)) + rows_ + mark)
    [batch] = avro.read_stretch(str(tmp_path / "f.avro"), 0, 10_000)
    assert batch.to_pylist() == [{"a": "hi", "b": 3}, {"a": None, "b": -1}]


def test_torn_files_raise(tmp_path):
    path, size = written(tmp_path / "f.avro", made(2000))
    data = (tmp_path / "f.avro").read_bytes()
    torn = tmp_path / "torn.avro"
    for broken in (data[:-1], data[:-17], data[: size // 2], data[:20], b"no" + data, data[:-40] + bytes(24) + data[-16:]):
        torn.write_bytes(broken)
        with pytest.raises(avro.TornFile):
            list(avro.read_stretch(str(torn), 0, len(broken)))
    with pytest.raises(avro.TornFile):
        avro.decode([(2, b"\x02\x02a")], [avro.Column("a", "string", 0)])
    with pytest.raises(avro.TornFile):
        avro.decode([(1, b"\x02\x02aa")], [avro.Column("a", "string", 0)])


def _facts(spark, count=2000):
    fecha = "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 7 = 1 THEN 'a/b=%c' ELSE concat('2024-01-0', id % 7) END"
    return spark.range(count).selectExpr(
        "CAST(id AS STRING) AS ID_PERSONA", "IF(id % 5 = 0, NULL, id / 4) AS MONTO", f"{fecha} AS FECHA"
    )


def _schema(df):
    return df.schema


def test_a_large_file_is_read_by_several_tasks_and_small_ones_share_one(spark, tmp_path):
    df = _facts(spark, 50_000).coalesce(1)
    write_layer(df, str(tmp_path / "one"), fmt=avro.FORMAT)
    assert len(list((tmp_path / "one").glob("*.avro"))) == 1
    reader = spark.read.format(avro.FORMAT).schema(_schema(df))
    found = reader.option("split_bytes", 50_000).load(str(tmp_path / "one"))
    tasks = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(tasks) > 3 and max(tasks) < 25_000
    assert rows(found) == rows(df)
    write_layer(df.repartition(8), str(tmp_path / "many"), fmt=avro.FORMAT)
    reader = spark.read.format(avro.FORMAT).schema(_schema(df))
    assert reader.load(str(tmp_path / "many")).rdd.getNumPartitions() == 1


def test_a_torn_file_fails_the_query(spark, tmp_path):
    write_layer(_facts(spark), str(tmp_path / "t"), fmt=avro.FORMAT)
    file = max((tmp_path / "t").glob("*.avro"), key=lambda p: p.stat().st_size)
    file.write_bytes(file.read_bytes()[:-3])
    with pytest.raises(Exception, match="TornFile"):
        read_layer(spark, str(tmp_path / "t"), _schema(_facts(spark)), fmt=avro.FORMAT).count()


def test_partitions_are_written_pruned_and_replaced(spark, tmp_path):
    path, df = str(tmp_path / "t"), _facts(spark)
    write_layer(df, path, partition_by="FECHA", fmt=avro.FORMAT)
    layer = {"fmt": avro.FORMAT, "partition_by": "FECHA"}
    assert rows(read_layer(spark, path, _schema(df), **layer)) == rows(df)
    assert read_layer(spark, path, _schema(df), **layer).schema == _schema(df)
    # Unread dates may be broken.
    for file in (tmp_path / "t" / "FECHA=2024-01-03").iterdir():
        file.write_bytes(b"broken")
    some = read_layer(spark, path, _schema(df), **layer, only=[None, "a/b=%c", "nowhere"])
    assert rows(some) == rows(df.where("FECHA IS NULL OR FECHA = 'a/b=%c'"))
    again = df.where("FECHA = '2024-01-03'").withColumn("MONTO", F.lit(-1.0))
    write_layer(again, path, partition_by="FECHA", mode="incremental", fmt=avro.FORMAT)
    wanted = df.where("FECHA IS NULL OR FECHA <> '2024-01-03'").unionByName(again)
    assert rows(read_layer(spark, path, _schema(df), **layer)) == rows(wanted)
    # A date that a later delivery has no rows for is emptied.
    scope = ["2024-01-04", "2024-01-05"]
    four = df.where("FECHA = '2024-01-04'")
    write_layer(four, path, partition_by="FECHA", mode="incremental", fmt=avro.FORMAT, scope=scope)
    assert rows(read_layer(spark, path, _schema(df), **layer)) == rows(wanted.where("FECHA IS NULL OR FECHA <> '2024-01-05'"))
    write_layer(four, path, partition_by="FECHA", fmt=avro.FORMAT)
    assert rows(read_layer(spark, path, _schema(df), **layer)) == rows(four)
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["FECHA=2024-01-04"]


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    path, df = str(tmp_path / "t"), _facts(spark)
    write_layer(df, path, partition_by="FECHA", fmt=avro.FORMAT)
    bad = df.withColumn("MONTO", F.when(F.col("ID_PERSONA") == "1999", F.raise_error(F.lit("no"))).otherwise(F.col("MONTO")).cast("double"))
    with pytest.raises(Exception, match="no"):
        write_layer(bad, path, partition_by="FECHA", fmt=avro.FORMAT)
    assert rows(read_layer(spark, path, _schema(df), fmt=avro.FORMAT)) == rows(df)
    assert not list((tmp_path / "t").glob(".staging-*"))


def test_files_no_commit_names_are_dropped(tmp_path):
    schema = avro.from_arrow_schema(pa.schema([("a", pa.string()), ("p", pa.string())]))
    options = {"path": str(tmp_path / "t"), "partition_by": "p"}
    writer = avro.AvroWriter(options, schema, True)
    batch = pa.RecordBatch.from_pydict({"a": ["x", "y"], "p": ["1", None]})
    writer.write(iter([batch]))
    message = writer.write(iter([batch]))
    writer.commit([message, None])
    found = [p.relative_to(tmp_path / "t").parts[0] for p in (tmp_path / "t").rglob("*.avro")]
    assert Counter(found) == {"p=1": 1, "p=__HIVE_DEFAULT_PARTITION__": 1}


def test_inferred_schema_and_columns_of_no_file(spark, tmp_path):
    path = str(tmp_path / "t")
    df = _facts(spark, 100)
    write_layer(df, path, partition_by="FECHA", fmt=avro.FORMAT)
    avro.register(spark)
    assert rows(spark.read.format(avro.FORMAT).load(path)) == rows(df)
    wide = spark.read.format(avro.FORMAT).schema("nuevo INT, id_persona STRING").load(path)
    assert rows(wide) == rows(df.selectExpr("CAST(NULL AS INT) AS nuevo", "ID_PERSONA AS id_persona"))
    with pytest.raises(Exception, match="no Avro counterpart"):
        write_layer(spark.range(3).selectExpr("array(id) AS a"), str(tmp_path / "u"), fmt=avro.FORMAT)


def test_stages_land_in_avro(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), avro.FORMAT)
    persons = "ID|NOMBRE|TELEFONO|CORREO|FECHA_INGRESO|EDAD|SALARIO|ID_EMPRESA\n1|Ana|1|a@x|2020-01-01|30|10.5|7\n"
    facts = "ID_PERSONA|ID_EMPRESA|MONTO|FECHA\n1|7|5|2024-01-01\n1|7|x|2024-01-02\n1|7|6|2024-01-03\n"
    for name, text in (("PERSONA", persons), ("EMPRESA", "ID|NOMBRE\n7|Uno\n"), ("TRANSACCION", facts)):
        (tmp_path / name).write_text(text)
    run_raw(lake, {n: str(tmp_path / n) for n in ("PERSONA", "EMPRESA", "TRANSACCION")})
    run_landing(lake)
    run_curated(lake, "2024-01-01 00:00:00")
    run_functional(lake)
    assert lake.gold().count() == 2
    (tmp_path / "TRANSACCION").write_text("ID_PERSONA|ID_EMPRESA|MONTO|FECHA\n1|7|9|2024-01-03\n")
    run_raw(lake, {n: str(tmp_path / n) for n in ("PERSONA", "EMPRESA", "TRANSACCION")})
    run_landing(lake, mode="incremental")
    run_curated(lake, "2024-01-01 00:00:00", mode="incremental", dates=["2024-01-03"])
    run_functional(lake, mode="incremental", dates=["2024-01-03"])
    amounts = Counter(r.MONTO_TRANSACCION for r in lake.gold().collect())
    assert amounts == {5.0: 1, 9.0: 1}
    report = {(r.capa, r.tabla): r for r in storage_report(lake).collect()}
    assert report["landing", "transaccion"].compresion == "snappy"
    assert report["landing", "transaccion"].filas == 3
    register_layers(lake, "avro_stage_test")
    assert spark.table("avro_stage_test_landing_transaccion").count() == 3
