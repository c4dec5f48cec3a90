import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from strata.sinks.layers import write_raw
from strata.sources.avsc import read_avsc, struct_from_avsc
from strata.sources.delimited import read_csv_export, read_delimited, read_raw
from strata.specs import PERSONA, TRANSACCION, partition_last

THREE = StructType([StructField(c, StringType()) for c in ("A", "B", "C")])


def test_delivered_text_edges(spark, tmp_path):
    text = 'x|y|z\n1|José|\n2|""|5\n3|\\N|6\n\n4|x\n5|a|b|c\n'
    (tmp_path / "in.data").write_bytes(text.encode("iso-8859-1"))
    found = read_delimited(spark, str(tmp_path / "in.data"), THREE)
    assert [tuple(r) for r in found.orderBy("A").collect()] == [
        ("1", "José", None),
        ("2", "", "5"),
        ("3", None, "6"),
        ("4", "x", None),
        ("5", "a", "b"),
    ]


def test_raw_layer_keeps_every_value_apart(spark, tmp_path):
    values = [
        ("1", "", None),
        ("2", "  both  ", "\ttab"),
        ("3", 'say "hi"', "a|b"),
        ("4", "back\\slash", "ñandú €"),
        ("5", "'", " "),
        ("6", None, "# no comment"),
    ]
    df = spark.createDataFrame(values, THREE)
    write_raw(df, str(tmp_path / "raw"))
    back = read_raw(spark, str(tmp_path / "raw"), THREE)
    assert [tuple(r) for r in back.orderBy("A").collect()] == values


def test_csv_export_needs_a_schema_or_inference(spark, tmp_path):
    with pytest.raises(ValueError):
        read_csv_export(spark, str(tmp_path))
    with pytest.raises(ValueError):
        read_csv_export(spark, str(tmp_path), THREE, infer=True)


def test_avro_schema_file(spark, tmp_path):
    text = """{"name": "T", "type": "record", "fields": [
      {"name": "A", "type": ["string", "null"]}, {"name": "B", "type": "int"}]}"""
    path = tmp_path / "t.avsc"
    path.write_text(text)
    wanted = StructType([StructField("A", StringType()), StructField("B", IntegerType(), False)])
    assert read_avsc(spark, str(path)) == wanted == struct_from_avsc(text)


@pytest.mark.parametrize(
    "text",
    ['{"type": "string"}', '{"type": "record", "fields": [{"name": "a", "type": ["int", "long"]}]}'],
)
def test_unsupported_avro_schemas_are_refused(text):
    with pytest.raises(ValueError):
        struct_from_avsc(text)


def test_schemas_per_layer():
    assert TRANSACCION.landing.fieldNames() == ["id_persona", "id_empresa", "monto", "fecha"]
    assert PERSONA.curated["EDAD"].dataType == IntegerType()
    assert partition_last(["FECHA", "A", "B"], "fecha") == ["A", "B", "FECHA"]
    with pytest.raises(ValueError):
        partition_last(["A"], "B")
