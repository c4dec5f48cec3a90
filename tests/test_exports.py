import datetime as dt

import pytest

from strata.sinks.exports import (
    EmptyExport,
    export_csv,
    export_documents,
    export_single_csv,
    verify_documents,
)
from strata.sources.delimited import read_csv_export
from strata.sources.layers import read_documents
from strata.specs import GOLD
from tests.support import rows


@pytest.fixture(scope="module")
def gold(spark):
    return spark.createDataFrame(
        [
            (1, "Ana", 30, 10.5, "Uno", 0.1, "Dos", "2024-01-01"),
            (None, "", 31, 1e-7, None, 1e12, " Dos ", "2024-01-02"),
            (3, 'a,"b"', 32, 3.0, "ñ", 2.0, "x\ty", "2024-01-02"),
        ],
        GOLD,
    )


def test_csv_round_trip(spark, gold, tmp_path):
    path = str(tmp_path / "csv")
    export_csv(gold, path)
    back = read_csv_export(spark, path, GOLD).orderBy("EDAD_PERSONA").collect()
    wanted = [list(r) for r in gold.orderBy("EDAD_PERSONA").collect()]
    # CSV keeps neither empty text nor outer blanks.
    wanted[1][1], wanted[1][6] = None, "Dos"
    assert [list(r) for r in back] == wanted


def test_inferred_types(spark, gold, tmp_path):
    path = str(tmp_path / "csv")
    export_csv(gold, path)
    back = read_csv_export(spark, f"{path}/part-*.csv", infer=True)
    kinds = dict(back.dtypes)
    assert kinds["FECHA_TRANSACCION"] == "date" and kinds["ID_PERSONA"] == "int"
    assert back.where("ID_PERSONA = 1").first().FECHA_TRANSACCION == dt.date(2024, 1, 1)


def test_one_csv_file_from_parallel_parts(spark, gold, tmp_path):
    target = str(tmp_path / "one.csv")
    export_single_csv(gold.repartition(3), str(tmp_path / "parts"), target)
    assert len(list((tmp_path / "parts").glob("part-*.csv"))) > 1
    export_csv(gold, str(tmp_path / "folder"))
    assert rows(read_csv_export(spark, target, GOLD)) == rows(
        read_csv_export(spark, str(tmp_path / "folder"), GOLD)
    )


def test_number_of_csv_files(spark, gold, tmp_path):
    many = gold.sparkSession.range(1000)
    export_csv(many, str(tmp_path / "three"), parts=3)
    assert len(list((tmp_path / "three").glob("part-*.csv"))) == 3


def test_documents_keep_types_and_are_verified(spark, gold, tmp_path):
    path = str(tmp_path / "json")
    export_documents(gold, path)
    export_documents(gold, path)
    assert rows(read_documents(spark, path, GOLD)) == rows(gold)
    assert tuple(verify_documents(gold, path).first()) == ("json", 3, 3, True)
    assert tuple(verify_documents(gold.limit(2), path).first()) == ("json", 2, 3, False)


def test_other_formats_are_parameters(spark, gold, tmp_path):
    path = str(tmp_path / "orc")
    export_documents(gold, path, fmt="orc", options={"compression": "zlib"})
    assert verify_documents(gold, path, fmt="orc").first().coincide


def test_nothing_to_export(gold, tmp_path):
    with pytest.raises(EmptyExport):
        export_documents(gold.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
