"""The entities and their schemas in each layer.

A ``TableSpec`` carries everything the stages need to know about one entity, so
that the stages themselves stay generic.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Column names, their order, types and accepted ranges.
PERSONA_RAW = ("ID", "NOMBRE", "TELEFONO", "CORREO", "FECHA_INGRESO", "EDAD", "SALARIO", "ID_EMPRESA")
EMPRESA_RAW = ("ID", "NOMBRE")
TRANSACCION_RAW = ("ID_PERSONA", "ID_EMPRESA", "MONTO", "FECHA")

PERSONA_RULES = {
    "id_present": "ID IS NOT NULL",
    "employer_present": "ID_EMPRESA IS NOT NULL",
    "age_in_range": "EDAD BETWEEN 1 AND 99",
    "salary_in_range": "SALARIO BETWEEN 0.01D AND 9999999.99D",
}
EMPRESA_RULES = {"id_present": "ID IS NOT NULL"}
TRANSACCION_RULES = {
    "person_present": "ID_PERSONA IS NOT NULL",
    "company_present": "ID_EMPRESA IS NOT NULL",
    "amount_not_negative": "MONTO >= 0D",
}

GOLD = StructType(
    [
        StructField("ID_PERSONA", IntegerType()),
        StructField("NOMBRE_PERSONA", StringType()),
        StructField("EDAD_PERSONA", IntegerType()),
        StructField("SALARIO_PERSONA", DoubleType()),
        StructField("TRABAJO_PERSONA", StringType()),
        StructField("MONTO_TRANSACCION", DoubleType()),
        StructField("EMPRESA_TRANSACCION", StringType()),
        StructField("FECHA_TRANSACCION", StringType()),
    ]
)
GOLD_PARTITION = "FECHA_TRANSACCION"

# The column of the verdict on a row, and the verdicts.
VERDICT = "veredicto"
ACCEPTED, REJECTED = "aceptada", "rechazada"

AUDIT = StructType(
    [
        StructField("calidad_pct", DoubleType()),
        StructField("curated", LongType()),
        StructField("origen", LongType()),
        StructField("tabla", StringType()),
        StructField("ejecucion", StringType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """One entity: its text columns, the typed ones among them, its partition and rules."""

    name: str
    columns: tuple[str, ...]
    typed: Mapping[str, DataType] = field(default_factory=dict)
    rules: Mapping[str, str] = field(default_factory=dict)
    partition_by: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "typed", MappingProxyType(dict(self.typed)))
        object.__setattr__(self, "rules", MappingProxyType(dict(self.rules)))

    @property
    def raw(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in self.columns])

    @property
    def landing(self) -> StructType:
        ordered = partition_last([c.lower() for c in self.columns], self.partition_by)
        return StructType([StructField(c, StringType()) for c in ordered])

    @property
    def curated(self) -> StructType:
        ordered = partition_last(self.columns, self.partition_by)
        return StructType([StructField(c, self.typed.get(c, StringType())) for c in ordered])


def partition_last(columns, partition_by: str | None) -> list[str]:
    """``columns`` with the partition column, matched without regard to case, at the end."""
    if partition_by is None:
        return list(columns)
    wanted = partition_by.lower()
    tail = [c for c in columns if c.lower() == wanted]
    if not tail:
        raise ValueError(f"partition column {partition_by} is not among {list(columns)}")
    return [c for c in columns if c.lower() != wanted] + tail


PERSONA = TableSpec(
    "PERSONA", PERSONA_RAW, {"EDAD": IntegerType(), "SALARIO": DoubleType()}, PERSONA_RULES
)
EMPRESA = TableSpec("EMPRESA", EMPRESA_RAW, {}, EMPRESA_RULES)
TRANSACCION = TableSpec(
    "TRANSACCION", TRANSACCION_RAW, {"MONTO": DoubleType()}, TRANSACCION_RULES, "FECHA"
)
ENTITIES = (PERSONA, EMPRESA, TRANSACCION)
