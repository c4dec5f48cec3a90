"""The stored layers as catalog tables, for those who query them in SQL."""

from __future__ import annotations

from pyspark.sql.types import StructType

from strata.plans.stages import (
    AUDIT_TABLE,
    CURATED,
    FUNCTIONAL,
    GOLD_TABLE,
    LANDING,
    LAYERS,
    RAW,
    Lake,
)
from strata.sinks import catalog
from strata.sources.avro import FORMAT as AVRO
from strata.sources.delimited import DIALECT, LAYER_ENCODING
from strata.specs import AUDIT, ENTITIES, GOLD, GOLD_PARTITION


def database(environment: str, layer: str) -> str:
    return f"{environment}_{layer}".lower()


def register_layers(lake: Lake, environment: str) -> list[str]:
    """One database per layer with an external table per entity; returns the databases.

    Only metadata: files are neither moved nor read. Run it again after new partitions. A landing
    layer in Avro files becomes temporary views, named <database>_<table>.
    """
    spark = lake.spark
    for layer in LAYERS:
        location = f"{lake.root.rstrip('/')}/{layer}"
        catalog.create_database(spark, database(environment, layer), location)

    text = {**DIALECT, "encoding": LAYER_ENCODING, "compression": "none"}
    for spec in ENTITIES:
        _register(lake, environment, RAW, spec.name, spec.raw, fmt="csv", options=text)
        landing = {"fmt": lake.landing_format, "partition_by": spec.partition_by}
        _register(lake, environment, LANDING, spec.name, spec.landing, **landing)
        curated = {"partition_by": spec.partition_by}
        _register(lake, environment, CURATED, spec.name, spec.curated, **curated)
    _register(lake, environment, FUNCTIONAL, GOLD_TABLE, GOLD, partition_by=GOLD_PARTITION)
    audit = f"{database(environment, CURATED)}.{AUDIT_TABLE}"
    catalog.drop_table(spark, audit)
    catalog.create_table(spark, audit, AUDIT, lake.audit_path)
    return [database(environment, layer) for layer in LAYERS]


def _register(
    lake: Lake, environment: str, layer: str, name: str, schema: StructType, **how
) -> None:
    if how.get("fmt") == AVRO:
        # A table over a Python source is given no options, so those of a session see a view.
        spec = next(s for s in ENTITIES if s.name == name)
        lake.landing(spec).createOrReplaceTempView(f"{database(environment, layer)}_{name.lower()}")
        return
    table = f"{database(environment, layer)}.{name.lower()}"
    catalog.drop_table(lake.spark, table)
    place = lake.path(layer, name)
    if layer == CURATED:
        place = lake.curated_path(next(s for s in ENTITIES if s.name == name))
    catalog.create_table(lake.spark, table, schema, place, **how)
    if how.get("partition_by"):
        catalog.register_partitions(lake.spark, table)
