"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import lenient_int
from strata.operators.changes import content_differences
from strata.operators.checks import (
    chain_metrics,
    integrity_counted,
    key_counts,
    loss_alert,
    match_report,
    step_metrics,
)
from strata.operators.layout import partition_distribution
from strata.operators.quality import (
    apply_rules,
    audit_rows,
    judged,
    quality_reasons,
    quality_report,
    typed,
)
from strata.operators.summaries import (
    DISTINCT_ERROR,
    RANK_ERROR,
    cube,
    fair_sample,
    merged,
    sketches,
)
from strata.operators.temporal import as_of
from strata.plans import roles
from strata.plans.enrichment import enrich, with_employer, with_merchant, with_person
from strata.plans.stages import (
    STEPS,
    Lake,
    functional_metrics,
    run_changed,
    run_curated,
    run_exports,
    run_functional,
    run_landing,
    run_raw,
)
from strata.plans.stages import storage_report as storage_report_of
from strata.plans.tables import register_layers
from strata.scratch import scratch_path
from strata.sinks import catalog
from strata.sinks.exports import (
    export_checked,
    export_csv,
    export_documents,
    export_single_csv,
    verify_documents,
)
from strata.sinks.layers import (
    DEFAULT_PARTITION,
    append_audit,
    unescaped,
    write_judged,
    write_layer,
    write_raw,
)
from strata.sources.avro import FORMAT as AVRO
from strata.sources.delimited import INPUT_ENCODING, read_csv_export, read_raw
from strata.sources.layers import read_documents, read_judged, read_layer
from strata.specs import (
    ACCEPTED,
    AUDIT,
    EMPRESA,
    ENTITIES,
    GOLD,
    GOLD_PARTITION,
    PERSONA,
    REJECTED,
    TRANSACCION,
)
from strata.streaming.landing import BATCH, landed, run_landing_stream

Query = Callable[[SparkSession, str], DataFrame]

STAGES = STEPS
FIRST_RUN = "2024-01-01 00:00:00"
SECOND_RUN = "2024-01-02 00:00:00"


# --- typed, rule-checked entities -------------------------------------------------------


def _entities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        apply_rules(roles.transaccion(spark, sf_dir), TRANSACCION),
        apply_rules(roles.persona(spark, sf_dir), PERSONA),
        apply_rules(roles.empresa(spark, sf_dir), EMPRESA),
    )


def _event_entities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same with events as the fact, whose dates stay few at every scale."""
    _, persona, empresa = _entities(spark, sf_dir)
    return apply_rules(roles.transaccion_dirty(spark, sf_dir), TRANSACCION), persona, empresa


def _dirty(spark: SparkSession, sf_dir: str):
    return [
        (PERSONA, roles.persona_dirty(spark, sf_dir)),
        (EMPRESA, roles.empresa_dirty(spark, sf_dir)),
        (TRANSACCION, roles.transaccion_dirty(spark, sf_dir)),
    ]


def typed_persona(spark, sf_dir):
    return apply_rules(roles.persona_dirty(spark, sf_dir), PERSONA, validate=False)


def typed_transaccion(spark, sf_dir):
    return apply_rules(roles.transaccion_dirty(spark, sf_dir), TRANSACCION, validate=False)


def lenient_int_cast(spark, sf_dir):
    return roles.persona_dirty(spark, sf_dir).select(
        "ID", "EDAD", lenient_int(F.col("EDAD")).alias("EDAD_INT")
    )


def lenient_int_cast_amounts(spark, sf_dir):
    """Every line's price as text to INT: all take the decimal branch."""
    return roles.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        lenient_int(F.col("l_extendedprice").cast("string")).alias("monto_int"),
    )


def quality_persona(spark, sf_dir):
    return apply_rules(roles.persona_dirty(spark, sf_dir), PERSONA)


def quality_empresa(spark, sf_dir):
    return apply_rules(roles.empresa_dirty(spark, sf_dir), EMPRESA)


def quality_transaccion(spark, sf_dir):
    return apply_rules(roles.transaccion_dirty(spark, sf_dir), TRANSACCION)


def quality_report_query(spark, sf_dir):
    return quality_report(_dirty(spark, sf_dir))


# --- enrichment -------------------------------------------------------------------------


def transaccion_enriquecida(spark, sf_dir):
    return enrich(*_entities(spark, sf_dir))


def enrich_step1(spark, sf_dir):
    transaccion, persona, _ = _entities(spark, sf_dir)
    return with_person(transaccion, persona)


def enrich_step2(spark, sf_dir):
    _, _, empresa = _entities(spark, sf_dir)
    return with_employer(enrich_step1(spark, sf_dir), empresa)


def enrich_step3(spark, sf_dir):
    _, _, empresa = _entities(spark, sf_dir)
    return with_merchant(enrich_step2(spark, sf_dir), empresa)


def broadcast_equals_shuffle(spark, sf_dir):
    """The flagship under both forced strategies, each row tagged with its own."""
    return _tagged(spark, sf_dir, "broadcast").unionByName(_tagged(spark, sf_dir, "shuffle"))


def _tagged(spark, sf_dir, strategy):
    return enrich(*_entities(spark, sf_dir), strategy).withColumn("estrategia", F.lit(strategy))


def enrich_hot_keys(spark, sf_dir):
    """The flagship with hot keys kept out of the shuffle."""
    return enrich(*_entities(spark, sf_dir), "isolate")


def enrich_repeated_keys(spark, sf_dir):
    """Metrics of a chain whose company keys repeat, so that each lookup multiplies rows."""
    transaccion, persona, _ = _entities(spark, sf_dir)
    empresa = apply_rules(roles.empresa_repeated(spark, sf_dir), EMPRESA)
    return _rounded(chain_metrics(transaccion, persona, empresa, STAGES))


# --- checks -----------------------------------------------------------------------------


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("monto_promedio", F.round("monto_promedio", 4))


def step_metrics_query(spark, sf_dir):
    """All three steps from one pass over the fact."""
    return _rounded(chain_metrics(*_entities(spark, sf_dir), STAGES))


def final_metrics(spark, sf_dir):
    return _rounded(step_metrics(transaccion_enriquecida(spark, sf_dir), STAGES[-1]))


def integrity_check_query(spark, sf_dir):
    """The fact is read once, into counts by person and company that are then looked up."""
    return _counted_integrity(*_entities(spark, sf_dir))


def integrity_by_date_query(spark, sf_dir):
    """The check for each date, so that the alert of one is not lost among the others."""
    return _counted_integrity(*_event_entities(spark, sf_dir), by_date=True)


def _counted_integrity(transaccion, persona, empresa, by_date: bool = False) -> DataFrame:
    spark, path = transaccion.sparkSession, scratch_path(transaccion.sparkSession, "key-counts")
    counts = key_counts(transaccion, *(["FECHA"] if by_date else []))
    write_layer(counts, path)
    stored = read_layer(spark, path, counts.schema)
    return integrity_counted(stored, enrich(stored, persona, empresa), by_date=by_date)


def loss_alert_query(spark, sf_dir):
    return loss_alert(integrity_check_query(spark, sf_dir))


def match_report_query(spark, sf_dir):
    transaccion, persona, _ = _entities(spark, sf_dir)
    return match_report(
        transaccion, persona, apply_rules(roles.empresa_repeated(spark, sf_dir), EMPRESA)
    )


def sample_rows(spark, sf_dir):
    order = [F.col(c).asc_nulls_first() for c in GOLD.fieldNames()]
    return transaccion_enriquecida(spark, sf_dir).orderBy(*order).limit(10)


# --- raw and landing layers -------------------------------------------------------------


def raw_delimited_roundtrip(spark, sf_dir):
    """A delivered file with a header, through the raw stage and back."""
    lake = _lake(spark, "raw")
    delivery = scratch_path(spark, "delivery")
    _deliver(roles.persona_dirty(spark, sf_dir), delivery)
    run_raw(lake, {"PERSONA": delivery}, [PERSONA])
    return lake.raw(PERSONA)


def raw_fact_roundtrip(spark, sf_dir):
    """The fact as delimited text and back, amounts as numbers."""
    path = scratch_path(spark, "raw-fact")
    write_raw(roles.transaccion(spark, sf_dir), path)
    return typed(read_raw(spark, path, TRANSACCION.raw), TRANSACCION)


def landing_roundtrip(spark, sf_dir):
    lake = _landed(spark, {"PERSONA": roles.persona_dirty(spark, sf_dir)}, [PERSONA])
    return lake.landing(PERSONA)


def landing_partitioned(spark, sf_dir):
    lake = _landed(spark, {"TRANSACCION": roles.transaccion_dirty(spark, sf_dir)}, [TRANSACCION])
    return lake.landing(TRANSACCION)


def landing_avro_roundtrip(spark, sf_dir):
    """``landing_partitioned`` in Avro container files."""
    facts = {"TRANSACCION": roles.transaccion_dirty(spark, sf_dir)}
    return _landed(spark, facts, [TRANSACCION], AVRO).landing(TRANSACCION)


def avro_fact_roundtrip(spark, sf_dir):
    """The typed fact, numbers included, in Avro container files of one folder."""
    path = scratch_path(spark, "avro-fact")
    write_layer(typed(roles.transaccion(spark, sf_dir), TRANSACCION), path, fmt=AVRO)
    return read_layer(spark, path, TRANSACCION.curated, fmt=AVRO)


def avro_partition_overwrite(spark, sf_dir):
    """``dynamic_partition_overwrite`` in Avro container files."""
    return _two_writes(spark, sf_dir, "incremental", AVRO)


def _lake(spark: SparkSession, purpose: str, landing_format: str = "parquet") -> Lake:
    return Lake(spark, scratch_path(spark, purpose), landing_format)


def _deliver(df: DataFrame, path: str) -> None:
    """Stand in for the upstream system: pipe text with a header."""
    write_raw(df, path, header=True, encoding=INPUT_ENCODING)


def _landed(
    spark: SparkSession, entities: dict[str, DataFrame], specs, landing_format: str = "parquet"
) -> Lake:
    lake = _lake(spark, "landing", landing_format)
    files = {name: scratch_path(spark, "delivery") for name in entities}
    for name, df in entities.items():
        _deliver(df, files[name])
    run_raw(lake, files, specs)
    run_landing(lake, specs)
    return lake


# --- partitioned writes -----------------------------------------------------------------


def _two_writes(
    spark: SparkSession, sf_dir: str, mode: str, fmt: str = "parquet"
) -> DataFrame:
    """Write every date, then the even days again with one unit more on each amount."""
    path = scratch_path(spark, mode)
    first = quality_transaccion(spark, sf_dir)
    second = first.where(F.dayofmonth(F.col("FECHA").cast("date")) % 2 == 0).withColumn(
        "MONTO", F.col("MONTO") + 1
    )
    write_layer(first, path, partition_by="FECHA", fmt=fmt)
    write_layer(second, path, partition_by="FECHA", mode=mode, fmt=fmt)
    return read_layer(spark, path, TRANSACCION.curated, fmt=fmt)


def dynamic_partition_overwrite(spark, sf_dir):
    return _two_writes(spark, sf_dir, "incremental")


def full_refresh(spark, sf_dir):
    return _two_writes(spark, sf_dir, "full")


def curated_write_read(spark, sf_dir):
    """Curated as a catalog table: create, insert by position, read."""
    database = _database(spark, "strata_curated_check")
    return _stored(
        quality_transaccion(spark, sf_dir), database, "transaccion", TRANSACCION.curated, "FECHA"
    )


def gold_partitioned_write(spark, sf_dir):
    """Gold as a catalog table partitioned by date."""
    database = _database(spark, "strata_functional_check")
    gold = enrich(*_event_entities(spark, sf_dir))
    return _stored(gold, database, "transaccion_enriquecida", GOLD, GOLD_PARTITION)


def catalog_dynamic_overwrite(spark, sf_dir):
    """``dynamic_partition_overwrite`` by inserts into a catalog table."""
    database = _database(spark, "strata_overwrite_check")
    first = quality_transaccion(spark, sf_dir)
    table = _stored(first, database, "transaccion", TRANSACCION.curated, "FECHA")
    second = first.where(F.dayofmonth(F.col("FECHA").cast("date")) % 2 == 0).withColumn(
        "MONTO", F.col("MONTO") + 1
    )
    catalog.insert_overwrite(second, f"{database}.transaccion", partition_by="FECHA")
    return table


def partition_distribution_query(spark, sf_dir):
    """Rows per date of gold, as counted and as the catalog lists them, and how many dates.

    Written by path, registered, repaired. One date has characters that folders escape, another
    is missing; a date that only one side knows would show.
    """
    database = _database(spark, "strata_partition_check")
    path = scratch_path(spark, "gold")
    day = F.dayofmonth(F.col(GOLD_PARTITION).cast("date"))
    odd = F.when(day == 3, F.replace(GOLD_PARTITION, F.lit("-"), F.lit("/"))).when(
        day != 5, F.col(GOLD_PARTITION)
    )
    gold = enrich(*_event_entities(spark, sf_dir)).withColumn(GOLD_PARTITION, odd)
    write_layer(gold, path, partition_by=GOLD_PARTITION)
    name = f"{database}.transaccion_enriquecida"
    catalog.create_table(spark, name, GOLD, path, partition_by=GOLD_PARTITION)
    catalog.register_partitions(spark, name)
    folder = F.regexp_extract("partition", "=(.*)$", 1)
    listed = catalog.table_partitions(spark, name).select(
        F.when(folder != DEFAULT_PARTITION, unescaped(folder)).alias("_listada"),
        F.lit(True).alias("listada"),
    )
    counted = partition_distribution(spark.table(name), GOLD_PARTITION)
    met = counted.join(listed, F.col("particion").eqNullSafe(F.col("_listada")), "full_outer")
    return met.select(
        F.coalesce("particion", "_listada").alias("particion"),
        F.coalesce("filas", F.lit(0)).alias("filas"),
        F.coalesce("listada", F.lit(False)).alias("listada"),
        F.lit(listed.count()).cast("bigint").alias("particiones"),
    )


def _database(spark: SparkSession, name: str) -> str:
    """A database that no other call uses, so that no earlier result changes."""
    own = f"{name}_{uuid.uuid4().hex}"
    return catalog.create_database(spark, own, scratch_path(spark, name))


def _stored(df, database, table, schema, partition_by=None) -> DataFrame:
    spark = df.sparkSession
    name = f"{database}.{table}"
    location = scratch_path(spark, table)
    catalog.create_table(spark, name, schema, location, partition_by=partition_by)
    catalog.insert_overwrite(df, name, partition_by=partition_by)
    return spark.table(name)


# --- audit and catalog ------------------------------------------------------------------


def audit_append(spark, sf_dir):
    """Two runs, each adding its report to the audit table."""
    path = scratch_path(spark, "audit")
    report = quality_report_query(spark, sf_dir)
    append_audit(audit_rows(report, FIRST_RUN), path)
    append_audit(audit_rows(report, SECOND_RUN), path)
    return read_layer(spark, path, AUDIT)


def audit_append_table(spark, sf_dir):
    """The same into a catalog table that the first run has to make."""
    table = f"{_database(spark, 'strata_audit_check')}.auditoria_calidad"
    location = scratch_path(spark, "audit")
    report = quality_report_query(spark, sf_dir)
    for executed_at in (FIRST_RUN, SECOND_RUN):
        catalog.append_or_create(audit_rows(report, executed_at), table, location)
    return spark.table(table)


def _curated_tables(spark: SparkSession, sf_dir: str, database: str) -> list[str]:
    for spec, df in _dirty(spark, sf_dir):
        _stored(
            apply_rules(df, spec), database, spec.name.lower(), spec.curated, spec.partition_by
        )
    return [spec.name.lower() for spec in ENTITIES]


def layer_tables_query(spark, sf_dir):
    """The tables the catalog lists for a layer, with their row counts."""
    database = _database(spark, "strata_listing_check")
    counts = None
    for name in _curated_tables(spark, sf_dir, database):
        counted = spark.table(f"{database}.{name}").agg(F.count("*").alias("filas"))
        counted = counted.select(F.lit(name).alias("tabla"), "filas")
        counts = counted if counts is None else counts.unionByName(counted)
    return catalog.layer_tables(spark, database).join(counts, "tabla", "left")


def storage_format_check(spark, sf_dir):
    """Declared format and codec of each table, whether its files agree, and its rows."""
    database = _database(spark, "strata_storage_check")
    out = None
    for name in _curated_tables(spark, sf_dir, database):
        table = f"{database}.{name}"
        detail = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
        catalog.assert_storage(spark, table, detail["data_type"])
        rows = spark.table(table).agg(F.lit(name).alias("tabla"), F.count("*").alias("filas"))
        row = catalog.storage_format(spark, table).join(rows, "tabla")
        out = row if out is None else out.unionByName(row)
    return out


# --- exports ----------------------------------------------------------------------------


def _gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold")
    write_layer(enrich(*_event_entities(spark, sf_dir)), path, partition_by=GOLD_PARTITION)
    return read_layer(spark, path, GOLD)


def csv_export_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    export_csv(_gold_layer(spark, sf_dir), path)
    return read_csv_export(spark, path, GOLD)


def csv_export_inferred(spark, sf_dir):
    """The export read back with inferred types: dates become DATE."""
    path = scratch_path(spark, "csv")
    export_csv(_gold_layer(spark, sf_dir), path)
    return read_csv_export(spark, f"{path}/part-*.csv", infer=True)


def csv_export_single(spark, sf_dir):
    """One file joined from parts that were written in parallel."""
    target = f"{scratch_path(spark, 'csv')}.csv"
    export_single_csv(_gold_layer(spark, sf_dir), scratch_path(spark, "csv-parts"), target)
    return read_csv_export(spark, target, GOLD)


def document_export_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "documents")
    export_documents(_gold_layer(spark, sf_dir), path)
    return read_documents(spark, path, GOLD)


def document_export_verify(spark, sf_dir):
    path = scratch_path(spark, "documents")
    gold = _gold_layer(spark, sf_dir)
    export_documents(gold, path)
    return verify_documents(gold, path)


# --- all stages -------------------------------------------------------------------------


def _all_stages(spark: SparkSession, sf_dir: str):
    lake = _lake(spark, "lake")
    sources = {
        "PERSONA": roles.persona(spark, sf_dir),
        "EMPRESA": roles.empresa(spark, sf_dir),
        "TRANSACCION": roles.transaccion_dirty(spark, sf_dir),
    }
    files = {name: scratch_path(spark, "delivery") for name in sources}
    for name, df in sources.items():
        _deliver(df, files[name])
    run_raw(lake, files)
    run_landing(lake)
    report = run_curated(lake, FIRST_RUN)
    return lake, report, run_functional(lake)


def stages_gold(spark, sf_dir):
    """Delivered files through every layer to gold."""
    return _all_stages(spark, sf_dir)[0].gold()


def stages_report(spark, sf_dir):
    return _all_stages(spark, sf_dir)[1]


def stages_integrity(spark, sf_dir):
    return _all_stages(spark, sf_dir)[2]


def stages_exports(spark, sf_dir):
    lake = _all_stages(spark, sf_dir)[0]
    return run_exports(
        lake, csv_path=scratch_path(spark, "csv"), document_path=scratch_path(spark, "documents")
    )


def layer_catalog(spark, sf_dir):
    """Every table of every layer as the catalog lists it, with its rows."""
    lake = _all_stages(spark, sf_dir)[0]
    listed = counted = None
    for database in register_layers(lake, f"strata_{uuid.uuid4().hex}"):
        layer = database.rpartition("_")[2]
        tables = catalog.layer_tables(spark, database).select(F.lit(layer).alias("capa"), "tabla")
        listed = tables if listed is None else listed.unionByName(tables)
        for row in tables.collect():
            count = spark.table(f"{database}.{row.tabla}").agg(F.count("*").alias("filas"))
            count = count.select(
                F.lit(layer).alias("capa"), F.lit(row.tabla).alias("tabla"), "filas"
            )
            counted = count if counted is None else counted.unionByName(count)
    return listed.join(counted, ["capa", "tabla"], "left")


def stages_metrics(spark, sf_dir):
    """Metrics of the steps of the functional stage, with gold's stored rows and partitions."""
    return _rounded(functional_metrics(_all_stages(spark, sf_dir)[0]))


def storage_report(spark, sf_dir):
    """Format, codec and rows of the tables of landing, curated and gold, and that files hold them."""
    report = storage_report_of(_all_stages(spark, sf_dir)[0])
    there = (F.col("archivos") > 0) & (F.col("bytes") > 0)
    return report.select("capa", "tabla", "formato", "compresion", "filas", there.alias("hay_archivos"))


def landing_declared(spark, sf_dir):
    """Persons landed under an Avro schema file that declares numbers."""
    lake = _lake(spark, "declared")
    delivery = scratch_path(spark, "delivery")
    _deliver(roles.persona_dirty(spark, sf_dir), delivery)
    run_raw(lake, {"PERSONA": delivery}, [PERSONA])
    kinds = {"EDAD": "int", "SALARIO": "double"}
    fields = [{"name": c, "type": ["string", "null"]} for c in PERSONA.columns]
    fields = [f | {"type": [kinds.get(f["name"], "string"), "null"]} for f in fields]
    schema = json.dumps({"type": "record", "name": "PERSONA", "fields": fields})
    file = scratch_path(spark, "persona-avsc")
    spark.createDataFrame([(schema,)], "value string").coalesce(1).write.text(file)
    run_landing(lake, [PERSONA], avsc={"PERSONA": file})
    return typed(lake.landing(PERSONA), PERSONA)


def incremental_rejects(spark, sf_dir):
    """Even days are corrected so that all their rows fail: gold and the check of both runs.

    The rows of gold after the second run, each beside the check that this run returned.
    """
    lake = _lake(spark, "rejects")
    delivered = roles.transaccion_dirty(spark, sf_dir)
    sources = {"PERSONA": roles.persona(spark, sf_dir), "EMPRESA": roles.empresa(spark, sf_dir)}
    even = F.dayofmonth(F.col("FECHA").cast("date")) % 2 == 0
    corrected = delivered.where(even).withColumn("MONTO", F.lit("-1"))
    for mode, fact in (("full", delivered), ("incremental", corrected)):
        files = {name: scratch_path(spark, "delivery") for name in (*sources, "TRANSACCION")}
        for name, df in {**sources, "TRANSACCION": fact}.items():
            _deliver(df, files[name])
        run_raw(lake, files)
        dates = None
        if mode == "incremental":
            dates = [r[0] for r in corrected.select("FECHA").distinct().collect()]
        run_landing(lake, mode=mode)
        run_curated(lake, FIRST_RUN, mode=mode, dates=dates)
        check = run_functional(lake, mode=mode, dates=dates)
    figures = check.first()
    return lake.gold().select(
        "*", *[F.lit(figures[c]).alias(c) for c in ("origen", "enriquecidas", "alerta")]
    )


def _redelivered(lake: Lake, sources: dict[str, DataFrame]) -> None:
    """A later delivery of some entities, as far as landing."""
    specs = [s for s in ENTITIES if s.name in sources]
    files = {name: scratch_path(lake.spark, "delivery") for name in sources}
    for name, df in sources.items():
        _deliver(df, files[name])
    run_raw(lake, files, specs)
    run_landing(lake, specs)


def _followed(spark: SparkSession, sf_dir: str) -> Lake:
    """The events as facts, landed whole and then run by what has changed."""
    lake = _lake(spark, "followed")
    _redelivered(
        lake,
        {
            "PERSONA": roles.persona(spark, sf_dir),
            "EMPRESA": roles.empresa(spark, sf_dir),
            "TRANSACCION": roles.transaccion_dirty(spark, sf_dir),
        },
    )
    run_changed(lake, FIRST_RUN)
    return lake


def dimension_change(spark, sf_dir):
    """Gold after both dimensions were delivered anew and no transaction was: as if made whole."""
    lake = _followed(spark, sf_dir)
    persona, empresa = roles.persona_changed(spark, sf_dir), roles.empresa_changed(spark, sf_dir)
    _redelivered(lake, {"PERSONA": persona, "EMPRESA": empresa})
    run_curated(lake, SECOND_RUN, [PERSONA, EMPRESA])
    run_functional(lake, mode="incremental", dates=[], follow_dimensions=True)
    return lake.gold()


def changed_dates(spark, sf_dir):
    """Gold after a delivery in which one date has other amounts and one is gone, each row beside
    the number of dates that were found changed."""
    lake = _followed(spark, sf_dir)
    day = F.dayofmonth(F.col("FECHA").cast("date"))
    again = roles.transaccion_dirty(spark, sf_dir).where(day != 5)
    again = again.withColumn("MONTO", F.when(day == 7, F.lit("1")).otherwise(F.col("MONTO")))
    _redelivered(lake, {"TRANSACCION": again})
    dates = run_changed(lake, SECOND_RUN)
    return lake.gold().withColumn("fechas", F.lit(len(dates)))


def quality_reasons_query(spark, sf_dir):
    """How many rows of each entity fail which rules."""
    return quality_reasons(_dirty(spark, sf_dir))


def rejected_rows(spark, sf_dir):
    """Rejected transactions with their reasons, beside the number of accepted ones: both were
    written in one pass and are read apart."""
    path = scratch_path(spark, "judged")
    write_judged(judged(roles.transaccion_dirty(spark, sf_dir), TRANSACCION), path, partition_by="FECHA")
    kept = read_judged(spark, path, TRANSACCION, ACCEPTED).agg(F.count("*").alias("aceptadas"))
    return read_judged(spark, path, TRANSACCION, REJECTED).join(F.broadcast(kept))


def document_export_content(spark, sf_dir):
    """What a damaged set of documents differs in: rows lost, doubled and changed, by their count.

    The undamaged set is exported first, which raises unless it holds what gold holds.
    """
    gold, keys = _gold_layer(spark, sf_dir), ["ID_PERSONA", GOLD_PARTITION]
    path = scratch_path(spark, "documents")
    export_checked(gold, path, keys)
    copy = read_documents(spark, path, GOLD)
    person = F.col("ID_PERSONA") % 97
    changed = copy.where(person.isNull() | (person != 0)).withColumn(
        "MONTO_TRANSACCION",
        F.when(person == 2, F.col("MONTO_TRANSACCION") + 1).otherwise(F.col("MONTO_TRANSACCION")),
    )
    damaged = scratch_path(spark, "damaged")
    export_documents(changed.unionByName(changed.where(person == 1)), damaged)
    return content_differences(gold, read_documents(spark, damaged, GOLD), keys).drop("cubo")


# --- time, summaries, streams -----------------------------------------------------------


def employer_as_of(spark, sf_dir):
    """Each transaction with its person's employer on that day; those before the first are marked."""
    fact = apply_rules(roles.transaccion_dirty(spark, sf_dir), TRANSACCION)
    day, history = F.col("FECHA").cast("date"), roles.employment(spark, sf_dir)
    history = history.withColumn("empleado_desde", F.col("desde"))
    found = as_of(
        fact,
        history,
        "ID_PERSONA",
        day,
        "ID",
        "desde",
        ["empleador", "empleado_desde"],
        unit="week",
        strategy="isolate",
    )
    return found.withColumn("antes_de_ingreso", F.col("empleado_desde").isNull())


def merged_metrics(spark, sf_dir):
    """Metrics by month from stored sketches by date; whether the estimates are as near to the
    exact figures as their stated errors say (three standard errors for distinct persons)."""
    gold, path = _gold_layer(spark, sf_dir), scratch_path(spark, "sketches")
    month = F.substring(GOLD_PARTITION, 1, 7).alias("mes")
    parts = sketches(gold, GOLD_PARTITION, "ID_PERSONA", "MONTO_TRANSACCION")
    write_layer(parts, path)
    metrics = merged(read_layer(spark, path, parts.schema), month)
    amount = F.col("MONTO_TRANSACCION")
    met = gold.select("ID_PERSONA", amount, month).join(F.broadcast(metrics), "mes")
    exact = met.groupBy("mes").agg(
        F.count_distinct("ID_PERSONA").alias("personas"),
        F.avg((amount < F.col("cuantil_50")).cast("int")).alias("bajo"),
        F.avg((amount <= F.col("cuantil_50")).cast("int")).alias("hasta"),
    )
    near = F.abs(F.col("distintos") - F.col("personas")) <= 3 * DISTINCT_ERROR * F.col("personas") + 1
    ranked = (F.col("bajo") <= 0.5 + RANK_ERROR) & (F.col("hasta") >= 0.5 - RANK_ERROR)
    return metrics.join(exact, "mes").select(
        "mes",
        "filas",
        F.round("promedio", 4).alias("promedio"),
        "minimo",
        "maximo",
        "personas",
        near.alias("personas_cerca"),
        ranked.alias("mediana_cerca"),
    )


def gold_cube(spark, sf_dir):
    """Metrics of every subset of date, merchant and employer, distinct persons among them."""
    keys = [GOLD_PARTITION, "EMPRESA_TRANSACCION", "TRABAJO_PERSONA"]
    cells = cube(enrich(*_event_entities(spark, sf_dir)), keys, "ID_PERSONA", "MONTO_TRANSACCION")
    # Amounts have two decimals, and so has their sum; an average is that of sums in any order.
    return cells.withColumn("suma", F.round("suma", 2)).drop("promedio")


def fair_sample_query(spark, sf_dir):
    """Five transactions of every date, those of least hash."""
    return fair_sample(roles.transaccion_dirty(spark, sf_dir), "FECHA", 5)


def landing_stream(spark, sf_dir):
    """The fact landed as a stream of files, in two runs of several batches."""
    lake, deliveries = _lake(spark, "stream"), scratch_path(spark, "deliveries")
    fact = roles.transaccion_dirty(spark, sf_dir)
    late = F.dayofmonth(F.col("FECHA").cast("date")) > 20
    for part, name in ((fact.where(~late), "a"), (fact.where(late), "b")):
        _deliver(part.repartition(4), f"{deliveries}/{name}")
        run_landing_stream(lake, TRANSACCION, f"{deliveries}/*", files_per_batch=3)
    return landed(lake, TRANSACCION).drop(BATCH)


REGISTERED: dict[str, Query] = {
    "transaccion_enriquecida": transaccion_enriquecida,
    "typed_persona": typed_persona,
    "typed_transaccion": typed_transaccion,
    "lenient_int_cast": lenient_int_cast,
    "lenient_int_cast_amounts": lenient_int_cast_amounts,
    "quality_persona": quality_persona,
    "quality_empresa": quality_empresa,
    "quality_transaccion": quality_transaccion,
    "quality_report": quality_report_query,
    "enrich_step1": enrich_step1,
    "enrich_step2": enrich_step2,
    "enrich_step3": enrich_step3,
    "broadcast_equals_shuffle": broadcast_equals_shuffle,
    "enrich_hot_keys": enrich_hot_keys,
    "enrich_repeated_keys": enrich_repeated_keys,
    "step_metrics": step_metrics_query,
    "final_metrics": final_metrics,
    "integrity_check": integrity_check_query,
    "integrity_by_date": integrity_by_date_query,
    "loss_alert": loss_alert_query,
    "match_report": match_report_query,
    "sample_rows": sample_rows,
    "raw_delimited_roundtrip": raw_delimited_roundtrip,
    "raw_fact_roundtrip": raw_fact_roundtrip,
    "landing_roundtrip": landing_roundtrip,
    "landing_partitioned": landing_partitioned,
    "landing_avro_roundtrip": landing_avro_roundtrip,
    "avro_fact_roundtrip": avro_fact_roundtrip,
    "avro_partition_overwrite": avro_partition_overwrite,
    "dynamic_partition_overwrite": dynamic_partition_overwrite,
    "full_refresh": full_refresh,
    "curated_write_read": curated_write_read,
    "gold_partitioned_write": gold_partitioned_write,
    "catalog_dynamic_overwrite": catalog_dynamic_overwrite,
    "partition_distribution": partition_distribution_query,
    "audit_append": audit_append,
    "audit_append_table": audit_append_table,
    "layer_tables": layer_tables_query,
    "storage_format_check": storage_format_check,
    "csv_export_roundtrip": csv_export_roundtrip,
    "csv_export_inferred": csv_export_inferred,
    "csv_export_single": csv_export_single,
    "document_export_roundtrip": document_export_roundtrip,
    "document_export_verify": document_export_verify,
    "stages_gold": stages_gold,
    "stages_report": stages_report,
    "stages_integrity": stages_integrity,
    "stages_exports": stages_exports,
    "layer_catalog": layer_catalog,
    "stages_metrics": stages_metrics,
    "storage_report": storage_report,
    "landing_declared": landing_declared,
    "incremental_rejects": incremental_rejects,
    "dimension_change": dimension_change,
    "changed_dates": changed_dates,
    "quality_reasons": quality_reasons_query,
    "rejected_rows": rejected_rows,
    "document_export_content": document_export_content,
    "employer_as_of": employer_as_of,
    "merged_metrics": merged_metrics,
    "gold_cube": gold_cube,
    "fair_sample": fair_sample_query,
    "landing_stream": landing_stream,
}
