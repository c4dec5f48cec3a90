"""The stages: raw, landing, curated, functional and exports.

Each stage reads the stored result of the one before, so a lost executor or a failed run
costs at most the current stage, and any stage can be run again with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.casts import lenient
from strata.operators.changes import changed_keys, differing, partition_digests, values_of
from strata.operators.checks import chain_metrics, integrity_check
from strata.operators.checks import integrity_by_date as check_by_date
from strata.operators.layout import lower_names
from strata.operators.quality import apply_rules, audit_rows, judged, stored_report
from strata.plans.enrichment import COMPANY_COLUMNS, PERSON_COLUMNS, enrich, small_dimensions
from strata.sinks.exports import export_csv, export_documents, require_rows, verify_documents
from strata.sinks.catalog import stored_files
from strata.sinks.layers import (
    append_audit,
    judged_path,
    stored_partitions,
    write_judged,
    write_layer,
    write_raw,
)
from strata.sources.avro import FORMAT as AVRO
from strata.sources.avsc import read_avsc
from strata.sources.delimited import read_delimited, read_raw
from strata.sources.layers import read_layer
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
    TableSpec,
    partition_last,
)

# Layer and table names.
RAW, LANDING, CURATED, FUNCTIONAL = LAYERS = ("workload", "landing", "curated", "functional")
GOLD_TABLE = "transaccion_enriquecida"
AUDIT_TABLE = "auditoria_calidad"
# What runs remember of each other.
CONTROL = "control"
# Labels of the enrichment steps.
STEPS = ("con_persona", "con_trabajo", "con_comercio")
_FOLLOWED = ((PERSONA, PERSON_COLUMNS), (EMPRESA, COMPANY_COLUMNS))


@dataclass(frozen=True)
class Lake:
    """Where the layers of one environment lie, below a root every executor can reach.

    ``landing_format`` is any format of the session, or the library's own source of Avro files.
    ``keep_rejected`` keeps the rows that the curated stage rejects, with their reasons, beside
    those it accepts.
    """

    spark: SparkSession
    root: str
    landing_format: str = "parquet"
    keep_rejected: bool = False

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table.lower()}"

    @property
    def audit_path(self) -> str:
        return self.path("auditoria", AUDIT_TABLE)

    def raw(self, spec: TableSpec) -> DataFrame:
        return read_raw(self.spark, self.path(RAW, spec.name), spec.raw)

    def landing(
        self, spec: TableSpec, dates: Sequence[str | None] | None = None
    ) -> DataFrame:
        """The landing layer, of all dates or only of some."""
        by = spec.partition_by and spec.partition_by.lower()
        how = {"fmt": self.landing_format, "partition_by": by, "only": dates}
        return read_layer(self.spark, self.path(LANDING, spec.name), spec.landing, **how)

    def curated(
        self, spec: TableSpec, dates: Sequence[str | None] | None = None
    ) -> DataFrame:
        how = {"partition_by": spec.partition_by, "only": dates}
        return read_layer(self.spark, self.curated_path(spec), spec.curated, **how)

    def rejected(
        self, spec: TableSpec, dates: Sequence[str | None] | None = None
    ) -> DataFrame:
        """Rejected rows, typed, with the names of the rules they fail (motivos)."""
        path = judged_path(self.path(CURATED, spec.name), REJECTED)
        names = partition_last(["motivos", *spec.columns], spec.partition_by)
        schema = StructType([*spec.curated, StructField("motivos", StringType())])
        how = {"partition_by": spec.partition_by, "only": dates}
        return read_layer(self.spark, path, schema, **how).select(*names)

    def curated_path(self, spec: TableSpec) -> str:
        path = self.path(CURATED, spec.name)
        return judged_path(path, ACCEPTED) if self.keep_rejected else path

    def gold(self, dates: Sequence[str | None] | None = None) -> DataFrame:
        how = {"partition_by": GOLD_PARTITION, "only": dates}
        return read_layer(self.spark, self.path(FUNCTIONAL, GOLD_TABLE), GOLD, **how)

    def audit(self) -> DataFrame:
        return read_layer(self.spark, self.audit_path, AUDIT)


def run_raw(lake: Lake, files: Mapping[str, str], specs: Sequence[TableSpec] = ENTITIES) -> None:
    """Delivered files (entity name -> path) to the raw layer, all text."""

    def load(spec: TableSpec) -> None:
        delivered = read_delimited(lake.spark, files[spec.name], spec.raw)
        write_raw(delivered, lake.path(RAW, spec.name))

    _together(lake, load, specs)


def run_landing(
    lake: Lake,
    specs: Sequence[TableSpec] = ENTITIES,
    *,
    mode: str = "full",
    avsc: Mapping[str, str] | None = None,
) -> None:
    """Raw to landing: lower-case names, partitioned where the entity says so.

    ``avsc`` (entity name -> path) holds Avro schema files as contracts: a file has to declare
    every column of the entity but the partition column, which comes on top, and text that is no
    value of the declared type becomes NULL; the layer itself stays text.
    """

    def land(spec: TableSpec) -> None:
        df = lake.raw(spec)
        if avsc and spec.name in avsc:
            df = as_declared(df, read_avsc(lake.spark, avsc[spec.name]), spec)
        write_layer(
            lower_names(df),
            lake.path(LANDING, spec.name),
            partition_by=spec.partition_by and spec.partition_by.lower(),
            mode=_entity_mode(spec, mode),
            fmt=lake.landing_format,
        )

    _together(lake, land, specs)


def as_declared(df: DataFrame, declared: StructType, spec: TableSpec) -> DataFrame:
    """``df`` with the columns that an Avro schema declares, in its order, as text of its types.

    A column of the entity that it leaves out, and one that the entity has not, are refused.
    """
    wanted = {c.lower() for c in spec.columns} - {(spec.partition_by or "").lower()}
    names = [f.name.lower() for f in declared if f.name.lower() != (spec.partition_by or "").lower()]
    if set(names) != wanted or len(set(names)) != len(names):
        raise ValueError(f"the schema of {spec.name} declares {sorted(names)}, not {sorted(wanted)}")
    own = {c.lower(): c for c in df.columns}
    kinds = {f.name.lower(): f.dataType for f in declared}
    columns = [lenient(F.col(own[n]), kinds[n]).cast("string").alias(own[n]) for n in names]
    return df.select(*columns, *([spec.partition_by] if spec.partition_by else []))


def run_curated(
    lake: Lake,
    executed_at: str,
    specs: Sequence[TableSpec] = ENTITIES,
    *,
    mode: str = "full",
    validate: bool = True,
    dates: Sequence[str | None] | None = None,
) -> DataFrame:
    """Landing to curated, then the quality report, which is also added to the audit table.

    Landing already lies partitioned as curated shall be, so no shuffle is needed. ``dates``
    limits an incremental run to those partitions, None for rows without a date, and no others
    are read or reported. An incremental run answers for all its dates, those of landing if none
    are given: a date whose rows are all rejected is left without rows.
    """
    _require_incremental(mode, dates)
    scopes = {s.name: _scope(lake.spark, lake.path(LANDING, s.name), s, mode, dates) for s in specs}

    def curate(spec: TableSpec) -> None:
        scope = scopes[spec.name]
        landing = lake.landing(spec, scope)
        if lake.keep_rejected and validate:
            write_judged(
                judged(landing, spec),
                lake.path(CURATED, spec.name),
                partition_by=spec.partition_by,
                mode=_entity_mode(spec, mode),
                scope=scope,
            )
            return
        write_layer(
            apply_rules(landing, spec, validate=validate),
            lake.curated_path(spec),
            partition_by=spec.partition_by,
            mode=_entity_mode(spec, mode),
            clustered=True,
            scope=scope,
        )

    _together(lake, curate, specs)
    report = stored_report(
        (s, lake.landing(s, scopes[s.name]), lake.curated(s, scopes[s.name])) for s in specs
    )
    append_audit(audit_rows(report, executed_at), lake.audit_path)
    return report


def run_functional(
    lake: Lake,
    *,
    strategy: str = "broadcast",
    mode: str = "full",
    dates: Sequence[str | None] | None = None,
    by_date: bool = False,
    follow_dimensions: bool = False,
) -> DataFrame:
    """Curated to gold, partitioned by date; returns the integrity check of what was stored.

    With dimensions that fit a broadcast the fact stays where its date partition lies, from
    the scan to the write, and the stage has no shuffle at all. ``dates`` limits an
    incremental run, and its check, to those partitions. As in ``run_curated`` each of them is
    replaced, even by nothing. ``by_date`` gives the check for each date.

    ``follow_dimensions`` keeps what gold was made from of both dimensions, and has an incremental
    run add the dates whose rows name a person or a company that has changed since. The other
    dates are not read. Without it they keep the names of their own run. Where nothing is known
    of an earlier run, all dates are made.
    """
    _require_incremental(mode, dates)
    if follow_dimensions and mode == "incremental":
        if dates is None:
            raise ValueError("name the dates of the delivery, or none, to follow dimensions")
        behind = dates_behind(lake)
        mode, dates = ("full", None) if behind is None else (mode, {*dates, *behind})
    persona, empresa = lake.curated(PERSONA), lake.curated(EMPRESA)
    path = lake.curated_path(TRANSACCION)
    scope = _scope(lake.spark, path, TRANSACCION, mode, dates)
    transaccion = lake.curated(TRANSACCION, scope)
    small = small_dimensions(persona, empresa) if strategy == "broadcast" else (False, False)
    gold = enrich(transaccion, persona, empresa, strategy, small)
    write_layer(
        gold,
        lake.path(FUNCTIONAL, GOLD_TABLE),
        partition_by=GOLD_PARTITION,
        mode=mode,
        clustered=all(small),
        scope=scope,
    )
    if follow_dimensions:
        for spec, columns in _FOLLOWED:
            used = lake.curated(spec).select(*columns)
            write_layer(used, lake.path(CONTROL, f"gold_{spec.name}"))
    check = check_by_date if by_date else integrity_check
    return check(transaccion, lake.gold(scope))


def dates_behind(lake: Lake) -> list[str | None] | None:
    """Dates of the curated fact whose gold was made from other persons or companies than now.

    None if no run has kept what it was made from. Snapshots are compared as bags of rows; a
    person also changes with the employer's name.
    """
    before = {}
    for spec, columns in _FOLLOWED:
        schema = StructType([spec.curated[c] for c in columns])
        path = lake.path(CONTROL, f"gold_{spec.name}")
        found = _if_stored(lake.spark, path, schema)
        if found is None:
            return None
        before[spec.name] = found
    fact, persons = lake.curated(TRANSACCION), lake.curated(PERSONA).select(*PERSON_COLUMNS)
    companies = lake.curated(EMPRESA).select(*COMPANY_COLUMNS)
    firms = changed_keys(before["EMPRESA"], companies, "ID")
    employed = values_of(persons, "ID_EMPRESA", firms, "ID", "ID").where("ID IS NOT NULL")
    people = changed_keys(before["PERSONA"], persons, "ID").unionByName(employed)
    date = TRANSACCION.partition_by
    found = values_of(fact, "ID_PERSONA", people, "ID", date).unionByName(
        values_of(fact, "ID_EMPRESA", firms, "ID", date)
    )
    return [r[0] for r in found.distinct().collect()]


def run_changed(lake: Lake, executed_at: str, strategy: str = "broadcast") -> list[str | None]:
    """Curated and functional for the dates whose landing has changed since the last such run.

    Landing's digest per date lies in the control folder; it is replaced last, so a run that
    failed is done again. Dates that landing has lost are emptied. Returns the changed dates;
    those that a changed dimension adds to gold are not among them.
    """
    spec = TRANSACCION
    by, path = spec.partition_by.lower(), lake.path(CONTROL, f"landing_{TRANSACCION.name}")
    now = partition_digests(lake.landing(spec), by)
    # Written apart, so that what is compared and what is kept are the same.
    write_layer(now, f"{path}_next")
    after = read_layer(lake.spark, f"{path}_next", now.schema)
    before = _if_stored(lake.spark, path, now.schema)
    if before is None:
        dates = [r[0] for r in after.select("particion").collect()]
        run_curated(lake, executed_at)
        run_functional(lake, strategy=strategy, follow_dimensions=True)
    else:
        dates = [r[0] for r in differing(before, after, "particion").select("particion").collect()]
        how = {"mode": "incremental", "dates": dates}
        run_curated(lake, executed_at, **how)
        run_functional(lake, strategy=strategy, follow_dimensions=True, **how)
    write_layer(after, path)
    return dates


def _if_stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    try:
        return read_layer(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def functional_metrics(lake: Lake, dates: Sequence[str | None] | None = None) -> DataFrame:
    """What a functional run did, from the stored layers: the metrics of each enrichment step,
    with the rows and the partitions that gold has (filas_gold, particiones_gold).

    The steps take one pass over the curated fact, gold's figures one over its partition column.
    """
    transaccion = lake.curated(TRANSACCION, dates)
    steps = chain_metrics(transaccion, lake.curated(PERSONA), lake.curated(EMPRESA), STEPS)
    gold = lake.gold(dates)
    per_date = gold.groupBy(GOLD_PARTITION).agg(F.count("*").alias("n"))
    figures = per_date.agg(F.sum("n").alias("rows"), F.count("*").alias("dates")).first()
    return steps.select(
        "*",
        F.lit(figures["rows"] or 0).cast("bigint").alias("filas_gold"),
        F.lit(figures["dates"]).cast("bigint").alias("particiones_gold"),
    )


def storage_report(lake: Lake) -> DataFrame:
    """Format, codec, files, bytes and rows of each table of landing, curated and gold."""
    tables = [(LANDING, s.name, lake.landing_format, lake.landing(s)) for s in ENTITIES]
    tables += [(CURATED, s.name, "parquet", lake.curated(s)) for s in ENTITIES]
    tables.append((FUNCTIONAL, GOLD_TABLE, "parquet", lake.gold()))
    out = None
    for layer, name, fmt, stored in tables:
        ending = "avro" if fmt == AVRO else fmt
        place = lake.path(layer, name)
        if layer == CURATED:
            place = lake.curated_path(next(s for s in ENTITIES if s.name == name))
        files = stored_files(lake.spark, place, ending).agg(
            F.lit(layer).alias("capa"),
            F.lit(name.lower()).alias("tabla"),
            F.lit(fmt).alias("formato"),
            F.array_join(F.array_sort(F.collect_set("codec")), ",").alias("compresion"),
            F.coalesce(F.sum("archivos"), F.lit(0)).alias("archivos"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        )
        rows = stored.agg(
            F.lit(layer).alias("capa"),
            F.lit(name.lower()).alias("tabla"),
            F.count("*").alias("filas"),
        )
        row = files.join(rows, ["capa", "tabla"])
        out = row if out is None else out.unionByName(row)
    return out


def run_exports(
    lake: Lake,
    *,
    csv_path: str,
    document_path: str | None,
    document_format: str = "json",
    document_options: dict[str, str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Gold to CSV and to documents; returns the read-back check of the documents.

    Both come from the stored gold layer: documents keep its types.
    """
    gold = lake.gold()
    require_rows(gold)
    export_csv(gold, csv_path, parts=parts)
    target = {"fmt": document_format, "options": document_options}
    export_documents(gold, document_path, **target)
    return verify_documents(gold, document_path, **target)


def _entity_mode(spec: TableSpec, mode: str) -> str:
    """Dimensions are whole in every delivery, so only partitioned entities grow piecewise."""
    return mode if spec.partition_by else "full"


def _require_incremental(mode: str, dates: Sequence[str | None] | None) -> None:
    if dates is not None and mode != "incremental":
        raise ValueError("a full run takes all dates")


def _scope(
    spark: SparkSession,
    source: str,
    spec: TableSpec,
    mode: str,
    dates: Sequence[str | None] | None,
) -> list[str | None] | None:
    """The dates an incremental run answers for; None where it takes the entity as a whole."""
    if spec.partition_by is None or mode != "incremental":
        return None
    return stored_partitions(spark, source, spec.partition_by) if dates is None else list(dates)


def _together(lake: Lake, job: Callable[[TableSpec], None], specs: Sequence[TableSpec]) -> None:
    """Run one job per entity at the same time: the small ones fill what the large one leaves."""
    inherit = inheritable_thread_target(lake.spark)
    with ThreadPoolExecutor(len(specs)) as pool:
        for running in [pool.submit(inherit(job), spec) for spec in specs]:
            running.result()
