"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from strata.plans.registered import FIRST_RUN, SECOND_RUN, STAGES

# --- entities, as text and as accepted rows ---------------------------------------------

_PERSON_TEXT = """
    CAST(c_custkey AS VARCHAR) AS ID,
    c_name AS NOMBRE,
    lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS TELEFONO,
    lower(c_mktsegment) || '@example.org' AS CORREO,
    strftime(DATE '2000-01-01' + CAST(c_custkey % 3650 AS INTEGER), '%Y-%m-%d') AS FECHA_INGRESO"""

_PERSONA = f"""per_text AS (
  SELECT {_PERSON_TEXT},
    CAST(c_custkey % 100 AS VARCHAR) AS EDAD,
    CAST(c_acctbal AS VARCHAR) AS SALARIO,
    CAST(c_nationkey AS VARCHAR) AS ID_EMPRESA
  FROM customer)"""

_PERSONA_DIRTY = f"""per_text AS (
  SELECT {_PERSON_TEXT},
    CASE c_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN '32.7' WHEN 2 THEN 'abc' WHEN 3 THEN NULL
      WHEN 4 THEN ' 41 ' WHEN 5 THEN '100' WHEN 6 THEN '0'
      ELSE CAST(18 + c_custkey % 53 AS VARCHAR) END AS EDAD,
    CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS SALARIO,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS ID_EMPRESA
  FROM customer)"""

# The engine's own cast to INTEGER rounds, so the decimals are cut off first.
_PERSONA_TYPED = """per_typed AS (
  SELECT ID, NOMBRE, TELEFONO, CORREO, FECHA_INGRESO,
    TRY_CAST(trunc(TRY_CAST(trim(EDAD) AS DOUBLE)) AS INTEGER) AS EDAD,
    TRY_CAST(SALARIO AS DOUBLE) AS SALARIO,
    ID_EMPRESA
  FROM per_text)"""

_PERSONA_ACCEPTED = """per AS (
  SELECT * FROM per_typed
  WHERE ID IS NOT NULL AND ID_EMPRESA IS NOT NULL
    AND EDAD BETWEEN 1 AND 99 AND SALARIO BETWEEN 0.01 AND 9999999.99)"""

_EMPRESA = """emp AS (
  SELECT CASE WHEN n_regionkey = 0 THEN 'X' ELSE '' END || CAST(n_nationkey AS VARCHAR) AS ID,
    n_name AS NOMBRE
  FROM nation)"""

_EMPRESA_DIRTY = """emp_text AS (
  SELECT CASE WHEN s_suppkey % 7 = 3 THEN NULL ELSE CAST(s_suppkey AS VARCHAR) END AS ID,
    s_name AS NOMBRE
  FROM supplier),
emp AS (SELECT * FROM emp_text WHERE ID IS NOT NULL)"""

_EMPRESA_REPEATED = """emp AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS ID, s_name AS NOMBRE FROM supplier)"""

_TRANSACCION = """tr_typed AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ID_PERSONA, CAST(s_nationkey AS VARCHAR) AS ID_EMPRESA,
    l_extendedprice AS MONTO, strftime(o_orderdate, '%Y-%m-%d') AS FECHA
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)"""

_TRANSACCION_DIRTY = """tr_text AS (
  SELECT CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS ID_PERSONA,
    CAST(event_id % 30 AS VARCHAR) AS ID_EMPRESA,
    CASE WHEN event_type = 'error' THEN 'err'
      WHEN event_id % 17 = 0 THEN '-' || CAST(value AS VARCHAR)
      ELSE CAST(value AS VARCHAR) END AS MONTO,
    strftime(ts, '%Y-%m-%d') AS FECHA
  FROM events),
tr_typed AS (
  SELECT ID_PERSONA, ID_EMPRESA, TRY_CAST(MONTO AS DOUBLE) AS MONTO, FECHA FROM tr_text)"""

_TRANSACCION_ACCEPTED = """tr AS (
  SELECT * FROM tr_typed
  WHERE ID_PERSONA IS NOT NULL AND ID_EMPRESA IS NOT NULL AND MONTO >= 0)"""

_STEP1 = """s1 AS (
  SELECT TRY_CAST(tr.ID_PERSONA AS INTEGER) AS ID_PERSONA, per.NOMBRE AS NOMBRE_PERSONA,
    per.EDAD AS EDAD_PERSONA, per.SALARIO AS SALARIO_PERSONA,
    per.ID_EMPRESA AS ID_EMPRESA_PERSONA, tr.MONTO AS MONTO_TRANSACCION,
    tr.FECHA AS FECHA_TRANSACCION, tr.ID_EMPRESA AS ID_EMPRESA_TRANSACCION
  FROM tr JOIN per ON tr.ID_PERSONA = per.ID)"""

_STEP2 = """s2 AS (
  SELECT s1.* EXCLUDE (ID_EMPRESA_PERSONA), emp.NOMBRE AS TRABAJO_PERSONA
  FROM s1 LEFT JOIN emp ON s1.ID_EMPRESA_PERSONA = emp.ID)"""

_STEP3 = """s3 AS (
  SELECT s2.* EXCLUDE (ID_EMPRESA_TRANSACCION), emp.NOMBRE AS EMPRESA_TRANSACCION
  FROM s2 LEFT JOIN emp ON s2.ID_EMPRESA_TRANSACCION = emp.ID)"""

_PER = (_PERSONA, _PERSONA_TYPED, _PERSONA_ACCEPTED)
_TR = (_TRANSACCION, _TRANSACCION_ACCEPTED)
_STEPS = (_STEP1, _STEP2, _STEP3)
_FLAGSHIP = (*_PER, _EMPRESA, *_TR, *_STEPS)
_REPEATED = (*_PER, _EMPRESA_REPEATED, *_TR, *_STEPS)
_EVENTS = (*_PER, _EMPRESA, _TRANSACCION_DIRTY, _TRANSACCION_ACCEPTED, *_STEPS)
_DIRTY = (
    _PERSONA_DIRTY,
    _PERSONA_TYPED,
    _PERSONA_ACCEPTED,
    _EMPRESA_DIRTY,
    _TRANSACCION_DIRTY,
    _TRANSACCION_ACCEPTED,
)


def _with(ctes: tuple[str, ...], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# --- results ----------------------------------------------------------------------------


def _metrics(step: str, stage: str) -> str:
    return (
        f"SELECT '{stage}' AS etapa, count(*) AS total_registros, "
        "round(avg(MONTO_TRANSACCION), 4) AS monto_promedio, "
        f"min(MONTO_TRANSACCION) AS monto_min, max(MONTO_TRANSACCION) AS monto_max FROM {step}"
    )


_ALL_METRICS = " UNION ALL ".join(
    _metrics(step, stage) for step, stage in zip(("s1", "s2", "s3"), STAGES, strict=True)
)

_COUNTS = """(SELECT count(*) FROM tr) AS origen, count(*) AS enriquecidas,
  count(CASE WHEN NOMBRE_PERSONA IS NULL THEN 1 END) AS nulos_nombre,
  count(CASE WHEN TRABAJO_PERSONA IS NULL THEN 1 END) AS nulos_trabajo,
  count(CASE WHEN EMPRESA_TRANSACCION IS NULL THEN 1 END) AS nulos_empresa"""

_ALERT = "enriquecidas < origen * CAST(0.95 AS DOUBLE) AS alerta"

_INTEGRITY = f"SELECT *, {_ALERT} FROM (SELECT {_COUNTS} FROM s3)"

_LOSS = f"""SELECT origen, enriquecidas,
  (1 - CAST(enriquecidas AS DOUBLE) / origen) * 100 AS perdida_pct, {_ALERT}
FROM (SELECT {_COUNTS} FROM s3)"""

_MATCH = """SELECT (SELECT count(*) FROM tr) AS origen,
  (SELECT count(*) FROM tr WHERE ID_PERSONA NOT IN (SELECT ID FROM per)) AS sin_persona,
  (SELECT count(*) FROM s1) -
    (SELECT count(*) FROM tr WHERE ID_PERSONA IN (SELECT ID FROM per)) AS repetidas_persona,
  (SELECT count(*) FROM s3) - (SELECT count(*) FROM s1) AS repetidas_empresa"""

_SAMPLE = """SELECT * FROM s3 ORDER BY
  ID_PERSONA NULLS FIRST, NOMBRE_PERSONA NULLS FIRST, EDAD_PERSONA NULLS FIRST,
  SALARIO_PERSONA NULLS FIRST, TRABAJO_PERSONA NULLS FIRST, MONTO_TRANSACCION NULLS FIRST,
  EMPRESA_TRANSACCION NULLS FIRST, FECHA_TRANSACCION NULLS FIRST
LIMIT 10"""


def _report_row(name: str, source: str, kept: str) -> str:
    return (
        f"SELECT '{name}' AS tabla, (SELECT count(*) FROM {source}) AS origen, "
        f"(SELECT count(*) FROM {kept}) AS curated"
    )


def _report(empresa_source: str) -> str:
    rows = " UNION ALL ".join(
        [
            _report_row("PERSONA", "per_text", "per"),
            _report_row("EMPRESA", empresa_source, "emp"),
            _report_row("TRANSACCION", "tr_text", "tr"),
        ]
    )
    return (
        "SELECT tabla, origen, curated, origen - curated AS rechazados, "
        "CASE WHEN origen > 0 THEN CAST(curated AS DOUBLE) / origen * 100 ELSE 100.0 END "
        f"AS calidad_pct FROM ({rows})"
    )


_AUDIT = (
    f"SELECT calidad_pct, curated, origen, tabla, ejecucion FROM ({_report('emp_text')}) "
    f"CROSS JOIN (VALUES ('{FIRST_RUN}'), ('{SECOND_RUN}')) AS runs(ejecucion)"
)

_EVEN_DAY = "day(CAST(FECHA AS DATE)) % 2 = 0"

_SECOND_WRITE = f"""SELECT ID_PERSONA, ID_EMPRESA,
  CASE WHEN {_EVEN_DAY} THEN MONTO + 1 ELSE MONTO END AS MONTO, FECHA FROM tr"""

_TABLE_COUNTS = """SELECT 'persona' AS tabla, count(*) AS filas FROM per
UNION ALL SELECT 'empresa', count(*) FROM emp
UNION ALL SELECT 'transaccion', count(*) FROM tr"""

_ALL_TABLES = " UNION ALL ".join(
    f"SELECT '{layer}' AS capa, '{table}' AS tabla, count(*) AS filas FROM {source}"
    for layer, table, source in (
        ("workload", "persona", "per_text"),
        ("workload", "empresa", "emp"),
        ("workload", "transaccion", "tr_text"),
        ("landing", "persona", "per_text"),
        ("landing", "empresa", "emp"),
        ("landing", "transaccion", "tr_text"),
        ("curated", "persona", "per"),
        ("curated", "empresa", "emp"),
        ("curated", "transaccion", "tr"),
        ("curated", "auditoria_calidad", "(VALUES (1), (2), (3))"),
        ("functional", "transaccion_enriquecida", "s3"),
    )
)

_STORAGE = (
    f"SELECT *, 'parquet' AS formato, 'snappy' AS compresion FROM ({_TABLE_COUNTS})"
)

_STORED_TABLES = (
    f"SELECT *, 'parquet' AS formato, 'snappy' AS compresion, filas > 0 AS hay_archivos "
    f"FROM ({_ALL_TABLES}) WHERE capa <> 'workload' AND tabla <> 'auditoria_calidad'"
)

_BY_DATE = f"""SELECT *, {_ALERT} FROM (
  SELECT fecha, CAST(sum(o) AS BIGINT) AS origen, CAST(sum(e) AS BIGINT) AS enriquecidas,
    CAST(sum(n) AS BIGINT) AS nulos_nombre, CAST(sum(t) AS BIGINT) AS nulos_trabajo,
    CAST(sum(m) AS BIGINT) AS nulos_empresa
  FROM (
    SELECT FECHA AS fecha, 1 AS o, 0 AS e, 0 AS n, 0 AS t, 0 AS m FROM tr
    UNION ALL SELECT FECHA_TRANSACCION, 0, 1, CAST(NOMBRE_PERSONA IS NULL AS INTEGER),
      CAST(TRABAJO_PERSONA IS NULL AS INTEGER), CAST(EMPRESA_TRANSACCION IS NULL AS INTEGER) FROM s3)
  GROUP BY fecha)"""

_PARTITIONS = """SELECT CASE day(CAST(FECHA_TRANSACCION AS DATE)) WHEN 5 THEN NULL
    WHEN 3 THEN replace(FECHA_TRANSACCION, '-', '/') ELSE FECHA_TRANSACCION END AS particion,
  count(*) AS filas, TRUE AS listada, count(*) OVER () AS particiones
FROM s3 GROUP BY 1"""

_STAGE_METRICS = f"""SELECT *, (SELECT count(*) FROM s3) AS filas_gold,
  (SELECT count(DISTINCT FECHA_TRANSACCION) FROM s3) AS particiones_gold FROM ({_ALL_METRICS})"""

_REJECTS = f"""SELECT s3.*, c.* FROM (
    SELECT * FROM s3 WHERE NOT day(CAST(FECHA_TRANSACCION AS DATE)) % 2 = 0) s3
  CROSS JOIN (SELECT CAST(0 AS BIGINT) AS origen, CAST(0 AS BIGINT) AS enriquecidas,
    FALSE AS alerta) c"""

_LOWER_PERSONA = """SELECT ID AS id, NOMBRE AS nombre, TELEFONO AS telefono, CORREO AS correo,
  FECHA_INGRESO AS fecha_ingreso, EDAD AS edad, SALARIO AS salario, ID_EMPRESA AS id_empresa
FROM per_text"""

_LOWER_TRANSACCION = """SELECT ID_PERSONA AS id_persona, ID_EMPRESA AS id_empresa,
  MONTO AS monto, FECHA AS fecha FROM tr_text"""

# CSV keeps neither empty text nor outer blanks.
_CSV = """SELECT ID_PERSONA, nullif(trim(NOMBRE_PERSONA), '') AS NOMBRE_PERSONA, EDAD_PERSONA,
  SALARIO_PERSONA, nullif(trim(TRABAJO_PERSONA), '') AS TRABAJO_PERSONA, MONTO_TRANSACCION,
  nullif(trim(EMPRESA_TRANSACCION), '') AS EMPRESA_TRANSACCION, {date} AS FECHA_TRANSACCION
FROM s3"""

_VERIFY = """SELECT 'json' AS formato, count(*) AS origen, count(*) AS leidos, TRUE AS coincide
FROM s3"""

_BOTH_STRATEGIES = (
    "SELECT * FROM s3 CROSS JOIN (VALUES ('broadcast'), ('shuffle')) AS t(estrategia)"
)

_GOLD = "SELECT * FROM s3"
_PERSON_CTES = (_PERSONA_DIRTY, _PERSONA_TYPED, _PERSONA_ACCEPTED)
_EVENT_CTES = (_TRANSACCION_DIRTY, _TRANSACCION_ACCEPTED)
_STAGE_CTES = (*_PER, _EMPRESA, _TRANSACCION_DIRTY, _TRANSACCION_ACCEPTED)

_PERSONA_CHANGED = _PERSONA.replace("per_text AS", "per_first AS") + """,
per_text AS (
  SELECT * REPLACE (
    CASE WHEN CAST(ID AS BIGINT) % 7 = 3 THEN NOMBRE || ' II' ELSE NOMBRE END AS NOMBRE,
    CASE WHEN CAST(ID AS BIGINT) % 13 = 2 THEN '6' ELSE ID_EMPRESA END AS ID_EMPRESA)
  FROM per_first WHERE CAST(ID AS BIGINT) % 11 <> 5)"""
_EMPRESA_CHANGED = _EMPRESA.replace("emp AS", "emp_first AS") + """,
emp AS (
  SELECT CASE WHEN ID = '9' THEN 'Y9' ELSE ID END AS ID,
    CASE WHEN ID = '7' THEN NOMBRE || ' SA' ELSE NOMBRE END AS NOMBRE
  FROM emp_first)"""
_CHANGED = (
    _PERSONA_CHANGED,
    _PERSONA_TYPED,
    _PERSONA_ACCEPTED,
    _EMPRESA_CHANGED,
    _TRANSACCION_DIRTY,
    _TRANSACCION_ACCEPTED,
    *_STEPS,
)

# A date's amounts are set to 1 before the rules see them, so what was rejected for them passes.
_AGAIN = """tr AS (
  SELECT ID_PERSONA, ID_EMPRESA, CASE WHEN day(CAST(FECHA AS DATE)) = 7 THEN 1 ELSE MONTO END AS MONTO,
    FECHA
  FROM tr_typed
  WHERE ID_PERSONA IS NOT NULL AND ID_EMPRESA IS NOT NULL AND day(CAST(FECHA AS DATE)) <> 5
    AND (MONTO >= 0 OR day(CAST(FECHA AS DATE)) = 7))"""
_AGAIN_CTES = (*_PER, _EMPRESA, _TRANSACCION_DIRTY, _AGAIN, *_STEPS)
_CHANGED_DATES = """SELECT *, (SELECT CAST(count(DISTINCT FECHA) AS INTEGER) FROM tr_text
  WHERE day(CAST(FECHA AS DATE)) IN (5, 7)) AS fechas FROM s3"""


def _motives(rules: dict[str, str]) -> str:
    names = ", ".join(
        f"CASE WHEN NOT coalesce({rule}, FALSE) THEN '{name}' END" for name, rule in rules.items()
    )
    return f"nullif(concat_ws(',', {names}), '')"


_PERSON_RULES = {
    "id_present": "ID IS NOT NULL",
    "employer_present": "ID_EMPRESA IS NOT NULL",
    "age_in_range": "EDAD BETWEEN 1 AND 99",
    "salary_in_range": "SALARIO BETWEEN 0.01 AND 9999999.99",
}
_COMPANY_RULES = {"id_present": "ID IS NOT NULL"}
_FACT_RULES = {
    "person_present": "ID_PERSONA IS NOT NULL",
    "company_present": "ID_EMPRESA IS NOT NULL",
    "amount_not_negative": "MONTO >= 0",
}
_REASONS = " UNION ALL ".join(
    f"SELECT '{name}' AS tabla, {_motives(rules)} AS motivos, count(*) AS filas "
    f"FROM {table} GROUP BY ALL"
    for name, rules, table in (
        ("PERSONA", _PERSON_RULES, "per_typed"),
        ("EMPRESA", _COMPANY_RULES, "emp_text"),
        ("TRANSACCION", _FACT_RULES, "tr_typed"),
    )
)
_REJECTED = f"""SELECT *, {_motives(_FACT_RULES)} AS motivos, (SELECT count(*) FROM tr) AS aceptadas
FROM tr_typed WHERE {_motives(_FACT_RULES)} IS NOT NULL"""

_DAMAGE = """damaged AS (
  SELECT * EXCLUDE (i) REPLACE (MONTO_TRANSACCION +
    CASE WHEN ID_PERSONA % 97 = 2 THEN 1 ELSE 0 END AS MONTO_TRANSACCION)
  FROM s3, range(2) AS copies(i)
  WHERE (ID_PERSONA IS NULL OR ID_PERSONA % 97 <> 0) AND (i = 0 OR ID_PERSONA % 97 = 1))"""
_DIFFERENCES = """SELECT * EXCLUDE (sign), CAST(sum(sign) AS BIGINT) AS veces FROM (
  SELECT *, -1 AS sign FROM s3 UNION ALL BY NAME SELECT *, 1 AS sign FROM damaged)
GROUP BY ALL HAVING sum(sign) <> 0"""

_EMPLOYMENT = """history AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ID,
    DATE '2023-12-29' + CAST(c_custkey % 15 AS INTEGER) + [0, 8, 20][i] AS empleado_desde,
    CASE WHEN i = 3 AND c_custkey % 4 = 0 THEN NULL
      ELSE CAST((c_nationkey + i - 1) % 25 AS VARCHAR) END AS empleador
  FROM customer, range(1, 4) AS states(i))"""
_AS_OF = """SELECT tr.*, empleador, empleado_desde, empleado_desde IS NULL AS antes_de_ingreso
FROM tr ASOF LEFT JOIN history ON tr.ID_PERSONA = history.ID
  AND CAST(tr.FECHA AS DATE) >= history.empleado_desde"""

_MERGED = """SELECT substr(FECHA_TRANSACCION, 1, 7) AS mes, count(*) AS filas,
  round(avg(MONTO_TRANSACCION), 4) AS promedio, min(MONTO_TRANSACCION) AS minimo,
  max(MONTO_TRANSACCION) AS maximo, count(DISTINCT ID_PERSONA) AS personas,
  TRUE AS personas_cerca, TRUE AS mediana_cerca
FROM s3 GROUP BY 1"""

_CUBE = """SELECT FECHA_TRANSACCION, EMPRESA_TRANSACCION, TRABAJO_PERSONA,
  CAST(GROUPING(FECHA_TRANSACCION, EMPRESA_TRANSACCION, TRABAJO_PERSONA) AS INTEGER) AS nivel,
  count(*) AS filas, count(MONTO_TRANSACCION) AS importes,
  round(sum(MONTO_TRANSACCION), 2) AS suma,
  min(MONTO_TRANSACCION) AS minimo, max(MONTO_TRANSACCION) AS maximo,
  count(DISTINCT ID_PERSONA) AS distintos
FROM s3 GROUP BY CUBE (FECHA_TRANSACCION, EMPRESA_TRANSACCION, TRABAJO_PERSONA)"""

_HASHED = " || ".join(
    f"coalesce(length({c}) || ':' || {c}, '-')" for c in ("ID_PERSONA", "ID_EMPRESA", "MONTO", "FECHA")
)
_FAIR = f"""SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY FECHA ORDER BY md5({_HASHED})) AS place FROM tr_text)
WHERE place <= 5"""

ORACLES: dict[str, str] = {
    "transaccion_enriquecida": _with(_FLAGSHIP, _GOLD),
    "typed_persona": _with(_PERSON_CTES, "SELECT * FROM per_typed"),
    "typed_transaccion": _with(_EVENT_CTES, "SELECT * FROM tr_typed"),
    "lenient_int_cast": _with(
        _PERSON_CTES,
        "SELECT ID, per_text.EDAD, per_typed.EDAD AS EDAD_INT FROM per_text JOIN per_typed USING (ID)",
    ),
    "lenient_int_cast_amounts": (
        "SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS monto_int "
        "FROM lineitem"
    ),
    "quality_persona": _with(_PERSON_CTES, "SELECT * FROM per"),
    "quality_empresa": _with((_EMPRESA_DIRTY,), "SELECT * FROM emp"),
    "quality_transaccion": _with(_EVENT_CTES, "SELECT * FROM tr"),
    "quality_report": _with(_DIRTY, _report("emp_text")),
    "enrich_step1": _with(_FLAGSHIP, "SELECT * FROM s1"),
    "enrich_step2": _with(_FLAGSHIP, "SELECT * FROM s2"),
    "enrich_step3": _with(_FLAGSHIP, _GOLD),
    "broadcast_equals_shuffle": _with(_FLAGSHIP, _BOTH_STRATEGIES),
    "enrich_hot_keys": _with(_FLAGSHIP, _GOLD),
    "enrich_repeated_keys": _with(_REPEATED, _ALL_METRICS),
    "step_metrics": _with(_FLAGSHIP, _ALL_METRICS),
    "final_metrics": _with(_FLAGSHIP, _metrics("s3", STAGES[-1])),
    "integrity_check": _with(_FLAGSHIP, _INTEGRITY),
    "integrity_by_date": _with(_EVENTS, _BY_DATE),
    "loss_alert": _with(_FLAGSHIP, _LOSS),
    "match_report": _with(_REPEATED, _MATCH),
    "sample_rows": _with(_FLAGSHIP, _SAMPLE),
    "raw_delimited_roundtrip": _with(_PERSON_CTES, "SELECT * FROM per_text"),
    "raw_fact_roundtrip": _with(_TR, "SELECT * FROM tr_typed"),
    "landing_roundtrip": _with(_PERSON_CTES, _LOWER_PERSONA),
    "landing_partitioned": _with(_EVENT_CTES, _LOWER_TRANSACCION),
    "landing_avro_roundtrip": _with(_EVENT_CTES, _LOWER_TRANSACCION),
    "avro_fact_roundtrip": _with(_TR, "SELECT * FROM tr_typed"),
    "avro_partition_overwrite": _with(_EVENT_CTES, _SECOND_WRITE),
    "dynamic_partition_overwrite": _with(_EVENT_CTES, _SECOND_WRITE),
    "full_refresh": _with(_EVENT_CTES, f"{_SECOND_WRITE} WHERE {_EVEN_DAY}"),
    "curated_write_read": _with(_EVENT_CTES, "SELECT * FROM tr"),
    "gold_partitioned_write": _with(_EVENTS, _GOLD),
    "catalog_dynamic_overwrite": _with(_EVENT_CTES, _SECOND_WRITE),
    "partition_distribution": _with(_EVENTS, _PARTITIONS),
    "audit_append": _with(_DIRTY, _AUDIT),
    "audit_append_table": _with(_DIRTY, _AUDIT),
    "layer_tables": _with(_DIRTY, _TABLE_COUNTS),
    "storage_format_check": _with(_DIRTY, _STORAGE),
    "csv_export_roundtrip": _with(_EVENTS, _CSV.format(date="FECHA_TRANSACCION")),
    "csv_export_inferred": _with(_EVENTS, _CSV.format(date="CAST(FECHA_TRANSACCION AS DATE)")),
    "csv_export_single": _with(_EVENTS, _CSV.format(date="FECHA_TRANSACCION")),
    "document_export_roundtrip": _with(_EVENTS, _GOLD),
    "document_export_verify": _with(_EVENTS, _VERIFY),
    "stages_gold": _with(_EVENTS, _GOLD),
    "stages_report": _with(_STAGE_CTES, _report("emp")),
    "stages_integrity": _with(_EVENTS, _INTEGRITY),
    "stages_exports": _with(_EVENTS, _VERIFY),
    "layer_catalog": _with(_EVENTS, _ALL_TABLES),
    "stages_metrics": _with(_EVENTS, _STAGE_METRICS),
    "storage_report": _with(_EVENTS, _STORED_TABLES),
    "landing_declared": _with(_PERSON_CTES, "SELECT * FROM per_typed"),
    "incremental_rejects": _with(_EVENTS, _REJECTS),
    "dimension_change": _with(_CHANGED, _GOLD),
    "changed_dates": _with(_AGAIN_CTES, _CHANGED_DATES),
    "quality_reasons": _with(_DIRTY, _REASONS),
    "rejected_rows": _with(_EVENT_CTES, _REJECTED),
    "employer_as_of": _with((*_EVENT_CTES, _EMPLOYMENT), _AS_OF),
    "merged_metrics": _with(_EVENTS, _MERGED),
    "gold_cube": _with(_EVENTS, _CUBE),
    "fair_sample": _with(_EVENT_CTES, _FAIR),
    "landing_stream": _with(_EVENT_CTES, _LOWER_TRANSACCION),
    "document_export_content": _with((*_EVENTS, _DAMAGE), _DIFFERENCES),
}
