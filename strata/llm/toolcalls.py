"""Tool calls linked to their results, ordered, checked against schemas and made canonical.

Calls and results meet by a hash join over the call identifier. A call may name an earlier call
that it depends on; its level is the number of calls before it on that path, found by pointer
doubling, so a path of n calls takes about log2(n) rounds. Arguments are checked field by field
against the tool's schema, and every pair becomes one line of JSON with sorted keys and no
blanks. Everything is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import attach, stored

# Kinds of a field, and the types that parsed JSON has for them.
KINDS = {
    "string": ("string", r"^STRING$"),
    "integer": ("bigint", r"^BIGINT$"),
    "number": ("double", r"^(BIGINT|DOUBLE|DECIMAL.*)$"),
    "boolean": ("boolean", r"^BOOLEAN$"),
}

_CALL = ("conv_id", "seq", "name", "arguments", "parent_id")

Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call, with its result: level, problems and canonical JSON.

    ``calls`` has conv_id, call_id, parent_id, seq (whole number), name and arguments (JSON
    text); ``results`` has call_id and content. ``schemas`` gives for each tool its fields:
    name -> (kind, required). The result is in topological order: by conversation and level,
    then seq, over as many tasks as it takes.

    Of rows that repeat an identifier the least call meets the least result; each of the others is
    a row of its own with the problem "call_id: repeated". Rows without an identifier are such
    rows, too, with "call_id: missing". A result nobody called has "call: missing". A parent that
    does not exist counts as none; calls on or behind a cycle have level null and
    "parent_id: cycle". Only linked calls have a level.
    """
    calls, again = _apart(calls.select("call_id", *_CALL), "calls")
    results, late = _apart(results.select("call_id", F.col("content").alias("result")), "results")
    known = stored(calls, "known-calls")
    answers = results.withColumn("answered", F.lit(True))

    met = known.withColumn("called", F.lit(True)).join(levels(known), "call_id", "left")
    # Identifiers are unique on both sides by now, so no key of the hash join is hot.
    met = met.join(answers.hint("shuffle_hash"), "call_id", "full_outer")
    met = met.withColumn("alone", F.lit(None).cast("string"))
    for rows in (again.withColumn("called", F.lit(True)), late.withColumn("answered", F.lit(True))):
        met = met.unionByName(rows, allowMissingColumns=True)
    # Rows are put in order before they are checked: bounds are sampled from the bare join.
    order = [F.asc_nulls_last(c) for c in ("conv_id", "level", "seq", "call_id")]
    met = met.repartitionByRange(*order).sortWithinPartitions(*order)
    return canonical(met.withColumn("_parsed", F.expr("try_parse_json(arguments)")), schemas)


def _apart(rows: DataFrame, purpose: str) -> tuple[DataFrame, DataFrame]:
    """Rows of distinct identifiers, and all others with ``alone``, the reason why.

    Of rows that share an identifier the least is kept. They are told apart by a number that is
    stored with them, and only where identifiers repeat; a hot one is spread over tasks.
    """
    others = [c for c in rows.columns if c != "call_id"]
    named = rows.where("call_id IS NOT NULL")
    missing = rows.where("call_id IS NULL").withColumn("alone", F.lit("call_id: missing"))
    repeated = named.groupBy("call_id").agg(F.count("*").alias("_size")).where("_size > 1")
    if repeated.isEmpty():
        return named, missing
    numbered = stored(named.withColumn("_row", F.monotonically_increasing_id()), purpose)
    groups = numbered.groupBy("call_id").agg(
        F.min(F.struct(*others, "_row")).alias("_least"), F.count("*").alias("_size")
    )
    groups = stored(groups, f"{purpose}-groups")
    kept = groups.select("call_id", *[F.col(f"_least.{c}").alias(c) for c in others])
    first = groups.select("call_id", "_size", F.col("_least._row").alias("_first"))
    found = attach(numbered.select("call_id", "_row"), first, ["call_id"], ["_row"])
    extra = numbered.join(found.where("_row <> _first").select("_row"), "_row", "left_semi")
    extra = extra.drop("_row").withColumn("alone", F.lit("call_id: repeated"))
    return kept, missing.unionByName(extra)


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) of calls (call_id, parent_id), whose identifiers are unique.

    Each round doubles how far every call looks back. As a path without a cycle is shorter than
    there are calls, what has not arrived after enough rounds to pass that many is on a cycle.
    """
    exists = calls.select(F.col("call_id").alias("_id"), F.lit(True).alias("_exists"))
    parents = calls.where("parent_id IS NOT NULL").groupBy("parent_id")
    parents = parents.agg(F.count("*").alias("_size"))
    parents = parents.join(exists, F.col("parent_id") == F.col("_id"), "left").select(
        "parent_id", F.coalesce("_exists", F.lit(False)).alias("_there"), "_size"
    )
    named = attach(
        calls.where("parent_id IS NOT NULL").select("call_id", "parent_id"),
        stored(parents, "parents"),
        ["parent_id"],
        ["call_id"],
    )
    below = named.where("_there").select("call_id", F.col("parent_id").alias("back"))
    rows = calls.select("call_id").join(below, "call_id", "left").select(
        "call_id", "back", F.when(F.col("back").isNull(), 0).otherwise(1).cast("bigint").alias("far")
    )
    rows = stored(rows, "look-back")
    total, left = rows.count(), rows.where("back IS NOT NULL").count()
    reach = 1
    while left and reach <= total:
        open_rows = rows.where("back IS NOT NULL")
        wanted = open_rows.groupBy("back").agg(F.count("*").alias("_size"))
        target = rows.select(
            F.col("call_id").alias("back"), F.col("back").alias("_next"), F.col("far").alias("_far")
        )
        groups = stored(wanted.join(target, "back"), "look-back-targets")
        moved = attach(open_rows, groups, ["back"], ["call_id"]).select(
            "call_id", F.col("_next").alias("back"), (F.col("far") + F.col("_far")).alias("far")
        )
        rows = stored(rows.where("back IS NULL").unionByName(moved), "look-back")
        left = rows.where("back IS NOT NULL").count()
        reach *= 2
    return rows.select("call_id", F.when(F.col("back").isNull(), F.col("far")).alias("level"))


def canonical(linked: DataFrame, schemas: Schemas) -> DataFrame:
    """``problems`` (text, null if none) and ``message`` for linked calls."""
    problems, arguments = F.lit(None).cast("array<string>"), F.lit(None).cast("string")
    for name, fields in sorted(schemas.items()):
        is_tool = F.col("name") == name
        problems = F.when(is_tool, _problems(fields)).otherwise(problems)
        arguments = F.when(is_tool, _arguments(fields)).otherwise(arguments)
    unknown = F.coalesce(~F.col("name").isin(*schemas), F.lit(True))
    called = F.coalesce(F.col("called"), F.lit(False))
    found = (
        F.when(~called & F.col("alone").isNotNull(), F.array().cast("array<string>"))
        .when(~called, F.array(F.lit("call: missing")))
        .when(unknown, F.array(F.lit("name: unknown tool")))
        .otherwise(problems)
    )
    lost = F.array_compact(
        F.array(
            F.col("alone"),
            F.when(
                called & F.col("alone").isNull() & F.col("level").isNull(),
                F.lit("parent_id: cycle"),
            ),
        )
    )
    out = linked.withColumn("_found", F.array_sort(F.concat(found, lost)))
    valid = F.size("_found") == 0
    out = out.withColumn("_arguments", F.when(valid, arguments))
    members = [
        ("arguments", F.coalesce("_arguments", F.lit("null"))),
        ("call_id", _quoted("call_id")),
        ("level", F.coalesce(F.col("level").cast("string"), F.lit("null"))),
        ("name", _quoted("name")),
        ("result", _quoted("result")),
        ("valid", F.when(valid, F.lit("true")).otherwise(F.lit("false"))),
    ]
    parts = [F.concat(F.lit(f'"{key}":'), value) for key, value in members]
    message = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return out.select(
        "conv_id",
        "level",
        "seq",
        "call_id",
        "name",
        F.coalesce("answered", F.lit(False)).alias("answered"),
        F.when(~valid, F.array_join("_found", "; ")).alias("problems"),
        message.alias("message"),
    )


def _path(field: str) -> str:
    return f"$['{field}']"


def _problems(fields: Mapping[str, tuple[str, bool]]) -> Column:
    checks = []
    for field, (kind, required) in sorted(fields.items()):
        value = F.expr(f"""schema_of_variant(try_variant_get(_parsed, "{_path(field)}", 'variant'))""")
        absent = F.lit(f"{field}: missing") if required else F.lit(None)
        checks.append(
            F.when(value.isNull(), absent).when(~value.rlike(KINDS[kind][1]), f"{field}: not {kind}")
        )
    keys = F.coalesce(F.json_object_keys("arguments"), F.array().cast("array<string>"))
    extra = F.array_except(keys, F.array(*[F.lit(f) for f in fields]))
    extra = F.transform(extra, lambda k: F.concat(k, F.lit(": not allowed")))
    is_object = F.expr("schema_of_variant(_parsed)").startswith("OBJECT")
    listed = F.concat(F.array_compact(F.array(*checks)), extra)
    return F.when(F.coalesce(is_object, F.lit(False)), listed).otherwise(
        F.array(F.lit("arguments: not an object"))
    )


def _arguments(fields: Mapping[str, tuple[str, bool]]) -> Column:
    """The arguments with sorted keys; to_json leaves out fields that are not there."""
    values = [
        F.expr(f"""try_variant_get(_parsed, "{_path(f)}", '{KINDS[kind][0]}')""").alias(f)
        for f, (kind, _) in sorted(fields.items())
    ]
    return F.to_json(F.struct(*values))


def _quoted(column: str) -> Column:
    """A value as JSON: the member of a one-member object, or null."""
    whole = F.to_json(F.struct(F.col(column).alias("k")))
    inner = F.substring(whole, F.lit(6), F.length(whole) - 6)
    return F.when(F.col(column).isNull(), F.lit("null")).otherwise(inner)


# --- conversations as calls and results -------------------------------------------------

# Tools that the turns of a conversation stand for, by turn.
TOOLS: Schemas = {
    "reply": {"text": ("string", True), "urgent": ("boolean", False)},
    "search": {"limit": ("integer", True), "query": ("string", True)},
}


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of ``conversations`` (conv_id, turn, role, text).

    Every assistant turn is a call that depends on the assistant's turn two before, every other
    turn the result of the call one before. Whole texts go in. By rule of the turn's number
    tools differ, and some arguments lack a field, have a wrong kind or an unknown tool.
    """
    identifier = "concat(conv_id, '-', turn)"
    calls = turns.where("role = 'assistant'").selectExpr(
        "conv_id",
        f"{identifier} AS call_id",
        "concat(conv_id, '-', turn - 2) AS parent_id",
        "turn AS seq",
        "CASE turn % 4 WHEN 1 THEN 'search' WHEN 3 THEN 'reply' WHEN 2 THEN 'reply' "
        "ELSE 'translate' END AS name",
        """CASE turn % 4
          WHEN 1 THEN to_json(named_struct('query', text, 'limit', length(text)))
          WHEN 3 THEN to_json(named_struct('urgent', conv_id % 2 = 0, 'text', text))
          WHEN 2 THEN to_json(named_struct('urgent', 'yes', 'words', 1))
          ELSE to_json(named_struct('text', text)) END AS arguments""",
    )
    results = turns.where("role <> 'assistant' OR role IS NULL").selectExpr(
        "concat(conv_id, '-', turn - 1) AS call_id", "text AS content"
    )
    return calls, results
