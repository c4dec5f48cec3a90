"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    addressable,
    exact,
    itq,
    limbs,
    merkle,
    packing,
    pieces,
    quality,
    secrets,
    simhash,
    toolcalls,
    toxicity,
    warc,
)
from strata.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark, sf_dir):
    """Where each piece of each document lies."""
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_token_codes(spark, sf_dir):
    """The documents as read back from the files of directly addressable codes."""
    return addressable.read_documents(addressable.write_tokens(table(spark, sf_dir, "documents")))


def op3_itq_vectors(spark, sf_dir):
    """Links and components of near-equal vectors within each label."""
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_warc(spark, sf_dir):
    """The pages as archives say after writing and reading them."""
    return warc.captures(warc.write_archives(table(spark, sf_dir, "pages")))


def op5_tool_calls(spark, sf_dir):
    """The turns of the conversations as calls and results, linked and made canonical."""
    calls, results = toolcalls.from_conversations(table(spark, sf_dir, "conversations"))
    return toolcalls.link(calls, results, toolcalls.TOOLS)


def op6_sentencepiece(spark, sf_dir):
    """Ids of the documents, and what they decode to."""
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op7_simhash(spark, sf_dir):
    """Fingerprints and components of near-equal documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    """Which of the documents with equal texts stays."""
    return exact.duplicates(table(spark, sf_dir, "documents")).drop("row")


def op9_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from the labels."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark, sf_dir):
    """Quality of every document, voted by labelled neighbours."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_limb_codes(spark, sf_dir):
    """Codes of the vectors by codebooks learnt from all of them, and what they lose."""
    return limbs.compress(table(spark, sf_dir, "embeddings"))


def op12_secrets(spark, sf_dir):
    """Where the documents hold secrets."""
    return secrets.digests(table(spark, sf_dir, "documents"))


def op13_merkle(spark, sf_dir):
    """Each document's proof in the manifest, and whether its tampered version is found out."""
    return merkle.verify(table(spark, sf_dir, "documents"))


REGISTERED: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_token_codes": op2_token_codes,
    "op3_itq_vectors": op3_itq_vectors,
    "op4_warc": op4_warc,
    "op5_tool_calls": op5_tool_calls,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_simhash": op7_simhash,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_limb_codes": op11_limb_codes,
    "op12_secrets": op12_secrets,
    "op13_merkle": op13_merkle,
}



def _limb_codes_sql() -> str:
    """Four rounds as common tables; doubles hold the whole numbers exactly."""

    def near(name: str, book: str) -> str:
        return f"""{name} AS MATERIALIZED (
          SELECT vec_id, p, min(CAST(list_dot_product(v, v) - 2 * list_dot_product(v, c)
            + list_dot_product(c, c) AS BIGINT) * 256 + e) AS best
          FROM part JOIN {book} USING (p) GROUP BY vec_id, p)"""

    steps = []
    for i in range(4):
        steps.append(near(f"near{i}", f"book{i}"))
        steps.append(f"""book{i + 1} AS MATERIALIZED (
          SELECT p, e, coalesce(any_value(means.c), any_value(book{i}.c)) AS c
          FROM book{i} LEFT JOIN (
            SELECT p, e, list(m ORDER BY j) AS c FROM (
              SELECT p, best % 256 AS e, j, floor(sum(v[j]) / count(*)) AS m
              FROM part JOIN near{i} USING (vec_id, p), generate_series(1, len(v)) AS s(j)
              GROUP BY ALL) GROUP BY p, e) AS means USING (p, e)
          GROUP BY p, e)""")
    return f"""
      WITH kept AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding,
          lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
      part AS MATERIALIZED (
        SELECT vec_id, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS v
        FROM kept, range(4) AS r(p)),
      book0 AS MATERIALIZED (
        SELECT p, e, v AS c FROM part JOIN (
          SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id)
        WHERE e < 256),
      {", ".join(steps)},
      {near("final", "book4")},
      coded AS (
        SELECT vec_id, string_agg(lower(printf('%02x', best % 256)), '' ORDER BY p) AS code,
          CAST(sum(best // 256) AS BIGINT) AS error
        FROM final GROUP BY vec_id),
      whole AS (
        SELECT sha256(string_agg(array_to_string(
          list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ','
          ORDER BY p, e)) AS codebooks_sha256 FROM book4)
      SELECT vec_id, code, error,
        CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
      FROM kept JOIN coded USING (vec_id), whole"""


def _merkle_sql() -> str:
    """Levels by recursion, one row a node; proofs and folds by walking up them."""

    def leaf(text: str) -> str:
        columns = ("doc_id", "source", "lang", "n_chars", text)
        fields = [
            f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
            for c in columns
        ]
        return f"sha256({' || '.join(fields)})"

    def tree(name: str, leaves: str) -> str:
        return f"""{name} AS (
          SELECT tree, 0 AS level, pos, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
          UNION ALL
          SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM (
            SELECT tree, max(level) + 1 AS level, pos // 3 AS pos,
              sha256(string_agg(h, '' ORDER BY pos)) AS h
            FROM {name} WHERE n > 1 GROUP BY tree, pos // 3))"""

    def step(name: str, x: str, nodes: str) -> str:
        """Siblings of the node at ``x.pos`` of level ``x.level``, before and after it."""
        return f"""(SELECT coalesce(string_agg(s.h, '' ORDER BY s.pos)
          FILTER (s.pos {name} {x}.pos), '') FROM {nodes} s WHERE s.tree = {x}.tree
          AND s.level = {x}.level AND s.pos // 3 = {x}.pos // 3)"""

    def walk(name: str, start: str, nodes: str) -> str:
        before, after = step("<", "x", nodes), step(">", "x", nodes)
        return f"""{name} AS (
          SELECT * FROM {start}
          UNION ALL
          SELECT doc_id, tree, level + 1, pos // 3, proof || b || a, sha256(b || folded || a)
          FROM (SELECT x.*, {before} AS b, {after} AS a FROM {name} x
            JOIN {nodes} y ON y.tree = x.tree AND y.level = x.level AND y.pos = x.pos AND y.n > 1))"""

    return f"""
      WITH RECURSIVE leaf AS MATERIALIZED (
        SELECT doc_id, coalesce(source, '-') || CASE WHEN source IS NULL THEN '' ELSE ':' END
            AS tree, source, {leaf("text")} AS h,
          CASE WHEN {_CRC32} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")}
            ELSE {leaf("text")} END AS folded,
          row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos
        FROM documents),
      {tree("nodes", "leaf")},
      subroot AS MATERIALIZED (
        SELECT nodes.tree AS name, '' AS tree, h,
          row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos
        FROM nodes JOIN (SELECT DISTINCT tree, source FROM leaf) USING (tree) WHERE n = 1),
      {tree("tops", "subroot")},
      start AS (SELECT doc_id, tree, 0 AS level, pos, '' AS proof, folded FROM leaf),
      {walk("low", "start", "nodes")},
      middle AS (
        SELECT doc_id, '' AS tree, 0 AS level, s.pos, proof, folded
        FROM low JOIN nodes y ON y.tree = low.tree AND y.level = low.level AND y.n = 1
          JOIN subroot s ON s.name = low.tree),
      {walk("high", "middle", "tops")},
      top AS (SELECT level, h FROM tops WHERE n = 1)
      SELECT doc_id, leaf.h AS leaf, subroot.h AS subroot, top.h AS root,
        sha256(proof) AS proof_sha256, high.folded AS folded_root, high.folded = top.h AS verified
      FROM high JOIN top USING (level) JOIN leaf USING (doc_id) JOIN subroot ON name = leaf.tree"""


# The unsigned crc32 of a decimal number, eight shifts a character.
_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
            string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
              lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)),
            4294967295)"""

ORACLES: dict[str, str] = {
    "op11_limb_codes": _limb_codes_sql(),
    "op13_merkle": _merkle_sql(),
    "op4_warc": """
      WITH p AS (
        SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS h FROM pages),
      bits AS (
        SELECT page_id, octet_length(body) AS n, h,
          list_reduce(list_transform(range(32), lambda i:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
              (instr('0123456789abcdef', substr(h, 1 + (i * 5) // 4, 1)) - 1) * 16 +
              greatest(instr('0123456789abcdef', substr(h, 2 + (i * 5) // 4, 1)) - 1, 0)
              ) // CAST(pow(2, 3 - (i * 5) % 4) AS INTEGER) % 32 AS INTEGER), 1)),
            lambda a, b: a || b) AS digest,
          min(page_id) OVER (PARTITION BY h) AS first
        FROM p)
      SELECT page_id, n AS payload_bytes, digest AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
      FROM bits""",
    "op5_tool_calls": """
      WITH a AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY CASE turn % 4
            WHEN 1 THEN to_json({'query': text, 'limit': length(text)}) ELSE to_json(text) END) AS copy
        FROM conversations WHERE role = 'assistant'),
      runs AS (
        SELECT *, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run
        FROM a WHERE copy = 1),
      placed AS (
        SELECT conv_id, turn, text,
          row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS level
        FROM runs
        UNION ALL SELECT conv_id, turn, text, NULL FROM a WHERE copy > 1),
      calls AS (
        SELECT conv_id, turn AS seq, conv_id || '-' || turn AS call_id, level,
          CASE turn % 4 WHEN 1 THEN 'search' WHEN 0 THEN 'translate' ELSE 'reply' END AS name,
          CASE WHEN level IS NULL THEN NULL WHEN turn % 4 = 1
            THEN '{"limit":' || length(text) || ',"query":' || to_json(text) || '}'
            WHEN turn % 4 = 3
            THEN '{"text":' || to_json(text) || ',"urgent":' || to_json(conv_id % 2 = 0) || '}'
            END AS arguments,
          nullif(concat_ws('; ', CASE WHEN level IS NULL THEN 'call_id: repeated' END,
            CASE turn % 4 WHEN 0 THEN 'name: unknown tool'
              WHEN 2 THEN 'text: missing; urgent: not boolean; words: not allowed' END), '')
            AS problems
        FROM placed),
      results AS (
        SELECT conv_id || '-' || (turn - 1) AS result_id, text AS result,
          row_number() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS FIRST) AS copy
        FROM conversations WHERE role <> 'assistant' OR role IS NULL),
      met AS (
        SELECT * EXCLUDE (call_id, problems, copy), coalesce(call_id, result_id) AS call_id,
          CASE WHEN call_id IS NULL THEN 'call: missing' ELSE problems END AS problems
        FROM (SELECT * FROM calls WHERE level IS NOT NULL)
          FULL JOIN (SELECT * FROM results WHERE copy = 1) ON call_id = result_id
        UNION ALL BY NAME SELECT * FROM calls WHERE level IS NULL
        UNION ALL BY NAME SELECT result_id, result_id AS call_id, result,
          'call_id: repeated' AS problems FROM results WHERE copy > 1)
      SELECT conv_id, level, seq, call_id, name, result_id IS NOT NULL AS answered, problems,
        '{"arguments":' || coalesce(arguments, 'null') || ',"call_id":' || to_json(call_id) ||
        ',"level":' || coalesce(CAST(level AS VARCHAR), 'null') ||
        ',"name":' || coalesce(CAST(to_json(name) AS VARCHAR), 'null') ||
        ',"result":' || coalesce(CAST(to_json(result) AS VARCHAR), 'null') ||
        ',"valid":' || CASE WHEN problems IS NULL THEN 'true' ELSE 'false' END || '}' AS message
      FROM met""",
    "op8_exact_dedup": """
      SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
        doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
      FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}
