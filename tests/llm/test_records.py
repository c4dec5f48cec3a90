import hashlib
import json
import random
import time
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import pieces, toolcalls, warc
from strata.llm.common import read_file
from strata.llm.queries import ORACLES, REGISTERED
from strata.llm.tokens import ID_TYPE, vocabulary_path
from tests.support import compare, duck, plan, rows

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(REGISTERED[name](spark, SMOKE), duck(SMOKE), ORACLES[name]) is None


# --- archives ---------------------------------------------------------------------------


def test_captures_come_back_from_archives(spark):
    data = [
        (5, "http://a/x", "<p>same</p>"),
        (3, "http://b/é y\r\nX: 1", "<p>same</p>"),
        (9, None, "<p>same</p>"),
        (1, "http://c", None),
        (2, "http://c", ""),
        (4, "nohost", "<p>\r\n\r\nWARC/1.1</p>\x00é"),
        (4, "nohost", "<p>\r\n\r\nWARC/1.1</p>\x00é"),
        (None, "http://d", "<p>same</p>"),
        (None, "http://d", "alone"),
    ]
    pages = spark.createDataFrame([(*d, "x") for d in data], "page_id long, url string, html string, sha1 string")
    found = warc.captures(warc.write_archives(pages)).collect()
    first = {"<p>same</p>": 3, "": 1, data[5][2]: 4}

    def wanted(page_id, html):
        body = (html or "").encode()
        ref = first.get(html or "")
        revisit = ref is not None and page_id != ref
        digest = warc.payload_digest(body)
        return (page_id, len(body), digest, "revisit" if revisit else "response", ref if revisit else None)

    assert Counter(map(tuple, found)) == Counter(wanted(i, h) for i, _, h in data)
    assert warc.captures(warc.write_archives(pages.where("false"))).collect() == []


def test_small_payloads_are_all_responses_and_nested_rows_hold_the_transaction(spark):
    pages = spark.createDataFrame([(1, "http://a/p", "tiny"), (2, "http://a/q", "tiny")], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, min_bytes=5)
    assert {r.record_type for r in warc.captures(manifest).collect()} == {"response"}
    nested = warc.assemble(warc.read_archives(manifest, keep_payload=True)).collect()
    assert {r.request.target_uri for r in nested} == {"http://a/p", "http://a/q"}
    assert {bytes(r.response.payload) for r in nested} == {b"tiny"}
    assert {r.metadata.fields for r in nested} == {"pageId: 1\r\n", "pageId: 2\r\n"}
    kinds = [h["warc-type"] for f in manifest.collect() for h, _ in warc.parse_records(read_file(f.path))]
    assert sorted(kinds) == ["metadata"] * 2 + ["request"] * 2 + ["response"] * 2
    with pytest.raises(ValueError):
        list(warc.parse_records(__import__("gzip").compress(b"HTTP/1.1 200\r\n\r\n")))


# --- tool calls -------------------------------------------------------------------------

SCHEMAS = {
    "add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)},
    "flag": {"on": ("boolean", True)},
}


def test_calls_are_linked_ordered_checked_and_canonical(spark):
    calls = [
        (1, "c", None, 0, "add", '{"b": 2.5, "a":1, "note":"x \\"é\\"\\n"}'),
        (1, "d", "c", 1, "flag", '{"on": true}'),
        (1, "e", "d", 2, "flag", '{"on": "yes", "off": 1}'),
        (1, "f", "zz", 3, "add", '{"a": 1.5}'),
        (1, "g", "h", 4, "flag", '{"on": false}'),
        (1, "h", "g", 5, "flag", '{"on": false}'),
        (1, "i", "h", 6, "other", "{}"),
        (1, "j", None, 7, "add", "[1]"),
        (1, "k", None, 8, "add", "broken"),
        (1, "l", None, 9, "flag", None),
        (1, None, None, 10, "flag", '{"on": true}'),
        (1, "d", "c", 1, "flag", '{"on": true}'),
        (None, "m", "c", None, None, '{"on": null}'),
    ]
    results = [("c", "3.5"), ("c", "4"), ("x", "nobody"), (None, "lost"), ("d", None)]
    out = toolcalls.link(
        spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string, seq long, name string, arguments string"),
        spark.createDataFrame(results, "call_id string, content string"),
        SCHEMAS,
    )
    every = out.collect()
    assert len(every) == 16
    # Whatever repeats an identifier or has none is a row of its own.
    apart = [r for r in every if r.problems and "call_id: " in r.problems]
    assert sorted((r.call_id or "", r.seq or -1, r.level, r.answered, r.problems) for r in apart) == [
        ("", -1, None, True, "call_id: missing"),
        ("", 10, None, False, "call_id: missing"),
        ("c", -1, None, True, "call_id: repeated"),
        ("d", 1, None, False, "call_id: repeated"),
    ]
    assert {json.loads(r.message)["result"] for r in apart} == {None, "4", "lost"}
    found = {r.call_id: r for r in every if r not in apart}
    levels = {k: found[k].level for k in "cdefghijklm"}
    assert levels == dict(c=0, d=1, e=2, f=0, g=None, h=None, i=None, j=0, k=0, l=0, m=1)
    assert {k: r.problems for k, r in found.items()} == {
        "c": None,
        "d": None,
        "e": "off: not allowed; on: not boolean",
        "f": "a: not integer; b: missing",
        "g": "parent_id: cycle",
        "h": "parent_id: cycle",
        "i": "name: unknown tool; parent_id: cycle",
        "j": "arguments: not an object",
        "k": "arguments: not an object",
        "l": "arguments: not an object",
        "m": "name: unknown tool",
        "x": "call: missing",
    }
    assert found["c"].message == (
        '{"arguments":{"a":1,"b":2.5,"note":"x \\"é\\"\\n"},"call_id":"c","level":0,'
        '"name":"add","result":"3.5","valid":true}'
    )
    for row in found.values():
        parsed = json.loads(row.message)
        assert list(parsed) == sorted(parsed) and parsed["valid"] == (row.problems is None)
    assert found["d"].answered and not found["e"].answered
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ShuffledHashJoin" in plan
    empty = spark.createDataFrame([], out.sparkSession.createDataFrame(calls[:1], "conv_id long, call_id string, parent_id string, seq long, name string, arguments string").schema)
    none = spark.createDataFrame([], "call_id string, content string")
    assert toolcalls.link(empty, none, SCHEMAS).collect() == []


def test_hot_identifiers_long_texts_and_clashing_columns(spark):
    """A third of all rows share an identifier; none is lost, and no column gets in the way."""
    long = json.dumps({"a": 1, "b": 2, "note": "x" * 500_000})
    calls = [(1, "hot", None, i % 3, "add", '{"a": 1, "b": 2}') for i in range(300)]
    calls += [(2, f"c{i}", None, i, "add", long if i == 0 else '{"a": 1, "b": 2}') for i in range(600)]
    names = "conv_id long, call_id string, parent_id string, seq long, name string, arguments string"
    odd = spark.createDataFrame([(*c, "mine", 7, "x") for c in calls], f"{names}, alone string, level int, _row string")
    results = spark.createDataFrame([("hot", str(i), "y") for i in range(200)], "call_id string, content string, result string")
    found = toolcalls.link(odd, results, SCHEMAS).collect()
    assert len(found) == 900 + 199
    assert Counter(r.problems for r in found) == {None: 601, "call_id: repeated": 299 + 199}
    [linked] = [r for r in found if r.call_id == "hot" and r.problems is None]
    assert linked.answered and json.loads(linked.message)["result"] == "0" and linked.level == 0
    [whole] = [r for r in found if r.call_id == "c0"]
    assert len(json.loads(whole.message)["arguments"]["note"]) == 500_000


def test_levels_of_a_long_path(spark):
    calls = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(70)] + [(f"s{i}", "n69") for i in range(40)]
    found = toolcalls.levels(spark.createDataFrame(calls, "call_id string, parent_id string"))
    wanted = {f"n{i}": i for i in range(70)} | {f"s{i}": 70 for i in range(40)}
    assert {r.call_id: r.level for r in found.collect()} == wanted


# --- sentence pieces --------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(vocabulary_path(pieces.PIECES))


def _best(codec, marked):
    """The greatest sum of scores over all segmentations, by plain recursion."""

    @cache
    def best(end):
        if not end:
            return 0.0
        tried = [best(end - 1) + codec._score.get(marked[end - 1], codec._unknown)]
        for start in range(max(0, end - 16), end - 1):
            if marked[start:end] in codec._score:
                tried.append(best(start) + codec._score[marked[start:end]])
        return max(tried)

    return best(len(marked))


def test_segmentations_are_the_best_and_decode_to_the_text(codec):
    rng = random.Random(10)
    letters = "abcdefgh  the ingionest éÀß中文😀\n\t.,!?0129\x00"
    texts = ["", None, " ", "   ", "hest ariear", "é" * 300]
    texts += ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(800)]
    names = {i: p for p, i in codec._id.items()}
    for text, ids in zip(texts, codec.encode_batch(texts), strict=True):
        assert codec.decode(ids) == (text or "")
        if not text:
            assert ids == b""
            continue
        marked = pieces.MARK + text.replace(" ", pieces.MARK)
        own = [names.get(i) for i in np.frombuffer(ids, ID_TYPE).tolist()]
        unknown = sum(c not in codec._score for c in marked)
        total = sum(codec._score[p] for p in own if p) + unknown * codec._unknown
        assert total == _best(codec, marked), text
    assert codec.decode(np.array([codec._byte[0xFF]], ID_TYPE).tobytes()) == "�"


def test_documents_make_the_round_trip(spark):
    data = [(1, "Hello  wörld\n", "z"), (2, None, "z"), (None, "", "z"), (1, "a b", "z")]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids string")
    decoded = pieces.decode(pieces.encode(docs)).drop("ids")
    assert rows(decoded) == Counter((i, t or "") for i, t, _ in data)
    for row in pieces.round_trip(docs).collect():
        texts = [t or "" for i, t, _ in data if i == row.doc_id]
        assert row.text_sha256 in {hashlib.sha256(t.encode()).hexdigest() for t in texts}
    assert pieces.round_trip(docs.where("false")).collect() == []


def test_words_end_where_no_piece_goes_on():
    text = " ab, 12.5\n\n x  y_1!é "
    cut = pieces.word_pattern(["▁ab", "b", "▁", ",.", "1", "▁▁", "é"])
    assert cut.findall(text) == [" ab", ",", " 1", "2", ".", "5", "\n", "\n", " x", "  y", "_", "1", "!", "é", " "]
    glued = pieces.word_pattern(["a,", "12", "a\nb"])
    assert glued.findall(text) == [" ab,", " 12.5\n\n", " x", "  y_1!é", " "]


def test_a_small_memory_changes_no_ids(codec, monkeypatch):
    monkeypatch.setattr(pieces, "_WORDS_KNOWN", 7)
    monkeypatch.setattr(pieces, "_CHARS_AT_ONCE", 50)
    small = pieces.PieceCodec(vocabulary_path(pieces.PIECES))
    texts = [f"word{i % 13} again, and {i} more words\nof text {i % 5}" for i in range(300)]
    assert list(small.encode_batch(texts)) == list(codec.encode_batch(texts))


def test_long_and_many_records_are_read_in_windows():
    page = bytes(random.Random(4).randbytes(5_000_000))
    records = [warc.record("response", {"WARC-Record-ID": str(i)}, b) for i, b in enumerate((page, b"", b"short", page[:9000]))]
    found = list(warc.parse_records(b"".join(records)))
    assert [b for _, b in found] == [page, b"", b"short", page[:9000]]
    with pytest.raises(ValueError):
        list(warc.parse_records(b"".join(records)[:-20]))
    # Reading touches each byte a bounded number of times, however long the archive is.
    small = warc.record("metadata", {"WARC-Record-ID": "x"}, b"page " * 20)
    seconds = []
    for count in (2_000, 16_000):
        start = time.process_time()
        assert sum(1 for _ in warc.parse_records(small * count)) == count
        seconds.append(time.process_time() - start)
    assert seconds[1] < 24 * seconds[0]


def test_a_page_beyond_an_archive_comes_back_whole(spark):
    long = "<p>é " * 3_500_000
    assert len(long.encode()) > warc.ARCHIVE_BYTES
    data = [(1, "http://a", long), (2, "http://b", "short"), (3, "http://c", long)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(1)
    manifest = warc.write_archives(pages)
    assert manifest.count() > 1
    found = {r.page_id: r for r in warc.captures(manifest).collect()}
    for page_id, _, html in data:
        row, body = found[page_id], html.encode()
        assert (row.payload_bytes, row.payload_digest) == (len(body), warc.payload_digest(body))
    assert (found[3].record_type, found[3].refers_to, found[1].record_type) == ("revisit", 1, "response")


def test_a_text_beyond_a_run_makes_the_round_trip(spark):
    text = "".join(f"word{i % 997} über\n" for i in range(260_000))
    assert len(text) > pieces._CHARS_AT_ONCE
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, text)], "doc_id long, text string").repartition(1)
    found = {r.doc_id: r for r in pieces.round_trip(docs).collect()}
    sha = hashlib.sha256(text.encode()).hexdigest()
    assert found[1].text_sha256 == found[3].text_sha256 == sha and found[1].ids == found[3].ids
    assert found[1].n_ids == len(found[1].ids) // 4


def test_pieces_of_a_large_batch_come_in_slices(spark, monkeypatch):
    """A worker holds what it makes of a slice of a batch, and one worker encodes and decodes."""
    monkeypatch.setattr(pieces, "_CHARS_AT_ONCE", 100)
    texts = ["word " * 15, None, "", "é" * 250, "a b", *["some words"] * 40]
    whole = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    made = list(pieces._encoded(iter([whole, whole.slice(0, 0)]), pieces.PIECES))
    assert len(made) > 4 and [i for b in made for i in b["doc_id"].to_pylist()] == list(range(len(texts)))
    own = pieces.codec(pieces.PIECES)
    assert [i for b in made for i in b["ids"].to_pylist()] == list(own.encode_batch(texts))
    read = [t for b in pieces._decoded(iter(made), pieces.PIECES) for t in b["text"].to_pylist()]
    assert read == [t or "" for t in texts]
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    assert plan(pieces.round_trip(docs)).count(") MapInArrow") == plan(pieces.encode(docs)).count(") MapInArrow")
