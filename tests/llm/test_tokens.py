import random
import zlib

import numpy as np
import pytest

from strata.llm import addressable, packing
from strata.llm.tokens import ID_TYPE, document_ids, vocabulary_path
from tests.support import rows

TEXTS = [
    "Hello, World! it's 2024 and he'll go",
    "",
    None,
    "naïve Straße ÀÉÎ über",
    "x" * 5000 + " end",
    "a\x1cb\x85c d　e\t\n f",
    "<|endoftext|> <|ENDOFTEXT|> a<b",
    "word " * 3000,
    "same text",
    "same text",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def docs(spark):
    ids = [7, 3, None, -5, 11, 2, 9, 1, 4, 4]
    data = [(i, t, "other", 1) for i, t in zip(ids, TEXTS, strict=True)]
    return spark.createDataFrame(data, "doc_id long, text string, start string, offset int")


def _wanted(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 1], ID_TYPE)


def test_chunks_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(1)
    letters = "abXYZ .,'!?<|>0129éÀßÿ×÷µªºÆŒſİıΣσςａ²½́\x1c\x85​中가😀'sS'tT\t\n\r\x00\x7f"
    texts = TEXTS + ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(2000)]
    found = document_ids([None if t is None else t.encode() for t in texts])
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, ID_TYPE).tolist() == _wanted(tokenizer, text).tolist(), text


def test_every_token_of_a_segment_is_addressable():
    rng = np.random.default_rng(2)
    parts = [rng.integers(0, 256, 700), rng.integers(0, 1 << 32, 900), [0, 255, 256, 65536]]
    ids = np.concatenate(parts).astype(np.uint32)
    payload = addressable.encode_segment([5, 6, 7], [0, 700, 1600, len(ids)], ids)
    segment = addressable.Segment(payload)
    assert segment.all_ids().tolist() == ids.tolist()
    assert [segment.token(i) for i in range(len(ids))] == ids.tolist()
    assert segment.document(1).tolist() == ids[700:1600].tolist()
    with pytest.raises(IndexError):
        segment.token(len(ids))
    empty = addressable.Segment(addressable.encode_segment([], [0], ids[:0]))
    assert empty.all_ids().tolist() == []
    with pytest.raises(ValueError):
        addressable.Segment(b"XXXX" + payload[4:])


def test_documents_come_back_from_the_files(docs, tokenizer):
    manifest = addressable.write_tokens(docs, segment_ids=500)
    found = addressable.read_documents(manifest).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, -5, 1, 2, 3, 4, 4, 7, 9, 11]
    by_id = {r.doc_id: t for r, t in zip(docs.collect(), TEXTS, strict=True)}
    start = 0
    for row in found:
        ids = _wanted(tokenizer, by_id[row.doc_id])
        crc = zlib.crc32(ids.tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    assert manifest.count() > 1
    empty = addressable.write_tokens(docs.where("false"))
    assert addressable.read_documents(empty).collect() == []


def test_pieces_fill_sequences(docs, tokenizer):
    packed = packing.pack(docs, capacity=64, unit=4, keep_ids=True).collect()
    pieces = {}
    for row in packed:
        pieces.setdefault((row.doc_id, row.doc_tokens), []).append(row)
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, ID_TYPE).tobytes())
    wanted = sorted(_wanted(tokenizer, t).tolist() for t in TEXTS)
    found = []
    for own in pieces.values():
        copies = sum(r.start == 0 for r in own)
        ids = [i for r in sorted(own, key=lambda r: r.start)[::copies] for i in r.ids]
        found += [ids] * copies
    assert sorted(found) == wanted
    sequences = {}
    for row in packed:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, capacity=10, unit=4)


def test_plans_meet_demand_near_the_bound():
    rng = np.random.default_rng(3)
    for many in (3, 60, 20_000):
        sizes = rng.integers(1, 65, many)
        demand = {int(k): int(v) for k, v in zip(*np.unique(sizes, return_counts=True), strict=True)}
        slots = packing.plan(demand, 64)
        used = {}
        for size, count in demand.items():
            at, slot = slots.place(np.full(count, size), np.arange(count))
            for a, s in zip(at.tolist(), slot.tolist(), strict=True):
                used.setdefault(a, {})[s] = size
        assert all(sum(v.values()) <= 64 for v in used.values())
        assert sum(len(v) for v in used.values()) == sum(demand.values())
        bound = -(-sum(k * v for k, v in demand.items()) // 64)
        # No two sizes above half share a sequence.
        bound = max(bound, sum(v for k, v in demand.items() if k > 32))
        assert len(used) <= bound * 1.02 + 2


def test_column_generation_improves_on_greedy_patterns():
    sizes, demand = np.array([3, 4, 6, 7]), np.array([40.0, 60.0, 80.0, 30.0])
    columns, used = packing.column_generation(sizes, demand, 14)
    made = (columns * used[:, None]).sum(axis=0)
    assert np.allclose(made, demand, atol=0.02) and (columns @ sizes <= 14).all()
    greedy = packing.greedy_basis(sizes, demand, 14)
    assert used.sum() <= np.linalg.solve(greedy, demand).sum() + 0.05


def test_extra_columns_do_not_matter(docs):
    plain = docs.select("doc_id", "text")
    one, two = (packing.pack(d).select("doc_id", "start", "ids_crc32") for d in (docs, plain))
    assert rows(one) == rows(two)
