import numpy as np
import pytest

from strata.llm import limbs
from strata.llm.queries import op11_limb_codes

COLUMNS = "vec_id long, embedding array<float>, label int, code string, width string"


def plainly(data, entries=256, rounds=4):
    """Codes by loops over Python's whole numbers; all vectors of one width, a multiple of four."""
    kept = [r for r in data if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    each = len(kept[0][1]) // 4
    whole = [[int(np.floor(1024 * np.float64(np.float32(x)))) for x in r[1]] for r in kept]
    parts = [[v[p * each : (p + 1) * each] for p in range(4)] for v in whole]
    books = [[v[p] for v in parts[:entries]] for p in range(4)]

    def near(part, book):
        off = [sum((a - b) ** 2 for a, b in zip(part, c, strict=True)) for c in book]
        return off.index(min(off)), min(off)

    for _ in range(rounds):
        found = [[near(v[p], books[p])[0] for v in parts] for p in range(4)]
        for p in range(4):
            for e in set(found[p]):
                own = [v[p] for v, f in zip(parts, found[p], strict=True) if f == e]
                books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    rows = []
    for r, v in zip(kept, parts, strict=True):
        best = [near(v[p], books[p]) for p in range(4)]
        rows.append((r[0], "".join(f"{e:02x}" for e, _ in best), sum(d for _, d in best), r[2]))
    sums = {}
    for _, _, error, label in rows:
        sums[label] = sums.get(label, 0) + error
    return sorted(((i, c, e, sums[label]) for i, c, e, label in rows), key=str)


def test_products_of_limbs_are_exact():
    rng = np.random.default_rng(3)
    a = rng.integers(-(2**27), 2**27, (30, 40))
    b = rng.integers(-(2**27), 2**27, (20, 40))
    a[0], b[0] = 2**27, -(2**27)
    wanted = a.astype(object) @ b.astype(object).T
    for bits in (3, 8, 12, 23):
        assert (limbs.exact_dot(a, b, bits).astype(object) == wanted).all()
    with pytest.raises(ValueError):
        limbs.exact_dot(a, b, 24)
    for values in (a, -a, np.array([[-1, 0, 255, 256, -256, -257]])):
        parts = limbs.limbs(values, 8)
        assert all((0 <= p).all() and (p < 256).all() for p in parts[:-1])
        back = sum(p.astype(np.int64) << (8 * i) for i, p in enumerate(parts))
        assert (back == values).all()


def test_the_first_of_equally_near_entries_wins():
    book = np.array([[5, 0], [1, 0], [3, 0], [1, 0]])
    entry, off = limbs.nearest(np.array([[2, 0], [1, 0], [4, 1]]), book)
    assert entry.tolist() == [1, 1, 0] and off.tolist() == [1, 0, 2]


def test_codes_are_those_of_plain_loops(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 8))
    data = []
    for i in range(400):
        vector = (centres[i % 9] + rng.normal(scale=0.05, size=8)).astype(np.float32).tolist()
        data.append((i, vector, None if i % 11 == 0 else (0 if i % 3 == 0 else i % 5)))
    data += [
        (1000, None, 1),
        (1001, [None] + [1.0] * 7, 1),
        (1002, [float("nan")] + [1.0] * 7, 1),
        (1003, [float("-inf")] + [1.0] * 7, 1),
        (1004, [0.0] * 8, 1),
        (3, data[3][1], 7),
        (None, data[5][1], None),
        (1005, [-0.0005, 0.0005, -1e-30, 900.0, -900.0, 1.0, 2.0, 3.0], 2),
    ]
    vectors = spark.createDataFrame([(*r, "x", "y") for r in data], COLUMNS).repartition(7)
    found = limbs.compress(vectors, entries=30)
    assert found.select("codebooks_sha256").distinct().count() == 1
    keep = found.select("vec_id", "code", "error", "label_error").collect()
    assert sorted(map(tuple, keep), key=str) == plainly(data, 30)


def test_widths_apart_few_vectors_and_none(spark):
    data = [(1, [1.0, 2.0, 3.0], 0), (2, [], 0), (3, [4.0], None), (4, [1.0, 2.0, 3.0], 0)]
    vectors = spark.createDataFrame([(*r, "x", "y") for r in data], COLUMNS)
    found = {r.vec_id: r for r in limbs.compress(vectors).collect()}
    assert {i: (r.code, r.error) for i, r in found.items()} == {
        i: ("00000000", 0) for i in (1, 2, 3, 4)
    }
    assert found[1].codebooks_sha256 == found[4].codebooks_sha256 != found[3].codebooks_sha256
    assert limbs.compress(vectors.where("false")).collect() == []
    huge = spark.createDataFrame([(1, [1e30] * 4, 0, "x", "y")], COLUMNS)
    with pytest.raises(Exception, match="exceed 64 bits"):
        limbs.compress(huge).collect()


def test_codes_stand_for_vectors_near_their_own(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    books = limbs.fit(vectors)
    codes = limbs.encode(vectors, books)
    near = {r.vec_id: np.array(r.vector) for r in limbs.decode(codes, books).collect()}
    errors = {r.vec_id: r.error for r in codes.collect()}
    for r in vectors.collect():
        whole = np.floor(1024 * np.array(r.embedding, np.float64))
        off = ((whole - near[r.vec_id] * 1024) ** 2).sum()
        assert round(off) == errors[r.vec_id]
    again = op11_limb_codes(spark, "/root/testdata/sf0.001")
    assert {r.vec_id: r.error for r in again.collect()} == errors
