import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from strata.llm import exact, itq, simhash
from strata.llm.common import attach, components, local_stars, stored
from tests.support import rows

DOCS = "doc_id long, text string, row string, name int"


def _groups(pairs, nodes):
    """Least node reachable from each, by brute force."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)]
    pairs += [(200, 201), (201, 202), (202, 200)] + [(300, 301)] * 5
    pairs += [(rng.randint(400, 480), rng.randint(481, 520)) for _ in range(60)]
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    wanted = _groups(pairs, {n for p in pairs for n in p})
    assert {r.node: r.component for r in found.collect()} == wanted
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_local_stars_connect_the_same():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)
    node, root = local_stars(a, b)
    wanted = _groups(list(zip(a, b, strict=True)), set(a) | set(b))
    assert {n: r for n, r in zip(node, root, strict=True)} == {
        n: r for n, r in wanted.items() if n != r
    }


def test_attach_gives_every_row_its_group(spark):
    data = [("hot", i) for i in range(3000)] + [(None, i) for i in range(50)]
    data += [(f"k{i % 900}", i) for i in range(1000)]
    df = spark.createDataFrame(data, "k string, v long")
    groups = df.groupBy("k").agg({"v": "max", "*": "count"}).toDF("k", "_size", "top")
    if dict(groups.dtypes)["_size"] != "bigint" or groups.where("k = 'hot'").first()["_size"] != 3000:
        groups = groups.toDF("k", "top", "_size")
    met = attach(df, stored(groups, "test-groups"), ["k"], ["v"])
    top = defaultdict(int)
    for k, v in data:
        top[k] = max(top[k], v)
    assert rows(met) == Counter((k, top[k], v) for k, v in data)


# --- exact ------------------------------------------------------------------------------


def test_exact_duplicates(spark):
    long = "block of text, " * 700
    texts = ["a", "a", "", None, long, long + "x", long, "A", "a ", "é" * 5000, "é" * 5000, "a\nb"]
    data = [(i, t, "r", 0) for i, t in enumerate(texts)] + [(None, "a", "r", 0), (1, "a", "r", 0)]
    docs = spark.createDataFrame(data, DOCS)
    found = exact.duplicates(docs, block_chars=16).collect()
    assert len(found) == len(data)
    by_text = defaultdict(list)
    for doc_id, text, *_ in data:
        by_text[text or ""].append(doc_id)
    for text, ids in by_text.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        own = [r for r in found if r.text_sha256 == sha]
        keep = max(i for i in ids if i is not None)
        assert Counter(r.doc_id for r in own) == Counter(ids)
        assert {(r.keep_id, r.group_size) for r in own} == {(keep, len(ids))}
        assert [r.doc_id for r in own if r.kept] == [keep]
    left = exact.drop_duplicates(docs, block_chars=16)
    assert left.columns == docs.columns
    assert sorted(r.text or "" for r in left.collect()) == sorted(by_text)
    assert exact.duplicates(docs.where("false")).collect() == []
    assert exact.drop_duplicates(docs.where("false")).collect() == []


def test_hot_blocks_are_named_apart(spark):
    data = [(i, "h" * 40 + str(i % 3), "r", 0) for i in range(600)]
    found = exact.duplicates(spark.createDataFrame(data, DOCS), block_chars=8)
    assert {(r.keep_id, r.group_size) for r in found.collect()} == {(k, 200) for k in (597, 598, 599)}


# --- simhash ----------------------------------------------------------------------------


def _fingerprint(text):
    import xxhash

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = [sum(h >> b & 1 for h in hashes) * 2 > len(hashes) for b in range(64)]
    return sum(1 << b for b, on in enumerate(bits) if on)


@pytest.fixture(scope="module")
def near():
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)] + ["Größe", "ÀB"]
    data = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "ONE  two"), (5, "one\x85two")]
    for i in range(25):
        words = rng.choices(vocabulary, k=rng.choice([3, 4, 60, 400]))
        for j in range(rng.randint(1, 5)):
            own = list(words)
            if j:
                own[rng.randrange(len(own))] = "changed"
            data.append((10 * i + j + 10, " ".join(own)))
    return data


@pytest.mark.parametrize("most_homes", [50_000, 1])
def test_near_duplicates_equal_brute_force(spark, near, most_homes):
    docs = spark.createDataFrame([(*d, "r", 0) for d in near], DOCS)
    found = simhash.near_duplicates(docs, most_homes=most_homes).collect()
    fps = {i: _fingerprint(t) for i, t in near}
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{f:016x}" for i, f in fps.items()}
    ids = list(fps)
    pairs = [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    assert {r.doc_id: r.component_id for r in found} == _groups(pairs, ids)


def test_links_at_four_bits_and_none_at_five(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(-(2**63), 2**63 - 1, 300)
    fps = []
    for i, x in enumerate(base.tolist()):
        flips = rng.choice(64, 4 + i % 2, replace=False)
        fps += [x, x ^ int(sum(np.uint64(1) << np.uint64(f) for f in flips).astype(np.int64))]
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    linked = {frozenset((r.a, r.b)) for r in found.collect()}
    assert linked == {frozenset(fps[2 * i : 2 * i + 2]) for i in range(0, 300, 2)}
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), max_bits=6)


def test_near_duplicates_are_dropped_but_for_the_smallest(spark, near):
    data = [(*d, "r", 0) for d in near] + [(None, "no id", "r", 0)]
    docs = spark.createDataFrame(data, DOCS)
    left = simhash.drop_near_duplicates(docs)
    judged = simhash.near_duplicates(docs).where("doc_id = component_id OR doc_id IS NULL")
    assert left.columns == docs.columns
    assert rows(left.select("doc_id")) == rows(judged.select("doc_id"))
    assert simhash.near_duplicates(docs.where("false")).collect() == []


# --- vectors ----------------------------------------------------------------------------


def _vectors(width=16):
    rng = np.random.default_rng(8)
    out = []
    for c in range(40):
        centre = rng.standard_normal(width)
        for _ in range(rng.integers(1, 9)):
            noise = rng.choice([0.0, 0.05, 0.25, 0.32]) * rng.standard_normal(width)
            out.append(((centre + noise).astype(np.float32).tolist(), int(c % 3)))
    out += [(out[0][0], out[0][1])] * 4 + [([x * 2 for x in out[0][0]], out[0][1])]
    odd = [None, [], [0.0] * width, [float("nan")] * width, [float("inf")] + [1.0] * (width - 1)]
    odd += [[None] + [1.0] * (width - 1), [1.0] * (width - 1)]
    out += [(v, 0) for v in odd] + [(out[0][0], None)]
    return [(i, v, label, "r") for i, (v, label) in enumerate(out)]


@pytest.mark.parametrize("most_homes", [20_000, 2])
def test_vector_links_equal_brute_force(spark, most_homes):
    data = _vectors()
    schema = "vec_id long, embedding array<float>, label int, node string"
    df = spark.createDataFrame([*data, (None, data[0][1], 0, "r")], schema)
    found = itq.near_duplicates(df, most_homes=most_homes)
    found = {r.vec_id: r for r in found.collect()}
    assert len(found) == len(data) + 1

    def good(v):
        return v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)

    usable = {i: (np.array(v), label) for i, v, label, _ in data if good(v) and label is not None}
    pairs = set()
    for a, (x, p) in usable.items():
        for b, (y, q) in usable.items():
            cosine = x @ y / (np.linalg.norm(x) * np.linalg.norm(y))
            if a < b and p == q and cosine >= 0.93:
                pairs.add((a, b))
    degree = Counter(n for p in pairs for n in p)
    wanted = sum(degree.values())
    got = sum(found[i].n_links for i, *_ in data)
    assert wanted and 0.97 * wanted <= got <= wanted
    least = _groups(pairs, [i for i, *_ in data])
    if got == wanted:
        assert {i: found[i].component_id for i in least} == least
    for i, *_ in data:
        assert found[i].n_links <= degree[i] and found[i].component_id >= least[i]
        assert found[i].kept == (found[i].component_id == i)
    assert (found[None].n_links, found[None].component_id, found[None].kept) == (0, None, False)


@pytest.mark.parametrize("bits", [1, 3, 5, 6])
def test_distances_that_cannot_be_covered_are_refused_at_any_size(spark, bits):
    one = spark.createDataFrame([(1, "a few words of a text")], "doc_id long, text string")
    with pytest.raises(ValueError):
        simhash.near_duplicates(one, max_bits=bits).collect()


def test_a_text_of_very_many_shingles_has_the_fingerprint_of_a_plain_count(spark):
    words = [f"w{i % 70_001}" for i in range(140_000)]
    [row] = simhash.near_duplicates(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).collect()
    ones = np.zeros(64, np.int64)
    for i in range(len(words) - 3):
        h = xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42)
        ones += np.unpackbits(np.frombuffer(h.to_bytes(8, "little"), np.uint8), bitorder="little")
    want = sum(1 << b for b in range(64) if 2 * ones[b] > len(words) - 3)
    assert row.fingerprint == f"{want:016x}"


def _brute(data):
    """Links and components of (vec_id, vector, label) by all cosines."""
    keys, degree, pairs = {}, Counter(), []
    for i, v, label in data:
        keys.setdefault((label, len(v)), []).append((i, np.array(v, np.float64)))
    for own in keys.values():
        x = np.vstack([v / np.linalg.norm(v) for _, v in own])
        ids = [i for i, _ in own]
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.93, 1)), strict=True):
            pairs.append((ids[a], ids[b]))
            degree.update((ids[a], ids[b]))
    return degree, pairs


def _planted(kind, rng, n=1500, width=64):
    x = rng.standard_normal((n, width))
    if kind == "common direction":
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        x = x * np.sqrt(0.1) + np.sqrt(0.9) * np.eye(width)[0]
    if kind == "one cluster":
        x[: n // 3] = x[0] + 0.2 * x[: n // 3]
    near = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = near + rng.uniform(0.0, 0.4, (n, 1)) * rng.standard_normal((n, width)) / np.sqrt(width)
    return np.vstack([x, near]).astype(np.float32)


@pytest.mark.parametrize("kind", ["spread", "common direction", "one cluster", "two widths"])
def test_links_are_found_whatever_the_vectors_share(spark, kind):
    rng = np.random.default_rng(17)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(_planted(kind, rng))]
    if kind == "two widths":
        rows += [(len(rows) + i, v.tolist(), i % 2) for i, v in enumerate(_planted(kind, rng, 400, 24))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(6)
    found = {r.vec_id: r for r in itq.near_duplicates(df, most_homes=700).collect()}
    degree, pairs = _brute([(i, np.array(v, np.float32), label) for i, v, label in rows])
    wanted, got = sum(degree.values()), sum(r.n_links for r in found.values())
    assert len(found) == len(rows) and wanted > 500
    assert 0.95 * wanted <= got <= wanted
    assert all(r.n_links <= degree[i] for i, r in found.items())


def test_labels_of_many_lanes_are_dealt_by_their_codes(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2500, 64))
    near = x[:1200] + rng.uniform(0.05, 0.35, (1200, 1)) * rng.standard_normal((1200, 64))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.vstack([x, near]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in itq.near_duplicates(df, most_homes=200, most_lanes=4).collect()}
    degree, pairs = _brute(rows)
    wanted, got = sum(degree.values()), sum(r.n_links for r in found.values())
    assert wanted > 1000 and 0.95 * wanted <= got <= wanted
    assert all(r.n_links <= degree[i] for i, r in found.items())


def test_links_do_not_depend_on_how_vectors_travel(spark, monkeypatch):
    """One lane, many lanes, dealt by codes: the pairs whose codes meet, and those only."""
    rng = np.random.default_rng(11)
    x = rng.choice([-1.0, 1.0], (120, 64))
    x[:, [t * 16 + i for t in range(4) for i in range(3)]] *= 0.1
    near = x[:60].copy()
    # The low bits of every part: two differ in the first forty pairs, three in the others.
    near[:, [t * 16 + i for t in range(4) for i in range(2)]] *= -1
    near[40:, [t * 16 + 2 for t in range(4)]] *= -1
    model = itq.Model(np.zeros(64), np.eye(64), 2, False)
    monkeypatch.setattr(itq, "_fit", lambda *_: model)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.vstack([x, near]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    pairs = {i: i - 120 for i in range(120, 160)}
    for most_homes, most_lanes in ((20_000, 32), (50, 1000), (1, 4)):
        found = itq.near_duplicates(df, most_homes=most_homes, most_lanes=most_lanes).collect()
        assert {r.vec_id for r in found if r.n_links} == {*pairs, *pairs.values()}
        assert all(r.component_id == pairs.get(r.vec_id, r.vec_id) and r.n_links <= 1 for r in found)


def test_blocks_link_the_pairs_that_tables_link(monkeypatch):
    rng = np.random.default_rng(12)
    vectors = itq.unit_rows(np.repeat(rng.standard_normal((60, 64)), 5, axis=0) + 0.25 * rng.standard_normal((300, 64)))
    model = itq.Model(*itq.learn(vectors), 0, False)
    rows = {"vector": vectors, "code": itq.encode(vectors, model.mean, model.projection)}
    rows |= {"node": np.arange(300), "routed": np.zeros(300, int), "bucket": np.zeros(300, int)}
    homes, found = itq._Homes(), []
    homes.add(rows)
    homes.build()
    for share in (1.0, -1.0):
        monkeypatch.setattr(itq, "MOST_MEETING", share)
        pairs = itq._linked(homes, rows, 0.93, model, itq._masks(0))
        found.append({(a, b) for _, _, h, v in pairs for a, b in zip(h.tolist(), v.tolist(), strict=True)})
    assert found[0] == found[1] and found[0]


def test_very_long_and_short_vectors_have_cosines_too(spark):
    data = [(1, [1e300, 1e300]), (2, [1.0, 1.0]), (3, [1e-300, 1e-300]), (4, [1.0, -1.0]), (5, [1.0]), (6, [2.0]), (7, [])]
    df = spark.createDataFrame([(*r, 0) for r in data], "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_duplicates(df).collect()}
    assert found == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5), 7: (0, 7)}


def test_no_usable_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert itq.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    one = itq.near_duplicates(spark.createDataFrame([(5, None, 1)], schema)).first()
    assert (one.vec_id, one.n_links, one.component_id, one.kept) == (5, 0, 5, True)


def test_codes_are_balanced_and_near_for_near_vectors(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((2000, 32))
    sample = spark.createDataFrame([(v.tolist(),) for v in x], "vector array<double>")
    mean, projection, *_ = itq._fit(sample)
    codes = itq.encode(x, mean, projection)
    ones = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1).mean(axis=0)
    assert (np.abs(ones - 0.5) < 0.1).all()
    near = itq.encode(x + 0.1 * rng.standard_normal(x.shape), mean, projection)
    assert np.bitwise_count((codes ^ near).view(np.uint64)).mean() < 8
