import zlib
from collections import Counter
from hashlib import sha256

import pytest

from strata.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, root string, tree int"


def h(*inputs):
    return sha256("".join(inputs).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, source, lang, n_chars, text):
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([h(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return out


def walk(tree, at):
    """(before, after) at each level."""
    for below in tree[:-1]:
        run = at - at % 3
        yield "".join(below[run:at]), "".join(below[at + 1 : run + 3])
        at //= 3


def plainly(data):
    by_source = {}
    for row in data:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = levels([leaf(*r) for r in by_source[s]])
    top = levels([trees[s][-1][0] for s in order])
    for at, s in enumerate(order):
        for i, row in enumerate(by_source[s]):
            steps = [*walk(trees[s], i), *walk(top, at)]
            value = leaf(*row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                value = leaf(*row[:4], row[4] and row[4].replace("\n", ""))
            for before, after in steps:
                value = h(before, value, after)
            proof = h(*(x for step in steps for x in step))
            root = top[-1][0]
            yield row[0], leaf(*row), trees[s][-1][0], root, proof, value, value == root


def made(count):
    data = [
        (i, f"s{i % 7}" if i % 3 else "hot", "é", i, f"line {i}\nline\n" if i % 5 else "flat")
        for i in range(count)
    ]
    return [
        *data,
        (10_001, None, None, None, None),
        (10_002, "", None, 0, ""),
        (10_002, "", None, 0, ""),
        (10_003, "-", "x", 1, "\n"),
        (10_003, "-", "x", 2, "other\n"),
        (None, "hot", "x", 2, "\n\n"),
        (10_004, "alone", "x", None, "\n"),
        (10_005, "ŝ", "x", 5, "long \n" * 50_000),
    ]


@pytest.mark.parametrize("block_levels", [1, 6])
def test_proofs_and_folded_roots_are_those_of_plain_trees(spark, block_levels):
    data = made(130)
    docs = spark.createDataFrame([(*r, "mine", 1) for r in data], COLUMNS).repartition(5)
    manifest = merkle.build(docs, block_levels)
    assert (len(manifest.sources) > 2) == (block_levels == 1)
    found = merkle.check(manifest)
    assert Counter(map(tuple, found.collect())) == Counter(plainly(data))


def test_no_rows_and_a_single_row(spark):
    docs = spark.createDataFrame([(*r, "mine", 1) for r in made(1)], COLUMNS)
    assert merkle.verify(docs.where("false")).collect() == []
    one = docs.where("doc_id = 10001")
    assert Counter(map(tuple, merkle.verify(one).collect())) == Counter(plainly([(10_001, None, None, None, None)]))
    tampered = docs.where("doc_id = 10004")
    want = list(plainly([(10_004, "alone", "x", None, "\n")]))
    assert Counter(map(tuple, merkle.verify(tampered).collect())) == Counter(want)


def test_a_version_copies_its_ancestors_and_shares_all_else():
    tree = merkle.Tree([str(i) for i in range(20)], 3)
    version = tree.version(17, "x")
    assert set(version.copied) == {(0, 17), (1, 5), (2, 1), (3, 0)}
    fresh = merkle.Tree([*map(str, range(17)), "x", "18", "19"], 3)
    for level, nodes in enumerate(fresh.nodes):
        assert [version.node(level, i) for i in range(len(nodes))] == nodes
    assert tree.version(17, "17").root == tree.root


def test_proofs_carry_siblings_and_the_copied_nodes(spark):
    docs = spark.createDataFrame([(*r, "mine", 1) for r in made(40)], COLUMNS)
    manifest = merkle.build(docs, 2)
    for row in merkle.proofs(manifest).collect():
        value = row.tampered or row.leaf
        copies = merkle.climb(value, [merkle.Step(*s) for s in row.steps])
        assert row.copied == copies
        assert merkle.climb(row.leaf, [merkle.Step(*s) for s in row.steps])[-1] == manifest.root
