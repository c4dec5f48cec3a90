"""A Merkle manifest of documents: proofs for every row, versions for tampered ones.

A source is a tree over its documents by doc_id, three children to a node; the sources' roots
are the leaves of the tree above them. Positions come from one range shuffle and counts per
partition. Runs of consecutive leaves, aligned to a power of three, make a block: a block is one
row, and its levels are built in one task. The roots of a tree's blocks are the leaves of the
next tier's blocks, until one is left, so a source of any size is many blocks and a few tiers.

The tree of a block is persistent: a tampered leaf makes a version of it that shares every node
but the leaf and its ancestors, which are copied. Above the block a version goes on along the
block's path, the siblings that all its leaves have in common; that is one row per block, made
by walking the tiers down again, and so upper versions are made where their block is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

FAN = 3
# Levels of a block: it has three to the power of this many leaves.
BLOCK_LEVELS = 6
# Starts of partitions that are broadcast; with more, sources are small and are shuffled.
_STARTS_BROADCAST = 50_000

_STEPS = "array<struct<before: string, after: string>>"
_STEPS_ARROW = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


# --- trees ------------------------------------------------------------------------------


class Step(NamedTuple):
    """A level of a path: what stands before and after the own node in its run."""

    before: str
    after: str


def digest(*inputs: str) -> str:
    return sha256("".join(inputs).encode()).hexdigest()


def depth(leaves: int) -> int:
    """Levels above ``leaves`` leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // FAN)
        levels += 1
    return levels


class Tree:
    """Nodes by level, leaves first; ``levels`` of them above the leaves."""

    def __init__(self, leaves: list[str], levels: int):
        self.nodes = [leaves]
        for _ in range(levels):
            below = self.nodes[-1]
            self.nodes.append(
                [digest(*below[i : i + FAN]) for i in range(0, len(below), FAN)]
            )

    @property
    def root(self) -> str:
        return self.nodes[-1][0]

    def path(self, leaf: int) -> list[Step]:
        steps = []
        for below in self.nodes[:-1]:
            first = leaf - leaf % FAN
            steps.append(
                Step("".join(below[first:leaf]), "".join(below[leaf + 1 : first + FAN]))
            )
            leaf //= FAN
        return steps

    def version(self, leaf: int, value: str) -> Version:
        """The tree with another leaf: ancestors are copied, all other nodes are shared."""
        copied = {(0, leaf): value}
        for level, step in enumerate(self.path(leaf)):
            value, leaf = digest(step.before, value, step.after), leaf // FAN
            copied[level + 1, leaf] = value
        return Version(self, copied)


class Version(NamedTuple):
    """A tree that differs from ``base`` in the copied nodes only."""

    base: Tree
    copied: dict[tuple[int, int], str]

    def node(self, level: int, at: int) -> str:
        own = self.copied.get((level, at))
        return self.base.nodes[level][at] if own is None else own

    @property
    def root(self) -> str:
        return self.node(len(self.base.nodes) - 1, 0)


def climb(value: str, steps: list[Step]) -> list[str]:
    """The copies that a version makes along a path, the last one its root."""
    copies = []
    for before, after in steps:
        value = digest(before, value, after)
        copies.append(value)
    return copies


# --- leaves -----------------------------------------------------------------------------


def _field(value: Column) -> Column:
    """A value with its length in bytes in front; a missing one is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, hash, item): the leaf of each row, and that of its tampered text if any.

    ``tree`` stands for the source. Where two divides the crc32 of the decimal doc_id, ``item``
    is the leaf without the line feeds of the text. A row without doc_id is never tampered with.
    """
    key, text = F.col("doc_id").cast("bigint"), F.col("text").cast("string")

    def leaf(own_text: Column) -> Column:
        parts = [key, F.col("source"), F.col("lang"), F.col("n_chars").cast("bigint"), own_text]
        return F.sha2(F.concat(*[_field(p) for p in parts]).cast("binary"), 256)

    chosen = F.crc32(key.cast("string").cast("binary")) % 2 == 0
    return docs.select(
        _field(F.col("source")).alias("tree"),
        key.alias("doc_id"),
        leaf(text).alias("hash"),
        F.when(chosen, leaf(F.replace(text, F.lit("\n"), F.lit("")))).alias("item"),
    )


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their position in their tree by ``order`` (nulls first), and its size ``n``.

    One range shuffle sorts all rows; what a partition has to add to its own row numbers is the
    sum of the counts before it, and there is one count per tree and partition.
    """
    keys = [F.asc_nulls_first(c) for c in ("tree", *order)]
    lined = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    lined = lined.withColumn("_part", F.spark_partition_id())
    lined = stored(lined.withColumn("_at", F.monotonically_increasing_id()), "merkle-lined")
    counts = lined.groupBy("tree", "_part").agg(
        F.count("*").alias("_rows"), F.min("_at").alias("_first")
    )
    whole = Window.partitionBy("tree")
    so_far = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        counts.select(
            "tree",
            "_part",
            "_first",
            F.coalesce(F.sum("_rows").over(so_far), F.lit(0)).alias("_before"),
            F.sum("_rows").over(whole).alias("n"),
        ),
        "merkle-starts",
    )
    if starts.count() <= _STARTS_BROADCAST:
        starts = F.broadcast(starts)
    met = lined.join(starts, ["tree", "_part"])
    pos = F.col("_at") - F.col("_first") + F.col("_before")
    return met.withColumn("pos", pos).drop("_part", "_at", "_first", "_before")


# --- tiers ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """Blocks by tier, of the sources and of the tree above them; ``root`` is None without rows.

    A block has tree, block (its number), n (nodes of its tier in the tree), members (pos, hash,
    item, doc_id) and root. All blocks but a tree's top one have ``block_levels`` levels.
    """

    sources: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    block_levels: int


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (tree, pos, n, hash, item, doc_id) as one row per aligned block, with its root."""

    @F.pandas_udf("string")
    def root(hashes: pd.Series, n: pd.Series) -> pd.Series:
        pairs = zip(hashes, n, strict=True)
        found = [Tree(list(h), min(depth(m), levels)).root for h, m in pairs]
        return pd.Series(found, dtype=object)

    block = F.expr(f"pos div {FAN**levels}").alias("block")
    members = F.array_sort(F.collect_list(F.struct("pos", "hash", "item", "doc_id")))
    grouped = nodes.groupBy("tree", block).agg(F.max("n").alias("n"), members.alias("members"))
    return stored(grouped.withColumn("root", root("members.hash", "n")), "merkle-blocks")


def _tiers(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Blocks by tier, and (tree, root) of every tree."""
    tiers, roots, most = [], None, FAN**levels
    while True:
        blocks = _blocks(nodes, levels)
        tiers.append(blocks)
        own = blocks.where(F.col("n") <= most).select("tree", "root")
        roots = own if roots is None else roots.unionByName(own)
        more = blocks.where(F.col("n") > most)
        if more.isEmpty():
            return tiers, roots
        nodes = more.select(
            "tree",
            F.col("block").alias("pos"),
            F.expr(f"(n + {most - 1}) div {most}").alias("n"),
            F.col("root").alias("hash"),
            F.lit(None).cast("string").alias("item"),
            F.lit(None).cast("bigint").alias("doc_id"),
        )


def build(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text).

    Leaves of a source ascend by doc_id (null first; rows that share one by their hash), sources
    by their bytes (null first). Repeated rows are leaves each. Other columns are ignored.
    """
    lowest = _ranked(stored(leaves(docs), "merkle-leaves"), "doc_id", "hash")
    sources, roots = _tiers(lowest, block_levels)
    name = F.expr("CASE WHEN tree <> '-' THEN substr(tree, instr(tree, ':') + 1) END")
    subroots = roots.select(
        F.lit("").alias("tree"),
        name.alias("source"),
        F.col("root").alias("hash"),
        F.col("tree").alias("item"),
        F.lit(None).cast("bigint").alias("doc_id"),
    )
    lined = _ranked(stored(subroots, "merkle-subroots"), "source").drop("source")
    top, _ = _tiers(lined, block_levels)
    last = top[-1].select("root").first()
    return Manifest(sources, top, last and last["root"], block_levels)


# --- paths ------------------------------------------------------------------------------


def _members(batches: Iterator[pa.RecordBatch], levels: int):
    """Per block its tree, subroot, levels above its members, the members and the path above."""
    for batch in batches:
        lists = batch["members"]
        flat, ends = lists.flatten(), lists.offsets.to_pylist()
        columns = {f: flat.field(f).to_pylist() for f in ("pos", "hash", "item", "doc_id")}
        above = batch["steps"].to_pylist()
        for i, n in enumerate(batch["n"].to_pylist()):
            part = slice(ends[i] - ends[0], ends[i + 1] - ends[0])
            steps = [Step(s["before"], s["after"]) for s in above[i]]
            yield (
                batch["tree"][i].as_py(),
                batch["subroot"][i].as_py(),
                Tree(columns["hash"][part], min(depth(n), levels)),
                {f: v[part] for f, v in columns.items()},
                steps,
            )


_PATH = f"tree string, pos long, hash string, item string, subroot string, steps {_STEPS}"


def _paths(blocks: DataFrame, levels: int) -> DataFrame:
    """Blocks with their path to the root as their members with theirs."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, subroot, nodes, own, steps in _members(batches, levels):
            n = len(own["pos"])
            paths = [
                [s._asdict() for s in (*nodes.path(i), *steps)] for i in range(n)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * n, pa.string()),
                    pa.array(own["pos"], pa.int64()),
                    pa.array(own["hash"], pa.string()),
                    pa.array(own["item"], pa.string()),
                    pa.array([subroot] * n, pa.string()),
                    pa.array(paths, _STEPS_ARROW),
                ],
                ["tree", "pos", "hash", "item", "subroot", "steps"],
            )

    return blocks.mapInArrow(expand, _PATH)


def _descended(tiers: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """The lowest tier's blocks with subroot and path; ``tops`` has them by tree."""
    above, most = None, FAN**levels
    for blocks in reversed(tiers):
        met = blocks.where(F.col("n") <= most).join(tops, "tree")
        if above is not None:
            upper = above.select("tree", F.col("pos").alias("block"), "subroot", "steps")
            lower = blocks.where(F.col("n") > most).join(upper, ["tree", "block"])
            met = met.unionByName(lower)
        above = None if blocks is tiers[0] else _paths(met, levels)
    return met


def _placed(manifest: Manifest) -> DataFrame:
    """Blocks of documents with the subroot of their source and their path to the root."""
    spark = manifest.top[0].sparkSession
    start = spark.range(1).select(
        F.lit("").alias("tree"),
        F.lit(None).cast("string").alias("subroot"),
        F.array().cast(_STEPS).alias("steps"),
    )
    levels = manifest.block_levels
    sources = _paths(_descended(manifest.top, start, levels), levels)
    tops = sources.select(
        F.col("item").alias("tree"), F.col("hash").alias("subroot"), "steps"
    )
    return _descended(manifest.sources, tops, levels)


def proofs(manifest: Manifest) -> DataFrame:
    """Per row doc_id, leaf, subroot, steps (siblings before and after the own node, level by
    level to the root), tampered (the tampered leaf or null) and copied, the nodes that its
    version copies above the leaf, the last one the version's root; untampered rows fold their
    own leaf."""

    levels = manifest.block_levels

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _proved(batches, levels):
            columns = {k: [r[k] for r in rows] for k in rows[0]}
            columns["steps"] = [[s._asdict() for s in p] for p in columns["steps"]]
            yield pa.RecordBatch.from_pydict(
                columns,
                pa.schema(
                    [
                        ("doc_id", pa.int64()),
                        ("leaf", pa.string()),
                        ("tampered", pa.string()),
                        ("subroot", pa.string()),
                        ("steps", _STEPS_ARROW),
                        ("copied", pa.list_(pa.string())),
                    ]
                ),
            )

    return _placed(manifest).mapInArrow(
        prove,
        "doc_id long, leaf string, tampered string, subroot string, "
        f"steps {_STEPS}, copied array<string>",
    )


def _proved(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[list[dict]]:
    """The rows of one block after the other."""
    for _, subroot, nodes, own, above in _members(batches, levels):
        rows = []
        for i, (leaf, tampered) in enumerate(zip(own["hash"], own["item"], strict=True)):
            version = nodes.version(i, leaf if tampered is None else tampered)
            within = list(version.copied.values())[1:]
            rows.append(
                {
                    "doc_id": own["doc_id"][i],
                    "leaf": leaf,
                    "tampered": tampered,
                    "subroot": subroot,
                    "steps": nodes.path(i) + above,
                    "copied": within + climb(version.root, above),
                }
            )
        yield rows


def check(manifest: Manifest) -> DataFrame:
    """Per row doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``proof_sha256`` is the digest of the siblings from leaf to root; ``folded_root`` is what the
    row's version comes to. A manifest without rows gives none. No path leaves its task.
    """

    levels = manifest.block_levels

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _proved(batches, levels):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["doc_id"] for r in rows], pa.int64()),
                    pa.array([r["leaf"] for r in rows], pa.string()),
                    pa.array([r["subroot"] for r in rows], pa.string()),
                    pa.array([digest(*(x for s in r["steps"] for x in s)) for r in rows]),
                    # A lone leaf of a lone source is the root.
                    pa.array([[r["tampered"] or r["leaf"], *r["copied"]][-1] for r in rows]),
                ],
                ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"],
            )

    folded = _placed(manifest).mapInArrow(
        fold,
        "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string",
    )
    root = F.lit(manifest.root).cast("string")
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def verify(docs: DataFrame) -> DataFrame:
    """``check`` of the manifest of ``docs``: one row per document, tampered ones unverified."""
    return check(build(docs))
