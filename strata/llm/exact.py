"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of characters. Equal blocks get the same integer
name by sorting them; then the names of adjacent blocks form pairs, which are sorted into names
in turn, until one name is left of each document. With the number of blocks that name is an
identity without collisions: it rests on comparing contents and never on a hash alone (hashes
only say to which task a block goes).

Contents cross the network once, cut into blocks, and blocks that make up more than a thousandth
of all are named by a broadcast of less than a thousand of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import HOT_ONE_IN, attach, stored, unused_name

BLOCK_CHARS = 2048
_NAMED = "row long, pos long, blocks long, doc_id long, sha256 string, name long"


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row, doc_id, text_sha256, blocks, name.

    Two rows have equal texts exactly when they agree in (blocks, name). A missing text is empty
    and an empty one is a single empty block. ``row`` tells rows apart that share a doc_id.
    """
    blocks = _blocks(docs, block_chars)
    level = stored(_name_blocks(blocks), "blocks").withColumn("n", F.col("blocks"))
    finished = []
    while True:
        finished.append(level.where("n = 1").drop("n", "pos"))
        level = level.where("n > 1")
        if level.isEmpty():
            break
        level = _pair(level)
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    return stored(out.withColumnRenamed("sha256", "text_sha256"), "identities")


def duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """For every row of ``docs`` whether it stays: of equal texts that of the largest doc_id.

    Returns row, doc_id, keep_id, group_size, kept, text_sha256. Rows that agree in text and
    doc_id are one group, too, of which one stays; a missing doc_id is the smallest.
    """
    named = identities(docs, block_chars)
    groups = named.groupBy("blocks", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"),
        F.count("*").alias("group_size"),
        F.count("*").alias("_size"),
    )
    met = attach(named, stored(groups, "text-groups"), ["blocks", "name"], ["row"])
    return met.select(
        "row",
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns as they were.

    The hash that finds the rows again has a name that no column has, whatever its case.
    """
    judged = stored(
        duplicates(docs, block_chars).where("kept").select("doc_id", "text_sha256"), "kept"
    )
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    name = unused_name(docs, "_sha")
    rows = docs.withColumn(name, sha)
    same = rows["doc_id"].cast("bigint").eqNullSafe(judged["doc_id"]) & (
        rows[name] == judged["text_sha256"]
    )
    out = rows.join(judged, same, "left_semi")
    if docs.count() != judged.count() and _repeats(docs):
        out = out.dropDuplicates(["doc_id", name])
    return out.select(*docs.columns)


def _repeats(docs: DataFrame) -> bool:
    return not docs.groupBy("doc_id").count().where("count > 1").isEmpty()


def _blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    """(row, doc_id, sha256, blocks, pos, block, hash); the document's own columns at pos 0."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    cut = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{block_chars}}}"), F.lit(0))
    cut = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(cut)
    split = texts.select(
        "row", "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), cut.alias("cut")
    )
    exploded = split.select(
        "row", "doc_id", "sha256", F.size("cut").cast("bigint").alias("blocks"), F.posexplode("cut")
    )
    first = F.col("pos") == 0
    return exploded.select(
        "row",
        F.when(first, F.col("doc_id")).alias("doc_id"),
        F.when(first, F.col("sha256")).alias("sha256"),
        "blocks",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("col").alias("block"),
        F.xxhash64("col").alias("hash"),
    )


def _name_blocks(blocks: DataFrame) -> DataFrame:
    counts = stored(blocks.groupBy("hash").agg(F.count("*").alias("n")), "block-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * HOT_ONE_IN > F.lit(total)
    hashes = [r[0] for r in counts.where(often).select("hash").collect()]
    if hashes:
        # Fewer than a thousand contents, as each has more than a thousandth of all blocks.
        hot = blocks.where(F.col("hash").isin(hashes)).groupBy("hash", "block")
        hot = hot.agg(F.count("*").alias("n")).where(often)
        hot = stored(
            hot.select(
                F.col("hash").alias("_hash"),
                F.col("block").alias("_block"),
                (-1 - F.monotonically_increasing_id()).alias("hot_name"),
            ),
            "hot-blocks",
        )
        met = (blocks["hash"] == hot["_hash"]) & (blocks["block"] == hot["_block"])
        blocks = blocks.join(F.broadcast(hot), met, "left").drop("_hash", "_block")
    else:
        blocks = blocks.withColumn("hot_name", F.lit(None).cast("bigint"))
    cold = F.col("hot_name").isNull()
    sent = (
        blocks.withColumn("block", F.when(cold, F.col("block")))
        .withColumn("hash", F.when(cold, F.col("hash")).otherwise(F.xxhash64("row", "pos")))
        .repartition("hash")
        .sortWithinPartitions("hash", "block")
    )
    return sent.mapInArrow(_name_sorted, _NAMED)


def _name_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the distinct contents of this task's sorted blocks, after the task's own number."""
    name = TaskContext.get().partitionId() << 40
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch["block"]
        new = np.ones(batch.num_rows, bool)
        new[1:] = pc.fill_null(pc.not_equal(block[1:], block[:-1]), True).to_numpy(False)
        new[0] = last is None or block[0].as_py() != last
        names = name + np.cumsum(new)
        name, last = int(names[-1]), block[-1].as_py()
        hot = batch["hot_name"]
        columns = [batch[c] for c in ("row", "pos", "blocks", "doc_id", "sha256")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pc.coalesce(hot, pa.array(names, pa.int64()))],
            ["row", "pos", "blocks", "doc_id", "sha256", "name"],
        )


def _pair(level: DataFrame) -> DataFrame:
    """Half as many names: those of adjacent pairs, the last one of an odd number alone."""

    def side(at: int):
        return F.max(F.when(F.col("pos") % 2 == at, F.col("name")))

    pairs = level.groupBy("row", F.floor(F.col("pos") / 2).alias("half")).agg(
        side(0).alias("left"),
        side(1).alias("right"),
        F.max("doc_id").alias("doc_id"),
        F.max("sha256").alias("sha256"),
        F.max("blocks").alias("blocks"),
        F.ceil(F.max("n") / 2).cast("bigint").alias("n"),
    )
    pairs = stored(pairs, "name-pairs")
    distinct = pairs.groupBy("left", "right").agg(F.count("*").alias("_size"))
    named = distinct.sortWithinPartitions("left", "right").withColumn(
        "name", F.monotonically_increasing_id()
    )
    met = attach(pairs, stored(named, "pair-names"), ["left", "right"], ["row", "half"])
    out = met.select(
        "row", F.col("half").alias("pos"), "blocks", "doc_id", "sha256", "name", "n"
    )
    return stored(out, "named-pairs")
