"""What several operators share: stored intermediates, skew-safe joins, components, files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.scratch import scratch_path

# A key with more than one row in this many is hot; so there are never more hot keys than this.
HOT_ONE_IN = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: lineage ends, retries agree."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], spread: Sequence[str]
) -> DataFrame:
    """``rows`` with the columns of their group; every row of ``rows`` has one in ``groups``.

    ``groups`` is stored, has one row per ``keys`` and a column ``_size``, the rows of that key.
    Keys with over a thousandth of all rows are fewer than a thousand, so they are broadcast;
    their rows then cross the network by ``spread`` and meet nothing there. So no task gets more
    than a thousandth of the rows for one key. Keys compare null-safe.
    """
    total = groups.agg(F.sum("_size")).first()[0] or 0
    values = [c for c in groups.columns if c not in keys and c != "_size"]
    packed = F.struct(*values).alias("_group")

    def named(prefix: str, condition: Column) -> DataFrame:
        return groups.where(condition).select(*[F.col(k).alias(prefix + k) for k in keys], packed)

    is_hot = F.col("_size") * HOT_ONE_IN > F.lit(total)
    hot = named("_h_", is_hot).withColumnRenamed("_group", "_hot")
    cold = named("_c_", ~is_hot).withColumn("_c_lane", F.lit(0).cast("bigint"))

    def same(left: DataFrame, right: DataFrame, prefix: str) -> Column:
        out = F.lit(True)
        for k in keys:
            out = out & left[k].eqNullSafe(right[prefix + k])
        return out

    found = rows.join(F.broadcast(hot), same(rows, hot, "_h_"), "left").drop(
        *["_h_" + k for k in keys]
    )
    # An odd lane matches no cold group; it is the same when a task is retried.
    lane = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(
        F.xxhash64(*spread).bitwiseOR(F.lit(1))
    )
    found = found.withColumn("_lane", lane.cast("bigint"))
    met = found.join(
        cold, (found["_lane"] == cold["_c_lane"]) & same(found, cold, "_c_"), "left"
    ).withColumn("_hot", F.coalesce("_hot", "_group"))
    return met.select(*rows.columns, *[F.col(f"_hot.{v}").alias(v) for v in values])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b longs, a <> b): (node, component = smallest node).

    Alternating large and small stars: each round hangs every node on the least neighbour it
    knows, until only stars are left. Rounds grow with the logarithm of the longest path. A
    round is stored in the shared folder, and nothing but two sums reaches the driver.
    """
    pairs = edges.select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    ).where("hi <> lo")
    pairs = stored(pairs.distinct(), "edges")
    before = _checksum(pairs)
    while before[0]:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        large = _star(both).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = stored(large.where("hi <> lo").distinct(), "large-star")
        small = _star(large.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        small = small.select(F.explode(F.array("v", "u")).alias("hi"), F.col("m").alias("lo"))
        pairs = stored(small.where("hi <> lo").distinct(), "small-star")
        after = _checksum(pairs)
        if after == before:
            break
        before = after
    centres = pairs.select("lo").distinct()
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        centres.select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    )


def _star(directed: DataFrame) -> DataFrame:
    """(u, v) with m, the least of u and all its v."""
    least = directed.groupBy("u").agg(
        F.least(F.first("u"), F.min("v")).alias("m"), F.count("*").alias("_size")
    )
    return attach(directed, stored(least, "star"), ["u"], ["u", "v"])


def _checksum(pairs: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    return tuple(pairs.agg(F.count("*"), mixed).first())


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between values to as few that connect the same: (value, least value it reaches)."""
    if not len(a):
        return a, b
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def grouped_pairs(
    batches: Iterable[pa.RecordBatch],
    load: Callable[[pa.RecordBatch], dict[str, np.ndarray]],
    most: int = 1_000_000,
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """All (home, visitor) pairs within each group, some at a time.

    Rows come sorted by group with homes (``role`` 0) first. Yields the loaded columns with the
    row numbers of homes and visitors, at most ``most`` pairs at once. Only the homes of the
    group that a batch ends in are kept for the next, so memory is bounded by a batch and the
    homes of one group.
    """
    kept: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = load(batch)
        if kept is not None:
            if kept["group"][0] == rows["group"][0]:
                rows = {k: np.concatenate([kept[k], rows[k]]) for k in rows}
            kept = None
        group, role = rows["group"], rows["role"]
        cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
        first = np.concatenate([[0], cuts])
        last = np.concatenate([cuts, [len(group)]])
        homes = np.add.reduceat((role == 0).astype(np.int64), first)
        middle = first + homes
        for chunk in _bounded(homes * (last - middle), most):
            for home, visitor in _crossed(first[chunk], middle[chunk], last[chunk], most):
                yield rows, home, visitor
        tail = slice(first[-1], middle[-1])
        if middle[-1] > first[-1]:
            kept = {k: v[tail] for k, v in rows.items()}


def _bounded(pairs: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Groups that have pairs, in runs of at most ``most`` pairs or of one group."""
    wanted = np.flatnonzero(pairs)
    if not len(wanted):
        return
    run = np.cumsum(pairs[wanted]) // most
    yield from np.split(wanted, np.flatnonzero(np.diff(run)) + 1)


def _crossed(first, middle, last, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    homes, visitors = middle - first, last - middle
    total = int((homes * visitors).sum())
    if total <= 2 * most or len(first) > 1:
        count = homes * visitors
        of = np.repeat(np.arange(len(count)), count)
        at = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        yield first[of] + at // visitors[of], middle[of] + at % visitors[of]
        return
    step = max(1, most // int(homes[0]))
    own = np.arange(first[0], middle[0])
    for start in range(int(middle[0]), int(last[0]), step):
        some = np.arange(start, min(start + step, int(last[0])))
        yield np.repeat(own, len(some)), np.tile(some, len(own))


def write_file(folder: str, name: str, payload: bytes) -> str:
    """Write one file under a folder of any file system that Arrow knows; returns its path.

    The name carries a part that no other attempt of the task shares: a file counts only once
    the manifest row that names it has been committed.
    """
    system, base = file_system(folder)
    system.create_dir(base, recursive=True)
    unique = f"{uuid.uuid4().hex}-{name}"
    with system.open_output_stream(f"{base}/{unique}", compression=None) as out:
        out.write(payload)
    return f"{folder}/{unique}"


def read_file(path: str) -> bytes:
    system, base = file_system(path)
    with system.open_input_stream(base, compression=None) as source:
        return source.read()


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        system, base = fs.FileSystem.from_uri(path)
        return system, base.rstrip("/")
    return fs.LocalFileSystem(), path.rstrip("/")
