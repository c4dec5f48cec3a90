"""Packing documents into fixed-length sequences as a cutting-stock problem.

Documents are cut at the sequence length; what is left of each is a piece. Piece lengths are
rounded up to units, and the histogram over units is the demand of a cutting-stock problem:
patterns say how many pieces of each size share one sequence. A linear program chooses how
often each pattern is used; its columns are generated by a knapsack over the dual prices. The
rounded-down pattern counts are handed out to the pieces by their rank within their size, and
the few pieces that rounding leaves over are packed first-fit by decreasing size.

Only the histogram, of as many rows as there are units, reaches the driver; the patterns that go
back to the tasks are bounded by the units too. Nothing on the driver grows with the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.tokens import END_ID, ID_TYPE, WORD_BPE, document_ids

CAPACITY = 2048
# Sizes are rounded up to this many tokens, which pads a piece by half of it on average.
UNIT = 8

_EPS = 1e-9
# Weight of the best feasible prices when a column is priced.
_TRUST = 0.8
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "part long, size int, place long"
)


# --- the linear program -----------------------------------------------------------------


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest price by dynamic programming: (its price, pieces of each size)."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(sizes, room, side="right")
        value[room] = value[room - 1]
        if fits:
            with_one = prices[:fits] + value[room - sizes[:fits]]
            best = int(with_one.argmax())
            if with_one[best] > value[room] + _EPS:
                value[room], choice[room] = with_one[best], best
    counts = np.zeros(len(sizes))
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return float(value[capacity]), counts


# The driver of a session uses no threaded linear algebra: where the process has started a JVM,
# such threads can be lost, and calls into them then never return.


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(axis=1)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By elimination with row pivots."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for i in range(n):
        pivot = i + int(np.abs(both[i:, i]).argmax())
        both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        factors = both[:, i].copy()
        factors[i] = 0
        both -= factors[:, None] * both[i]
    return both[:, n:]


def greedy_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """As many patterns as sizes, each filled with the largest sizes that are not used up yet.

    A pattern is used until one of its sizes is gone, so later ones do without that size: the
    matrix is triangular but for the order of rows, and its solution has no negative part.
    """
    left = demand.astype(float)
    columns = []
    for _ in sizes:
        pattern = np.zeros(len(sizes))
        room = capacity
        for i in np.flatnonzero(left > 0)[::-1]:
            pattern[i] = room // sizes[i]
            room -= int(pattern[i] * sizes[i])
        inside = np.flatnonzero(pattern)
        often = left[inside] / pattern[inside]
        gone = inside[often.argmin()]
        left[inside] = np.maximum(left[inside] - often.min() * pattern[inside], 1e-12)
        left[gone] = 0
        columns.append(pattern)
    return np.array(columns).T


def column_generation(
    sizes: np.ndarray, demand: np.ndarray, capacity: int
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and how often each is used, least in sum, to meet ``demand``: the LP optimum.

    Revised simplex from the patterns of ``greedy_basis``. Few pieces of many sizes make it
    degenerate, so demands are set apart by less than rounding will notice, and columns are
    priced between the current dual prices and the best feasible ones known, which at first are
    a size's share of a sequence. It ends when the sum is within half a sequence or a
    ten-thousandth of the bound that those give. Every basis on the way is a valid packing, so
    the bound on rounds could cost padding only.
    """
    n = len(sizes)
    demand = demand + 0.01 * (np.arange(n) + 1) / n
    basis = greedy_basis(sizes, demand, capacity)
    inverse = _inverse(basis)
    used = _times(inverse, demand)
    feasible = sizes / capacity
    bound = float((feasible * demand).sum())
    for step in range(3 * n):
        total = float(used.sum())
        if total - bound <= max(0.5, 1e-4 * total):
            break
        prices = inverse.sum(axis=0)
        for trust in (_TRUST, 0):
            tried = np.maximum(trust * feasible + (1 - trust) * prices, 0)
            price, column = best_pattern(tried, sizes, capacity)
            if float((tried * demand).sum()) / max(price, 1) > bound:
                feasible = tried / max(price, 1)
                bound = float((feasible * demand).sum())
            if (prices * column).sum() > 1 + 1e-7:
                break
        else:
            break
        direction = _times(inverse, column)
        rising = direction > _EPS
        ratios = np.full(n, np.inf)
        ratios[rising] = used[rising] / direction[rising]
        leaving = int(ratios.argmin())
        basis[:, leaving] = column
        if step % 50 == 49:
            inverse = _inverse(basis)
        else:
            pivot = inverse[leaving] / direction[leaving]
            inverse -= np.outer(direction, pivot)
            inverse[leaving] = pivot
        used = np.maximum(_times(inverse, demand), 0)
    return basis.T, used


def first_fit(sizes: list[int], capacity: int) -> list[Counter]:
    """Patterns for few pieces, by decreasing size into the first sequence with room."""
    rooms: list[int] = []
    bins: list[Counter] = []
    for size in sorted(sizes, reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= size), len(rooms))
        if at == len(rooms):
            rooms.append(capacity)
            bins.append(Counter())
        rooms[at] -= size
        bins[at][size] += 1
    return bins


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each size go, as runs of ranks sorted by ``key``."""

    key: np.ndarray
    sequence: np.ndarray
    count: np.ndarray
    slot: np.ndarray

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = _key(size, rank)
        at = np.searchsorted(self.key, wanted, side="right") - 1
        beyond = wanted - self.key[at]
        return (
            self.sequence[at] + beyond // self.count[at],
            self.slot[at] + beyond % self.count[at],
        )


def _key(size, rank):
    return np.asarray(size, np.int64) << 50 | np.asarray(rank, np.int64)


def plan(demand: dict[int, int], capacity: int) -> Slots:
    """Slots for ``demand`` (size in units -> pieces) in sequences of ``capacity`` units."""
    patterns: Counter = Counter()
    if demand.get(capacity):
        patterns[((capacity, 1),)] = demand[capacity]
    sizes = np.array(sorted(s for s, n in demand.items() if n and s < capacity), np.int64)
    left = np.array([demand[int(s)] for s in sizes], np.int64)
    if len(sizes):
        columns, used = column_generation(sizes, left.astype(float), capacity)
        for column, often in zip(columns.astype(np.int64), used, strict=True):
            # Patterns may hold more of a size than is left of it.
            most = min((left[i] // column[i] for i in np.flatnonzero(column)), default=0)
            often = int(min(np.floor(often + 1e-6), most))
            if often > 0:
                kinds = tuple((int(sizes[i]), int(column[i])) for i in np.flatnonzero(column))
                patterns[kinds] += often
                left = left - often * column
        rest = np.repeat(sizes, left).tolist()
        patterns.update(tuple(sorted(b.items())) for b in first_fit(rest, capacity))
    rows, taken, sequence = [], Counter(), 0
    for kinds, often in patterns.items():
        slot = 0
        for size, count in kinds:
            rows.append((_key(size, taken[size]), sequence, count, slot))
            taken[size] += often * count
            slot += count
        sequence += often
    rows.sort()
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return Slots(*(np.array(c, np.int64) for c in columns))


# --- the corpus -------------------------------------------------------------------------


def cut(
    docs: DataFrame,
    *,
    capacity: int = CAPACITY,
    unit: int = UNIT,
    tokenizer: str = WORD_BPE,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Documents (doc_id, text) to pieces of at most ``capacity`` ids, stored.

    Every piece has its ``size`` in units and its ``place`` among the pieces of that size in its
    task ``part``. ``keep_ids`` adds the ids themselves. A missing text is empty, an empty one
    the end id alone; rows without or with a repeated doc_id are documents like any other.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    width = ID_TYPE.itemsize

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: Counter = Counter()
        for batch in batches:
            rows, kept = [], []
            encoded = document_ids(batch["text"].to_pylist(), tokenizer, end_id)
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoded, strict=True):
                total = len(ids) // width
                for start in range(0, total, capacity):
                    own = ids[start * width : (start + capacity) * width]
                    length = len(own) // width
                    size = -(-length // unit)
                    rows.append(
                        (doc_id, start, length, zlib.crc32(own), total, part, size, seen[size])
                    )
                    seen[size] += 1
                    if keep_ids:
                        kept.append(np.frombuffer(own, ID_TYPE).tolist())
            if rows:
                yield _piece_batch(rows, kept if keep_ids else None)

    schema = _PIECES + (", ids array<long>" if keep_ids else "")
    return stored(texts.mapInArrow(pieces, schema), "pieces")


def _piece_batch(rows: list[tuple], ids: list | None) -> pa.RecordBatch:
    names = [f.split()[0] for f in _PIECES.split(", ")]
    kinds = [pa.int64()] * len(names)
    kinds[names.index("size")] = pa.int32()
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    if ids is not None:
        names, arrays = [*names, "ids"], [*arrays, pa.array(ids, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(arrays, names)


def pack(docs: DataFrame, *, capacity: int = CAPACITY, unit: int = UNIT, **how) -> DataFrame:
    """Place every piece of ``docs``: the columns of ``cut`` with ``sequence_id`` and ``offset``.

    Sequences are numbered from 0 without gaps, and the pieces of one fill it from 0 without
    gaps. An empty table gives no rows.
    """
    if capacity % unit:
        raise ValueError("the capacity must be a multiple of the unit")
    pieces = cut(docs, capacity=capacity, unit=unit, **how)
    counts = stored(pieces.groupBy("part", "size").agg(F.count("*").alias("n")), "piece-counts")
    demand = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    slots = plan(demand, capacity // unit)

    # A size has one row per task here, so the window holds as many rows as there were tasks.
    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "part", "size", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base")
    )

    @F.pandas_udf("sequence_id long, slot long")
    def placed(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, slot = slots.place(size.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "slot": slot})

    ranked = pieces.join(bases, ["part", "size"]).withColumn(
        "_at", placed("size", F.col("_base") + F.col("place"))
    )
    before = Window.partitionBy("sequence_id").orderBy("slot")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    kept = [c for c in pieces.columns if c not in ("part", "size", "place")]
    return ranked.select(*kept, "_at.sequence_id", "_at.slot").select(
        *kept,
        "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint").alias("offset"),
    )
