"""Vector code compression with exact integer arithmetic on floating-point matrix products.

A component becomes the whole number floor(scale * x), a vector four parts, a part the number of
the nearest entry of its codebook. Squared distances come from dot products, and those from
matrix products of limbs: integers are broken into limbs of few bits, so that every product of
two limb matrices stays below 2^53, where doubles are exact; the products are put together again
as 64-bit integers. So the nearest entry, the first of equals, is the same on every machine and
in every order of rows.

Codebooks are learnt by rounds of assigning and averaging over all rows: a task sums what it
assigns to each entry, Spark adds these sums up, and only they, as many as the codebooks have
components, reach the driver. Vectors stay where they are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import attach, stored

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LIMB_BITS = 8
# Rows whose distances to all entries are held at once.
_ROWS_AT_ONCE = 4096

# Codebooks by width of the vectors: parts x entries x components of a part.
Codebooks = dict[int, np.ndarray]


# --- exact products ---------------------------------------------------------------------


def limbs(values: np.ndarray, bits: int = LIMB_BITS) -> list[np.ndarray]:
    """Integers as limbs, least first, in doubles: all but the last are in 0 to 2^bits - 1, the
    last carries the sign and is at least -2^bits and below 2^bits."""
    out, rest = [], values.astype(np.int64)
    while rest.size and (rest.max() >= 1 << bits or rest.min() < -(1 << bits)):
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def exact_dot(a: np.ndarray, b: np.ndarray, bits: int = LIMB_BITS) -> np.ndarray:
    """``a @ b.T`` of integer matrices, exactly, as long as the result fits 64 bits."""
    width = a.shape[1]
    if width << (2 * bits) > 1 << 53:
        raise ValueError("limbs are too wide for exact sums of their products")
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(part: np.ndarray, book: np.ndarray, bits: int = LIMB_BITS):
    """Number of the nearest entry, the first of equally near ones, and its squared distance."""
    beyond = (book * book).sum(axis=1)[None, :] - 2 * exact_dot(part, book, bits)
    first = beyond.argmin(axis=1)
    return first, beyond[np.arange(len(part)), first] + (part * part).sum(axis=1)


def as_integers(vectors: np.ndarray, scale: int = SCALE, parts: int = PARTS) -> np.ndarray:
    """rows x parts x components: floor(scale * x), filled up with zeros to equal parts."""
    scaled = np.floor(vectors.astype(np.float64) * scale)
    each = -(-vectors.shape[1] // parts)
    # A squared distance of whole vectors, each component off by at most twice this, fits.
    most = math.isqrt((1 << 62) // max(1, parts * each)) // 2
    if scaled.size and not np.abs(scaled).max() <= most:
        raise OverflowError(f"a component is beyond {most / scale:g}; its errors exceed 64 bits")
    whole = np.zeros((len(vectors), parts * each), np.int64)
    whole[:, : vectors.shape[1]] = scaled.astype(np.int64)
    return whole.reshape(len(vectors), parts, each)


# --- learning ---------------------------------------------------------------------------


def _kept(vectors: DataFrame) -> DataFrame:
    """Rows with a vector of finite components."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(finite, F.lit(False)))


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, row numbers, vectors) for each width in a batch, some rows at a time."""
    lists = batch["vector"]
    values = lists.flatten().to_numpy(zero_copy_only=False)
    widths = np.diff(lists.offsets.to_numpy())
    start = np.concatenate([[0], np.cumsum(widths)])
    for width in np.unique(widths):
        of_width = np.flatnonzero(widths == width)
        for at in range(0, len(of_width), _ROWS_AT_ONCE):
            rows = of_width[at : at + _ROWS_AT_ONCE]
            yield int(width), rows, values[start[rows][:, None] + np.arange(width)]


def fit(
    vectors: DataFrame,
    *,
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks learnt from every kept row of ``vectors`` (vec_id, embedding, label).

    They start as the parts of the ``entries`` vectors of smallest vec_id (null last, then by
    components), fewer where there are fewer. A round assigns every part to the nearest entry and
    replaces each entry in use by the floor of its parts' average. Vectors of another width have
    codebooks of their own.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part, so 1 to 256 entries")
    kept = _kept(vectors)
    books = {}
    for (width,) in kept.select(F.size("vector")).distinct().collect():
        of_width = kept.where(F.size("vector") == width)
        first = of_width.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries)
        found = first.select("vector").collect()
        start = np.array([r[0] for r in found], np.float64).reshape(len(found), width)
        books[width] = np.ascontiguousarray(as_integers(start, scale, parts).transpose(1, 0, 2))
    for _ in range(rounds if books else 0):
        books = _averaged(kept, books, scale)
    return books


def _averaged(kept: DataFrame, books: Codebooks, scale: int) -> Codebooks:
    """The books with each entry that is in use replaced by its parts' average, rounded down."""
    known = kept.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = known.value
        # The first component counts parts, the rest are their sums.
        totals = {w: np.zeros((*b.shape[:2], b.shape[2] + 1), np.int64) for w, b in books.items()}
        for batch in batches:
            for width, _, vectors in _by_width(batch):
                whole = as_integers(vectors, scale, len(books[width]))
                for part, book in enumerate(books[width]):
                    entry, _ = nearest(whole[:, part], book)
                    order = np.argsort(entry, kind="stable")
                    used, first = np.unique(entry[order], return_index=True)
                    total = totals[width][part]
                    total[used, 0] += np.diff([*first, len(entry)])
                    if book.shape[1]:
                        total[used, 1:] += np.add.reduceat(whole[order, part], first)
        for width, total in totals.items():
            part, entry, at = np.nonzero(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "width": pa.array(np.full(len(part), width), pa.int32()),
                    "part": pa.array(part, pa.int32()),
                    "entry": pa.array(entry, pa.int32()),
                    "at": pa.array(at, pa.int32()),
                    "total": pa.array(total[part, entry, at], pa.int64()),
                }
            )

    sums = kept.select("vector").mapInArrow(
        add, "width int, part int, entry int, at int, total long"
    )
    found = sums.groupBy("width", "part", "entry", "at").agg(F.sum("total").alias("total"))
    totals = {w: np.zeros((*b.shape[:2], b.shape[2] + 1), np.int64) for w, b in books.items()}
    for width, part, entry, at, total in found.collect():
        totals[width][part, entry, at] = total
    out = {}
    for width, book in books.items():
        count = totals[width][:, :, :1]
        out[width] = np.where(count > 0, totals[width][:, :, 1:] // np.maximum(count, 1), book)
    return out


# --- codes ------------------------------------------------------------------------------


def codebook_digests(books: Codebooks) -> dict[int, str]:
    """sha256 of each width's components as decimal numbers by part, entry and position."""
    return {
        w: sha256(",".join(map(str, b.ravel().tolist())).encode()).hexdigest()
        for w, b in books.items()
    }


def encode(vectors: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error, width) of each kept row, by codebooks of ``fit``.

    Rows whose width no codebook has are left out, like those without a finite vector.
    """
    rows = _kept(vectors)
    label = rows.schema["label"].dataType
    known = rows.sparkSession.sparkContext.broadcast(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, at, some in _by_width(batch):
                if width not in known.value:
                    continue
                whole = as_integers(some, scale, len(known.value[width]))
                codes = np.empty(whole.shape[:2], np.uint8)
                error = np.zeros(len(whole), np.int64)
                for part, book in enumerate(known.value[width]):
                    codes[:, part], off = nearest(whole[:, part], book)
                    error += off
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"].take(pa.array(at)),
                        batch["label"].take(pa.array(at)),
                        pa.array([c.tobytes().hex() for c in codes]),
                        pa.array(error),
                        pa.array(np.full(len(at), width), pa.int32()),
                    ],
                    ["vec_id", "label", "code", "error", "width"],
                )

    return rows.mapInArrow(
        code, f"vec_id long, label {label.simpleString()}, code string, error long, width int"
    )


def decode(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector array<double>): what the codes (vec_id, code, width) stand for."""
    known = codes.sparkSession.sparkContext.broadcast(books)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for code, width in zip(batch["code"].to_pylist(), batch["width"].to_pylist()):
                book = known.value[width]
                parts = [book[i, e] for i, e in enumerate(bytes.fromhex(code))]
                out.append(np.concatenate(parts)[:width] / scale)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(out, pa.list_(pa.float64()))], ["vec_id", "vector"]
            )

    return codes.select("vec_id", "code", "width").mapInArrow(
        vectors, "vec_id long, vector array<double>"
    )


def compress(
    vectors: DataFrame,
    *,
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Codes of every row of ``vectors`` (vec_id, embedding, label) whose vector is usable.

    Returns vec_id, code, error, label_error (error summed over equal labels, nulls together)
    and codebooks_sha256. Rows whose vector is null or holds null or non-finite components are
    dropped; a row without vec_id is kept and coded; repeated rows are coded each. A width that
    is no multiple of ``parts`` is filled up with zeros, vectors without components have nothing
    to lose, and each width has codebooks of its own. Other columns are ignored, an empty table
    gives no rows. A component so large that its squared error exceeds 64 bits raises.
    """
    books = fit(vectors, scale=scale, parts=parts, entries=entries, rounds=rounds)
    coded = stored(encode(vectors, books, scale), "vector-codes")
    groups = coded.groupBy("label").agg(
        F.sum("error").alias("label_error"), F.count("*").alias("_size")
    )
    met = attach(coded, stored(groups, "label-errors"), ["label"], ["vec_id", "code"])
    digest = F.lit(None).cast("string")
    for width, value in codebook_digests(books).items():
        digest = F.when(F.col("width") == width, value).otherwise(digest)
    return met.select(
        "vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256")
    )
