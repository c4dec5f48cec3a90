"""Token ids as directly addressable codes: files that give any token without decoding a block.

Layout of a segment file, all integers little-endian
----------------------------------------------------
=================  ======================================================================
magic, counts      ``DACS``, then u32 version, levels, chunk bits, documents; u64 ids
document ids       i64 each, ascending; a missing id is the least i64
document starts    u64, one more than there are documents: first id of each within the file
per level          u64 chunks, then the chunks (8 bits each), the continuation bitmap and the
                   rank directory (u32 set bits before every 512th bit)
=================  ======================================================================

An id is cut into chunks of 8 bits, lowest first. Level 0 has the first chunk of every id; a
set bit in the bitmap says that the id goes on, and the number of set bits before it is the
place of the next chunk on the next level. Ids are below 2**32.

A segment holds whole documents and about a million ids, one document's at least. Where ids of
the whole corpus are counted, the segment's own start comes from the manifest.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import read_file, stored, write_file
from strata.llm.tokens import END_ID, ID_TYPE, WORD_BPE, document_ids
from strata.scratch import scratch_path

MAGIC = b"DACS"
VERSION = 1
CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_IDS = 1_000_000
FILES_A_TASK = 8
NO_DOCUMENT = -(2**63)

_HEAD = struct.Struct("<4sIIIIQ")

MANIFEST = "part long, seq long, path string, documents long, n_ids long"


# --- one segment ------------------------------------------------------------------------


def encode_segment(doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment file from document ids, their starts (and the end) and all ids in one array."""
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        levels.append(_level((rest & 0xFF).astype(np.uint8), goes_on))
        if not goes_on.any():
            break
        rest = more[goes_on]
    head = _HEAD.pack(MAGIC, VERSION, len(levels), CHUNK_BITS, len(doc_ids), len(ids))
    directory = [np.asarray(doc_ids, "<i8").tobytes(), np.asarray(starts, "<u8").tobytes()]
    return b"".join([head, *directory, *levels])


def _level(chunks: np.ndarray, goes_on: np.ndarray) -> bytes:
    bits = np.zeros(-(-len(chunks) // RANK_BITS) * RANK_BITS, bool)
    bits[: len(chunks)] = goes_on
    set_bits = bits.reshape(-1, RANK_BITS).sum(axis=1)
    before = (np.cumsum(set_bits) - set_bits).astype("<u4")
    bitmap = np.packbits(bits, bitorder="little")
    return struct.pack("<Q", len(chunks)) + chunks.tobytes() + bitmap.tobytes() + before.tobytes()


class Segment:
    """An opened segment file: single tokens by place, whole documents, or everything."""

    def __init__(self, payload: bytes):
        magic, version, levels, bits, documents, self.n_ids = _HEAD.unpack_from(payload)
        if (magic, version, bits) != (MAGIC, VERSION, CHUNK_BITS):
            raise ValueError("not a segment file of this version")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(payload, "<i8", documents, at)
        at += 8 * documents
        self.starts = np.frombuffer(payload, "<u8", documents + 1, at).astype(np.int64)
        at += 8 * (documents + 1)
        self._levels = []
        for _ in range(levels):
            (chunks,) = struct.unpack_from("<Q", payload, at)
            blocks = -(-chunks // RANK_BITS)
            at += 8
            data = np.frombuffer(payload, np.uint8, chunks, at)
            bitmap = np.frombuffer(payload, np.uint8, blocks * RANK_BITS // 8, at + chunks)
            at += chunks + len(bitmap)
            self._levels.append((data, bitmap, np.frombuffer(payload, "<u4", blocks, at)))
            at += 4 * blocks

    def token(self, place: int) -> int:
        """The id at ``place``: one chunk, one bit and one rank a level."""
        if not 0 <= place < self.n_ids:
            raise IndexError(place)
        value = shift = 0
        for data, bitmap, before in self._levels:
            value |= int(data[place]) << shift
            if not bitmap[place >> 3] >> (place & 7) & 1:
                break
            place = self._rank(bitmap, before, place)
            shift += CHUNK_BITS
        return value

    @staticmethod
    def _rank(bitmap: np.ndarray, before: np.ndarray, place: int) -> int:
        block = place // RANK_BITS
        some = bitmap[block * RANK_BITS // 8 : (place >> 3) + 1]
        inside = int(np.bitwise_count(some[:-1]).sum())
        last = int(some[-1]) & ((1 << (place & 7)) - 1)
        return int(before[block]) + inside + last.bit_count()

    def all_ids(self) -> np.ndarray:
        """Every id, level by level from the last back to the first."""
        higher = np.zeros(0, np.uint32)
        for data, bitmap, _ in reversed(self._levels):
            value = data.astype(np.uint32)
            bits = np.unpackbits(bitmap, count=len(data), bitorder="little").view(bool)
            value[bits] |= higher << np.uint32(CHUNK_BITS)
            higher = value
        return higher.astype(ID_TYPE)

    def document(self, at: int) -> np.ndarray:
        """The ids of the document at a place in the directory, each by direct access."""
        places = range(int(self.starts[at]), int(self.starts[at + 1]))
        return np.array([self.token(p) for p in places], ID_TYPE)


# --- the corpus -------------------------------------------------------------------------


def write_tokens(
    docs: DataFrame,
    *,
    tokenizer: str = WORD_BPE,
    end_id: int = END_ID,
    segment_ids: int = SEGMENT_IDS,
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write its ids in ascending doc_id order.

    Returns the manifest: one row per segment file with ``start``, the ids of all segments
    before it. Rows with a missing doc_id come first, rows that share one are ordered by their
    text's hash. A missing or empty text is the end id alone. Other columns are ignored; an
    empty table gives an empty manifest. A row of ``docs`` is never split over files.

    The documents cross the network once, by ranges of doc_id. Only file names written by tasks
    that finished are in the manifest, so repeated attempts leave nothing that is read.
    """
    folder = scratch_path(docs.sparkSession, "segments")
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        F.xxhash64("text").alias("_tie"),
    )
    ordered = texts.repartitionByRange(F.asc_nulls_first("doc_id"), F.asc("_tie"))
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first("doc_id"), "_tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seq, names, ids, count = 0, [], [], 0
        for batch in batches:
            encoded = document_ids(batch["text"].to_pylist(), tokenizer, end_id)
            for doc_id, of_one in zip(batch["doc_id"].to_pylist(), encoded, strict=True):
                names.append(NO_DOCUMENT if doc_id is None else doc_id)
                ids.append(of_one)
                count += len(of_one) // ID_TYPE.itemsize
                if count >= segment_ids:
                    yield _written(folder, part, seq, names, ids)
                    seq, names, ids, count = seq + 1, [], [], 0
        if names:
            yield _written(folder, part, seq, names, ids)

    manifest = stored(ordered.mapInArrow(write, MANIFEST), "segment-manifest")
    return with_starts(manifest)


def _written(folder, part, seq, names, ids) -> pa.RecordBatch:
    lengths = np.array([len(x) for x in ids], np.int64) // ID_TYPE.itemsize
    starts = np.concatenate([[0], np.cumsum(lengths)])
    payload = encode_segment(names, starts, np.frombuffer(b"".join(ids), ID_TYPE))
    path = write_file(folder, f"{part:08d}-{seq:06d}.dac", payload)
    row = {"part": part, "seq": seq, "path": path}
    row |= {"documents": len(names), "n_ids": int(starts[-1])}
    return pa.RecordBatch.from_pylist([row])


def with_starts(manifest: DataFrame) -> DataFrame:
    """``start`` of each segment: sums per part first, so that one task sees a row per part."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("part").orderBy("seq")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    joined = manifest.withColumn("_within", within).join(parts, "part")
    return joined.select(
        *manifest.columns, (F.col("_base") + F.col("_within")).cast("bigint").alias("start")
    )


def read_documents(manifest: DataFrame) -> DataFrame:
    """Every document out of the segment files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. A task holds one file at a time.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(
                batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True
            ):
                yield _document_rows(Segment(read_file(path)), base)

    files = stored(manifest.select("path", "start"), "segment-files")
    # A row of the manifest is little to move but much to read, so tasks go by number of files.
    spread = files.repartition(-(-files.count() // FILES_A_TASK) or 1, "path")
    return spread.mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _document_rows(segment: Segment, base: int) -> pa.RecordBatch:
    ids, starts = segment.all_ids(), segment.starts
    crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    names = segment.doc_ids
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.int64(), mask=names == NO_DOCUMENT),
            pa.array(starts[:-1] + base, pa.int64()),
            pa.array(np.diff(starts), pa.int64()),
            pa.array(crc, pa.int64()),
        ],
        ["doc_id", "start", "n_tokens", "ids_crc32"],
    )
