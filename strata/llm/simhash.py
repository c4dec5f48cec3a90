"""SimHash near-duplicates by anchor points.

A fingerprint takes 64 majority votes over the hashes of a text's word shingles. Fingerprints
link when they differ in at most ``max_bits`` bits. Their 64 bits are cut into parts, enough
that two linked fingerprints differ in at most one bit of some part. In each part a covering code
of radius 1 serves as anchors: the code words of the Hamming code of length 15, times the
remaining bits as they are. Every fingerprint has its home at the anchor within radius 1 and is
also sent to every anchor within radius 2, radius plus threshold, that a linked one can have as
its home; each anchor compares the fingerprints at home there with all that were sent.

Equal fingerprints count once. What leaves an anchor is a star of links over the fingerprints it
found connected, so output grows with the fingerprints and not with their pairs. An anchor with
a great many at home is left to an exact way that is linear in them, see ``_by_balls``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import attach, components, grouped_pairs, local_stars, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
# Fixed value: the seed of the shingle hash.
SEED = 42
# More fingerprints at home than this and an anchor is not compared in one task.
MOST_HOMES = 50_000

_PARTS = ((0, 22), (22, 21), (43, 21))
_CODED = 15
_CHUNK = 1 << 16


# --- fingerprints -----------------------------------------------------------------------


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if set in over half of the shingle hashes; 0 if there are no words.

    Words are separated by ASCII white space and A-Z are lower-cased. Fewer words than a shingle
    has are one shingle.
    """
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[shingle_words - 1 :].tolist()
    starts = starts.tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, len(ends), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=False)
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], ">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64
        )
    return int.from_bytes(np.packbits(votes * 2 > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) per row of ``docs``, fp as a signed 64-bit number; a missing text is empty."""

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle_words) for t in batch["text"].to_pylist()]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(signed)], ["doc_id", "fp"]
            )

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    return texts.mapInArrow(of_batch, "doc_id long, fp long")


# --- anchors ----------------------------------------------------------------------------


def _near_masks() -> np.ndarray:
    """For each Hamming syndrome the flips to code words within distance 2, the nearest first.

    Bit i has syndrome i + 1. A word with syndrome 0 is a code word and has none other so near.
    """
    masks = np.zeros((16, 8), np.int64)
    for i, j in combinations(range(1, 16), 2):
        free = np.flatnonzero(masks[i ^ j, 1:] == 0)[0] + 1
        masks[i ^ j, free] = 1 << (i - 1) | 1 << (j - 1)
    masks[1:, 0] = [1 << (s - 1) for s in range(1, 16)]
    return masks


_MASKS = _near_masks()


def _syndrome(words: np.ndarray) -> np.ndarray:
    out = np.zeros_like(words)
    for bit in range(_CODED):
        out ^= (words >> bit & 1) * (bit + 1)
    return out


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint's place, anchor, role): role 0 where it is at home, 1 where it visits."""
    at, anchor, role = [], [], []
    places = np.arange(len(fps))
    bits = fps.view(np.uint64)

    def add(which, value, as_visitor):
        at.append(which)
        anchor.append(value)
        role.append(np.full(len(which), as_visitor, np.int8))

    for part, (shift, width) in enumerate(_PARTS):
        own = (bits >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
        coded = own & ((1 << _CODED) - 1)
        syndrome = _syndrome(coded)
        tag = part << 60
        home = own ^ _MASKS[syndrome, 0] | tag
        add(places, home, 0)
        add(places, home, 1)
        off = np.flatnonzero(syndrome)
        for k in range(1, 8):
            add(off, own[off] ^ _MASKS[syndrome[off], k] | tag, 1)
        for bit in range(_CODED, width):
            add(places, home ^ (1 << bit), 1)
    return np.concatenate(at), np.concatenate(anchor), np.concatenate(role)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch["fp"].to_numpy()
        at, anchor, role = anchors(fps)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(role), pa.array(fps[at])], ["group", "role", "fp"]
        )


def _load(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: batch[c].to_numpy() for c in ("group", "role", "fp")}


def links(distinct: DataFrame, max_bits: int = MAX_BITS, most_homes: int = MOST_HOMES) -> DataFrame:
    """Links (a, b) that connect what is connected among distinct fingerprints (fp)."""
    if max_bits >= 2 * len(_PARTS):
        raise ValueError(f"at most {2 * len(_PARTS) - 1} bits can be covered")
    if max_bits % 2:
        # Crowded anchors go by points half way between two fingerprints, whatever the data.
        raise ValueError("an odd number of bits has no middle")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, home, visitor in grouped_pairs(batches, _load):
            a, b = rows["fp"][home], rows["fp"][visitor]
            near = (np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits) & (a != b)
            node, root = local_stars(a[near], b[near])
            if len(node):
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    rows = distinct.mapInArrow(_anchor_rows, "group long, role byte, fp long")
    homes = rows.where("role = 0").groupBy("group").agg(F.count("*").alias("n"))
    crowded = stored(homes.where(F.col("n") > most_homes).select("group"), "crowded-anchors")
    if crowded.isEmpty():
        few, extra = rows, None
    else:
        few = rows.join(crowded, "group", "left_anti")
        many = rows.join(crowded, "group", "left_semi").select("fp").distinct()
        extra = _by_balls(stored(many, "crowded"), max_bits)
    sent = few.repartition("group").sortWithinPartitions("group", "role")
    found = sent.mapInArrow(compare, "a long, b long")
    return found if extra is None else found.unionByName(extra)


def _by_balls(many: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints by the balls around them, without comparing any two.

    Two differ in at most ``max_bits`` bits exactly when some point is within half of that, up
    and down, of either. So each is sent to every point within half, and each point links all it
    got to the least of them: as many rows per fingerprint as the ball has points.
    """

    def balls(radius: int, side: int):
        masks = [0]
        for k in range(1, radius + 1):
            masks += [sum(1 << i for i in c) for c in combinations(range(64), k)]
        masks = np.array(masks, np.uint64).view(np.int64)

        def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fps = batch["fp"].to_numpy()
                for at in range(0, len(fps), 256):
                    some = fps[at : at + 256]
                    points = (some[:, None] ^ masks[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(points),
                            pa.array(np.repeat(some, len(masks))),
                            pa.array(np.full(len(points), side, np.int8)),
                        ],
                        ["point", "fp", "side"],
                    )

        return many.mapInArrow(of_batch, "point long, fp long, side byte")

    low, high = max_bits // 2, max_bits - max_bits // 2
    points = balls(low, 0)
    least = points.groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("_size"))
    met = attach(points, stored(least, "balls"), ["point"], ["fp"])
    return met.where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


# --- documents --------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    most_homes: int = MOST_HOMES,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links. A missing or empty text has
    fingerprint 0 and links like any other; rows without a doc_id take part, but name a component
    only if nothing else in it has an id (then it is missing). Other columns are ignored.
    """
    fps = stored(fingerprints(docs, shingle_words), "fingerprints")
    groups = fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("_size"))
    groups = stored(groups, "distinct-fingerprints")
    found = components(links(groups.select("fp"), max_bits, most_homes))
    found = stored(found.withColumnRenamed("node", "fp"), "fingerprint-components")
    members = groups.join(found, "fp", "left").select(
        "fp", "least", "_size", F.coalesce("component", "fp").alias("component")
    )
    members = stored(members, "fingerprint-members")
    least = members.groupBy("component").agg(
        F.min("least").alias("component_id"), F.count("*").alias("_size")
    )
    named = attach(
        members.withColumnRenamed("_size", "rows"),
        stored(least, "components"),
        ["component"],
        ["fp"],
    )
    named = stored(
        named.select("fp", "component_id", F.col("rows").alias("_size")), "named-fingerprints"
    )
    return attach(fps, named, ["fp"], ["doc_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with the row of the smallest doc_id of each component, all columns as they were.

    Rows that share a doc_id are one document and stay or go together; rows without one stay.
    """
    judged = near_duplicates(docs, **how)
    gone = stored(
        judged.where("doc_id <> component_id").select("doc_id").distinct(), "near-duplicates"
    ).select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["_gone"], "left_anti")
