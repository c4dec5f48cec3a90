"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation is learnt that makes the signs of centred, decorrelated vectors balanced binary codes
of 64 bits. Codes are cut into four parts of 16 bits, a table each, and two vectors meet where
one of the parts differs in few bits. Every pair that meets is reranked by the cosine of the
original vectors in double precision; none is dropped by its codes.

How far parts may differ, and whether vectors are centred at all, is settled on the sample: by
the share that meets of its own near pairs and of pairs made at the threshold. Centring helps
where vectors spread over all directions and hurts where they share one, as links then say little
about what is left. Where no setting finds nearly all such pairs, or nearly all vectors meet
anyway, codes cannot tell links apart, and vectors are compared exactly, in blocks.

A label's vectors travel once as homes and once, per lane of homes, as visitors; the tables are
built in the task that has a lane's homes. A label of very many lanes is first dealt by the low
bits of each part, more of them the larger it is, so that a visitor sees the lanes near it only:
those whose low bits differ in no more bits than whole parts may. How vectors travel, lanes or
blocks never say which pairs meet; that is up to their codes alone.

Equal vectors count once, with their number as weight. What leaves a task is a sum per vector
and a star of links over the vectors found connected, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from strata.llm.common import attach, components, local_stars, stored

THRESHOLD = 0.93
SAMPLE = 10_000
ROUNDS = 40
# Homes that are compared in one task; more are dealt over lanes. Labels of more lanes than
# MOST_LANES are dealt by their codes beforehand.
MOST_HOMES = 20_000
MOST_LANES = 32
# The share of pairs at the threshold that must meet, and the share of all pairs that may.
RECALL = 0.98
MOST_MEETING = 0.25

_BITS = 64
_TABLES = 4
_PART = 16
# Visitors that search at once, pairs that are reranked at once.
_VISITORS, _PAIRS = 512, 50_000
# Norms beyond these are scaled before they are squared.
_TINY, _HUGE = 1e-100, 1e100


class Model(NamedTuple):
    """Codes are signs of (unit vector - mean) @ projection; parts meet up to ``reach`` bits."""

    mean: np.ndarray
    projection: np.ndarray
    reach: int
    exact: bool


# --- codes ------------------------------------------------------------------------------


def learn(
    unit: np.ndarray, rounds: int = ROUNDS, seed: int = 7, centre: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection of unit vectors to 64 values whose signs are the code.

    Alternates between the codes of the current rotation and the rotation that brings the
    vectors nearest to those codes. Fewer than 64 dimensions take several rotations side by side.
    """
    rng = np.random.default_rng(seed)
    mean = unit.mean(axis=0) if centre else np.zeros(unit.shape[1])
    centred = unit - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :_BITS]
    projected = centred @ axes
    parts = []
    for _ in range(-(-_BITS // axes.shape[1])):
        rotation = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
        for _ in range(rounds if centre else 0):
            codes = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ codes)
            rotation = left @ right
        parts.append(axes @ rotation)
    return mean, np.hstack(parts)[:, :_BITS]


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Vectors at length one, however short or long they are."""
    rows = vectors.astype(np.float64)
    top = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / np.where((top < _TINY) | (top > _HUGE), top, 1.0)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def encode(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """64-bit codes of vectors, as signed numbers."""
    packed = np.packbits((unit_rows(vectors) - mean) @ projection >= 0, axis=1, bitorder="little")
    return packed.view("<i8").ravel().astype(np.int64)


def _parts(differ: np.ndarray) -> np.ndarray:
    """Bits set in each part: one row a code."""
    return np.bitwise_count(_code_parts(differ))


def _first_table(differ: np.ndarray, reach: int) -> np.ndarray:
    """The first table in which two codes meet, ``_TABLES`` if they meet in none."""
    near = _parts(differ) <= reach
    return np.where(near.any(axis=1), near.argmax(axis=1), _TABLES)


def _meets(differ: np.ndarray, reach: int) -> np.ndarray:
    return _first_table(differ, reach) < _TABLES


def settle(unit: np.ndarray, threshold: float, seed: int = 3) -> Model:
    """The first setting whose codes find nearly all pairs at the threshold, or exact blocks."""
    rng = np.random.default_rng(seed)
    some = unit[rng.permutation(len(unit))[:3_000]]
    # Pairs at the threshold: a vector, and itself turned towards another one.
    other = some[rng.permutation(len(some))]
    across = other - (other * some).sum(axis=1, keepdims=True) * some
    length = np.linalg.norm(across, axis=1, keepdims=True)
    turned = np.flatnonzero(length[:, 0] > 1e-6)
    cosine = rng.uniform(threshold, min(1.0, threshold + 0.02), (len(turned), 1))
    made = cosine * some[turned] + np.sqrt(1 - cosine**2) * across[turned] / length[turned]
    cosines = some @ some.T
    a, b = np.nonzero(np.triu(cosines >= threshold, 1))
    few = rng.permutation(len(a))[:20_000]
    pairs = [(some[turned], made)]
    if len(few) >= 30:
        pairs.append((some[a[few]], some[b[few]]))
    for centre in (True, False):
        mean, projection = learn(unit, centre=centre)
        codes = encode(some, mean, projection)
        differ = [encode(x, mean, projection) ^ encode(y, mean, projection) for x, y in pairs]
        strange = codes ^ codes[rng.permutation(len(codes))]
        strange = strange[strange != 0]
        for reach in (2, 3):
            found = min((_meets(d, reach).mean() for d in differ if len(d)), default=1.0)
            crowd = _meets(strange, reach).mean() if len(strange) else 0.0
            if found >= RECALL and crowd <= MOST_MEETING:
                return Model(mean, projection, reach, False)
    return Model(mean, projection, 0, True)


def _fit(sample: DataFrame, threshold: float = THRESHOLD) -> Model:
    """The model from a bounded sample of vectors of one width, learnt in one task."""

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [np.vstack(b["vector"].to_numpy()) for b in batches if len(b)]
        if parts:
            model = settle(unit_rows(np.vstack(parts)), threshold)
            rows = [[float(model.reach), float(model.exact)], model.mean, *model.projection]
            yield pd.DataFrame({"at": range(-2, len(rows) - 2), "row": rows})

    found = sample.repartition(1).mapInPandas(fit, "at int, row array<double>").collect()
    rows = {r["at"]: np.array(r["row"]) for r in found}
    projection = np.array([rows[i] for i in range(len(rows) - 2)])
    return Model(rows[-1], projection, int(rows[-2][0]), bool(rows[-2][1]))


# --- links ------------------------------------------------------------------------------


def near_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    most_homes: int = MOST_HOMES,
    most_lanes: int = MOST_LANES,
) -> DataFrame:
    """Links of every row of ``vectors`` (vec_id, embedding, label: whole number).

    Returns vec_id, n_links, component_id, kept. Rows link when their labels are equal and not
    null and their cosine is at least ``threshold``; ``component_id`` is the smallest vec_id
    reachable. Vectors that are null, empty, zero or hold null or non-finite values link with
    nothing; vectors of different lengths have no cosine, so each length is searched by itself.
    Rows without a vec_id have no component and are not kept. Rows that share a vec_id are
    compared like any others. The rotation of a length is fitted on at most ``sample`` distinct
    vectors, those of least hash; every vector is searched.
    """
    single = isinstance(vectors.schema["embedding"].dataType, ArrayType) and isinstance(
        vectors.schema["embedding"].dataType.elementType, FloatType
    )
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"),
        F.col("label").cast("bigint").alias("label"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("vector", lambda x: x != 0) & F.col("vec_id").isNotNull()
    usable = F.coalesce(usable & F.col("label").isNotNull(), F.lit(False))
    alone = rows.where(~usable).select(
        "vec_id",
        F.lit(0).cast("bigint").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id").isNotNull(), F.lit(False)).alias("kept"),
    )
    valid = rows.where(usable)
    classes = valid.groupBy("label", "vector").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("_size")
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = None
    # Vectors have one length, or few.
    for (width,) in classes.select(F.size("vector")).distinct().collect():
        own = classes.where(F.size("vector") == width)
        some = _links(own, width, threshold, sample, most_homes, most_lanes)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return alone
    found = stored(found, "vector-links")

    sums = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("others"))
    parts = components(found.where("b IS NOT NULL").select("a", "b"))
    members = classes.join(parts, "node", "left").join(
        sums.withColumnRenamed("a", "node"), "node", "left"
    )
    members = stored(
        members.select(
            "label",
            "vector",
            "least",
            F.col("_size").alias("rows"),
            # A vector links with its own copies.
            (F.coalesce("others", F.lit(0)) + F.col("_size") - 1).cast("bigint").alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "vector-members",
    )
    least = members.groupBy("component").agg(
        F.min("least").alias("component_id"), F.count("*").alias("_size")
    )
    named = attach(members, stored(least, "vector-components"), ["component"], ["vector"])
    named = named.select(
        "label", "vector", "n_links", "component_id", F.col("rows").alias("_size")
    )
    met = attach(valid, stored(named, "named-vectors"), ["label", "vector"], ["vec_id"])
    return met.select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    ).unionByName(alone)


def _links(classes, width, threshold, sample, most_homes, most_lanes) -> DataFrame:
    """Sums (a, null, n) and links (a, b, 0) among distinct vectors, named by ``node``."""
    sizes = stored(classes.groupBy("label").agg(F.count("*").alias("_size")), "label-sizes")
    largest = sizes.agg(F.max("_size")).first()[0]
    few = classes.orderBy(F.xxhash64("vector", "label"), "node").limit(sample)
    model = _fit(few.select("vector"), threshold)

    @F.pandas_udf("long")
    def code(vector: pd.Series) -> pd.Series:
        if not len(vector):
            return pd.Series([], dtype="int64")
        return pd.Series(encode(np.vstack(vector.to_numpy()), model.mean, model.projection))

    # The bits that a label is dealt by: none but for very large ones.
    routed = F.lit(0)
    if largest > most_homes * most_lanes and not model.exact:
        routed = _route_bits(F.col("_count") / most_homes, most_lanes, model.reach)
        classes = attach(
            classes, sizes.withColumn("_count", F.col("_size")), ["label"], ["node"]
        )
    coded = classes.withColumns({"code": code("vector"), "routed": routed.cast("byte")})
    coded = stored(coded, "vector-codes")
    spread = coded.withColumn("visit", F.explode(_visits(model.reach))).select(
        "label",
        _bucket().alias("bucket"),
        F.when(F.col("visit.f") < 0, 0).otherwise(1).cast("byte").alias("role"),
        "node",
        F.col("_size").alias("weight"),
        "code",
        "routed",
        "vector",
    )
    lane = ["label", "bucket", "lane"]
    sent = _lanes(spread, most_homes).repartition(*lane).sortWithinPartitions(*lane, "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for linked in _searched(batches, width, threshold, model):
            yield from _summed(*linked)

    return sent.mapInArrow(compare, "a long, b long, n long")


def _route_bits(lanes: Column, most_lanes: int, reach: int) -> Column:
    """Low bits that leave about a lane a bucket; none where fewer lanes than ``most_lanes``, or
    than the buckets that a visitor would go to, serve as well. Both bring the same pairs."""
    bits = F.least(F.ceil(F.log2(lanes)).cast("int"), F.lit(_PART))
    visits = [_TABLES * sum(comb(b, i) for i in range(reach + 1)) for b in range(_PART + 1)]
    large = lanes > F.greatest(F.lit(most_lanes), F.get(F.lit(visits), bits))
    return F.when(large, bits).otherwise(0)


def _visits(reach: int) -> Column:
    """(table t, flip f) of a row: at home (f = -1) and as a visitor, in the one bucket of a small
    label; else in every table, as a visitor of all buckets up to ``reach`` bits away."""
    whole = F.array(*[F.struct(F.lit(0).alias("t"), F.lit(f).alias("f")) for f in (-1, 0)])
    flips = ", ".join(map(str, _masks(reach).tolist()))
    routes = F.expr(
        f"""flatten(transform(sequence(0, {_TABLES - 1}), t -> transform(
          filter(array(-1, {flips}), f -> f < shiftleft(1, int(routed))),
          f -> named_struct('t', t, 'f', f))))"""
    )
    return F.when(F.col("routed") == 0, whole).otherwise(routes)


def _bucket() -> Column:
    low = f"(shiftright(code, visit.t * {_PART}) & (shiftleft(1, int(routed)) - 1))"
    return F.expr(
        f"int(if(routed = 0, 0, visit.t * {1 << _PART} + ({low} ^ greatest(visit.f, 0))))"
    )


class _Homes:
    """The homes of a lane, with a table of each part once they are all there."""

    def __init__(self):
        self.parts: list[dict[str, np.ndarray]] = []
        self.rows: dict[str, np.ndarray] = {}

    def add(self, rows: dict[str, np.ndarray]) -> None:
        self.parts.append(rows)

    def build(self) -> None:
        if not self.parts:
            return
        joined = [self.rows] if self.rows else []
        joined += self.parts
        self.rows = {k: np.concatenate([p[k] for p in joined]) for k in joined[0]}
        self.parts = []
        parts = _code_parts(self.rows["code"])
        self.order = [np.argsort(p, kind="stable") for p in parts.T]
        edges = np.arange((1 << _PART) + 1)
        self.start = [np.searchsorted(p[o], edges) for p, o in zip(parts.T, self.order, strict=True)]


def _code_parts(code: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(code.astype("<i8")).view("<u2").reshape(-1, _TABLES)


def _masks(reach: int) -> np.ndarray:
    every = np.arange(1 << _PART, dtype=np.uint16)
    return every[np.bitwise_count(every) <= reach]


def _searched(batches, width: int, threshold: float, model: Model):
    """(homes, visitors, home numbers, visitor numbers) of linked pairs, some at a time.

    Rows come sorted by lane with homes first. A lane's homes are kept, visitors pass by.
    """
    masks, lane, homes = _masks(model.reach), None, _Homes()
    for batch in batches:
        if not batch.num_rows:
            continue
        names = ("label", "bucket", "lane", "role", "node", "weight", "code", "routed")
        rows = {c: batch[c].to_numpy() for c in names}
        values = batch["vector"].flatten().to_numpy(zero_copy_only=False)
        rows["vector"] = unit_rows(values.reshape(-1, width))
        changed = np.zeros(batch.num_rows, bool)
        for c in ("label", "bucket", "lane", "role"):
            changed[1:] |= rows[c][1:] != rows[c][:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = {k: v[a:b] for k, v in rows.items()}
            here = tuple(int(own[c][0]) for c in ("label", "bucket", "lane"))
            if here != lane:
                lane, homes = here, _Homes()
            if own["role"][0] == 0:
                homes.add(own)
                continue
            homes.build()
            if not homes.rows:
                continue
            for at in range(0, b - a, _VISITORS):
                some = {k: v[at : at + _VISITORS] for k, v in own.items()}
                yield from _linked(homes, some, threshold, model, masks)


def _linked(homes: _Homes, some: dict, threshold: float, model: Model, masks: np.ndarray):
    """Linked pairs of some visitors with the homes of their lane."""
    count, visitors = len(homes.rows["node"]), len(some["node"])
    # A bucket of a label that is dealt by codes answers for its own table only.
    tables = [int(some["bucket"][0]) >> _PART] if some["routed"][0] else range(_TABLES)
    probes = [] if model.exact else [(t, *_probe(homes, some, t, masks)) for t in tables]
    met = sum(int(n.sum()) for *_, n in probes)
    if model.exact or met > MOST_MEETING * count * visitors:
        # Most homes meet the visitors, so products of whole blocks cost less than pairs.
        step = max(1, 4_000_000 // count)
        for at in range(0, visitors, step):
            part = {k: v[at : at + step] for k, v in some.items()}
            cosine = part["vector"] @ homes.rows["vector"].T
            v, h = np.nonzero(cosine >= threshold - 1e-9)
            if not model.exact:
                differ = homes.rows["code"][h] ^ part["code"][v]
                own = np.isin(_first_table(differ, model.reach), tables)
                v, h = v[own], h[own]
            yield from _reranked(homes, part, h, v, threshold)
        return
    found_h, found_v = [], []
    for t, low, n in probes:
        at = np.repeat(np.arange(visitors), n.sum(axis=1))
        first, length = low.ravel(), n.ravel()
        before = np.cumsum(length) - length
        place = np.repeat(first - before, length) + np.arange(int(length.sum()))
        h = homes.order[t][place]
        if t:
            # Others have met in a table before.
            differ = homes.rows["code"][h] ^ some["code"][at]
            new = _first_table(differ, model.reach) == t
            h, at = h[new], at[new]
        found_h.append(h)
        found_v.append(at)
    yield from _reranked(homes, some, np.concatenate(found_h), np.concatenate(found_v), threshold)


def _probe(homes: _Homes, some: dict, t: int, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in a table the homes near each visitor begin, and how many there are."""
    near = (_code_parts(some["code"])[:, t, None] ^ masks[None, :]).astype(np.int64)
    low = homes.start[t][near]
    return low, homes.start[t][near + 1] - low


def _reranked(homes: _Homes, some: dict, home: np.ndarray, visitor: np.ndarray, threshold: float):
    """The pairs whose cosine, in double precision, reaches the threshold."""
    rows = homes.rows
    wanted = rows["node"][home] != some["node"][visitor]
    home, visitor = home[wanted], visitor[wanted]
    for at in range(0, len(home), _PAIRS):
        h, v = home[at : at + _PAIRS], visitor[at : at + _PAIRS]
        cosine = np.einsum("ij,ij->i", rows["vector"][h], some["vector"][v])
        linked = cosine >= threshold
        if linked.any():
            yield rows, some, h[linked], v[linked]


def _summed(rows: dict, some: dict, home: np.ndarray, visitor: np.ndarray):
    """Weights linked to each home, and as few links as connect the same vectors."""
    homes, of = np.unique(home, return_inverse=True)
    sums = np.bincount(of, weights=some["weight"][visitor]).astype(np.int64)
    yield _batch(rows["node"][homes], None, sums)
    node, root = local_stars(rows["node"][home], some["node"][visitor])
    yield _batch(node, root, np.zeros(len(node), np.int64))


def _batch(a, b, n) -> pa.RecordBatch:
    second = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
    return pa.RecordBatch.from_arrays([pa.array(a), second, pa.array(n)], ["a", "b", "n"])


def _lanes(spread: DataFrame, most_homes: int) -> DataFrame:
    """Split buckets with many homes: homes are dealt over lanes, visitors go to each lane."""
    homes = spread.where("role = 0").groupBy("label", "bucket").agg(F.count("*").alias("n"))
    crowded = homes.where(F.col("n") > most_homes).select(
        F.col("label").alias("_label"),
        F.col("bucket").alias("_bucket"),
        F.ceil(F.col("n") / most_homes).cast("int").alias("_lanes"),
    )
    crowded = stored(crowded, "crowded-buckets")
    if crowded.isEmpty():
        return spread.withColumn("lane", F.lit(0))
    met = spread.join(
        crowded,
        (F.col("label") == F.col("_label")) & (F.col("bucket") == F.col("_bucket")),
        "left",
    ).withColumn("_lanes", F.coalesce("_lanes", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("node", "code"), F.col("_lanes")).cast("int"))
    every = F.sequence(F.lit(0), F.col("_lanes") - 1)
    lane = F.explode(F.when(F.col("role") == 0, own).otherwise(every))
    return met.withColumn("lane", lane).drop("_label", "_bucket", "_lanes")
