"""Labelled rows for classifiers: a bounded sample for training and the fold that is held out."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo five, is 0."""
    fold = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS
    return fold == 0


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(text, label) of at most ``per_class`` labelled documents of each class, none held out.

    Both classes are taken at one rate, so that their ratio is that of all labels at any size.
    Those of least hash of the id are taken, so that the sample is the same every time. Of rows
    of ``labels`` that share a doc_id the smaller label counts; null labels are left out.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col(label).alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.min("label").cast("int").alias("label"))
        # Labels of no document would only take places.
        .join(docs.select(F.col("doc_id").cast("bigint").alias("_id")), "_id", "left_semi")
    )
    order = (F.xxhash64("_id"), F.col("_id"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    rate = min(1.0, per_class / max(sizes.values(), default=1))
    # A class that is there at all is not rounded away.
    bounds = [min(sizes.get(c, 0), max(1, round(rate * sizes.get(c, 0)))) for c in (0, 1)]
    some = [
        known.where(F.col("label") == c).orderBy(*order).limit(bound)
        for c, bound in enumerate(bounds)
    ]
    chosen = some[0].unionByName(some[1])
    found = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text").join(
        # Bounded: two classes of at most per_class rows.
        F.broadcast(chosen),
        "_id",
    )
    # Rows of ``docs`` that share a doc_id are one here, whichever text is the smallest.
    return found.groupBy("_id", "label").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))


def fit_in_task(
    sample: DataFrame, fit: Callable[[list[str], np.ndarray], dict[str, np.ndarray]]
) -> dict[str, np.ndarray]:
    """Train on a bounded sample in one task of the cluster; the arrays of the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += batch["text"].to_pylist()
            labels += batch["label"].to_pylist()
        out = io.BytesIO()
        np.savez(out, **fit(texts, np.array(labels, np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()])], ["model"])

    ordered = sample.select("text", "label", "_id").repartition(1).sortWithinPartitions("_id")
    row = ordered.mapInArrow(run, "model binary").first()
    if row is None:
        # An empty sample may have no partition at all.
        return fit([], np.zeros(0, np.int64))
    with np.load(io.BytesIO(bytes(row["model"]))) as arrays:
        return dict(arrays)
