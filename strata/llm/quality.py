"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Terms are hashed byte trigrams and three marks of a text's shape: how much of it repeats, how
much is upper case and how much is neither letter nor blank. Weighted by rarity and length they
make the term-document matrix of a bounded labelled sample; its leading singular vectors span
the latent space. Every document is projected into it and compared with all labelled vectors,
which are broadcast: exact cosines, in blocks. The nearest vote for their label with their
similarity as weight.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.labelled import fit_in_task, held_out, training_sample

# At most so many labelled documents of the larger class are broadcast, of the other at that rate.
PER_CLASS = 3_000
TERMS = 1 << 12
LATENT = 32
NEIGHBOURS = 15
THRESHOLD = 0.3
# Without any labelled row.
NO_OPINION = 0.5

_MARKS = 3
# Weight of a mark against a text's trigrams, whose weights have norm 1.
_MARK_WEIGHT = 1.5
_BLOCK = 256
# Decimal places of a cosine; single-precision sums are good for about six.
_PLACES = 5
_BYTES_AT_ONCE = 1 << 20


# --- terms ------------------------------------------------------------------------------


def term_rows(texts: list[str | None]) -> np.ndarray:
    """Texts by terms: dampened counts of hashed byte trigrams of the whole text, then marks."""
    out = np.zeros((len(texts), TERMS + _MARKS), np.float32)
    for i, text in enumerate(texts):
        text = text or ""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        counts = np.zeros(TERMS, np.int64)
        for at in range(0, max(len(raw) - 2, 0), _BYTES_AT_ONCE):
            part = raw[at : at + _BYTES_AT_ONCE + 2].astype(np.uint32)
            code = part[:-2] * 0x9E3779B1 + part[1:-1] * 0x85EBCA6B + part[2:] * 0xC2B2AE35
            counts += np.bincount((code >> 20).astype(np.int64), minlength=TERMS)
        out[i, :TERMS] = np.log1p(counts)
        out[i, TERMS:] = _marks(text, raw)
    return out


def _marks(text: str, raw: np.ndarray) -> tuple[float, float, float]:
    size = max(len(raw), 1)
    upper = np.count_nonzero((raw >= 65) & (raw <= 90)) / size
    plain = ((raw | 32) >= 97) & ((raw | 32) <= 122) | (raw >= 128) | (raw <= 32)
    other = 1 - np.count_nonzero(plain) / size
    return _repeated(text), min(upper * 2, 1.0), min(other * 4, 1.0)


def _repeated(text: str) -> float:
    """The share of words that begin a run of three met before in the text, or double another.

    Words and runs are compared by 64-bit hashes, so a long text takes eight bytes a word.
    """
    found = text.split()
    if not found:
        return 0.0
    word = np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)
    runs = word[:-2] * np.uint64(0x9E3779B97F4A7C15)
    runs = (runs ^ word[1:-1]) * np.uint64(0xD6E8FEB86659FD93) ^ word[2:]
    again = len(runs) - len(np.unique(runs))
    doubled = int(np.count_nonzero(word[1:] == word[:-1]))
    return max(again, min(2 * doubled, len(word))) / len(word)


def _weighted(rows: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Trigram weights of norm 1 beside the weighted marks."""
    terms = rows[:, :TERMS] * rarity
    norm = np.linalg.norm(terms, axis=1, keepdims=True)
    marks = rows[:, TERMS:] * np.float32(_MARK_WEIGHT)
    return np.hstack([terms / np.maximum(norm, 1e-9), marks])


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.maximum(norm, 1e-9)).astype(np.float32)


# --- the model --------------------------------------------------------------------------


def train(texts: list[str], labels: np.ndarray, *, seed: int = 5) -> dict[str, np.ndarray]:
    """Rarity of terms, latent axes, and the labelled documents as unit vectors in them."""
    if not len(texts):
        empty = np.zeros((0, LATENT), np.float32)
        axes = np.zeros((TERMS + _MARKS, LATENT), np.float32)
        return {
            "rarity": np.ones(TERMS, np.float32),
            "axes": axes,
            "vectors": empty,
            "labels": labels,
        }
    rows = term_rows(texts)
    spread = (rows[:, :TERMS] > 0).sum(axis=0)
    rarity = np.log((1 + len(rows)) / (1 + spread)).astype(np.float32) + 1
    matrix = _weighted(rows, rarity)
    # Randomised subspace iteration towards the leading right singular vectors.
    rng = np.random.default_rng(seed)
    axes = rng.standard_normal((matrix.shape[1], LATENT + 8)).astype(np.float32)
    for _ in range(6):
        axes = np.linalg.qr(matrix.T @ (matrix @ axes))[0]
    small = matrix @ axes
    _, turn = np.linalg.eigh(small.T @ small)
    axes = (axes @ turn[:, ::-1][:, :LATENT]).astype(np.float32)
    return {"rarity": rarity, "axes": axes, "vectors": _unit(matrix @ axes), "labels": labels}


def vote(model: dict[str, np.ndarray], texts: list[str | None]) -> np.ndarray:
    """The score of each text: its nearest labelled vectors' labels, weighted by similarity.

    Cosines count to five places; neighbours at equal ones are taken in the order of the sample.
    Every block has the same shape, so a text's cosines do not depend on the texts beside it.
    Where no neighbour has a positive cosine, as for an empty text, all labelled rows vote alike.
    """
    vectors, labels = model["vectors"], model["labels"].astype(np.float64)
    if not len(labels):
        return np.full(len(texts), NO_OPINION)
    out = np.empty(len(texts))
    k = min(NEIGHBOURS, len(labels))
    for at in range(0, len(texts), _BLOCK):
        some = texts[at : at + _BLOCK]
        rows = np.zeros((_BLOCK, TERMS + _MARKS), np.float32)
        rows[: len(some)] = term_rows(some)
        own = _unit(_weighted(rows, model["rarity"]) @ model["axes"])
        cosine = np.round((own @ vectors.T)[: len(some)], _PLACES)
        least = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
        above, equal = cosine > least, cosine == least
        places = k - above.sum(axis=1, keepdims=True)
        chosen = above | equal & (np.cumsum(equal, axis=1) <= places)
        weight = np.where(chosen, np.maximum(cosine, 0), 0).astype(np.float64)
        # Sums go in the order of the sample, whatever else is in the block.
        total, votes = weight.sum(axis=1), (weight * labels).sum(axis=1)
        alike = np.full(len(some), labels.mean())
        out[at : at + _BLOCK] = np.divide(votes, total, out=alike, where=total > 0)
    return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict[str, np.ndarray]:
    """Learn from documents that ``labels`` marks (quality 0 or 1), none of the held-out fold."""
    return fit_in_task(training_sample(docs, labels, "quality", per_class), train)


def score(docs: DataFrame, model: dict[str, np.ndarray]) -> Column:
    """The weighted vote on the whole ``text`` of ``docs``, empty if null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    votes = partial(_votes, shared)

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series(votes(text.tolist()), dtype="float64")

    return scored(F.col("text"))


def _votes(shared, texts: list[str | None]) -> np.ndarray:
    return vote(shared.value, texts)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.3) for every row of ``docs``.

    A missing text is empty; an empty one has no direction, so all labelled rows vote on it
    alike. Repeated rows have equal scores. Without labelled rows every score is one half.
    """
    scored = docs.select("doc_id", score(docs, fit(docs, labels, per_class)).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_poor(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were.

    The score is part of the filter and never a column, so no name can clash with it.
    """
    return docs.where(score(docs, model) >= THRESHOLD)
