"""Toxicity by subword bags: averaged n-gram embeddings under a linear softmax.

A word stands for its character n-grams, with marks at both ends, and for itself, all hashed
into buckets with a vector each. A text is the average of the vectors of all its words' n-grams;
a linear layer and a softmax give the probability of the label. Vectors and layer are trained
together. A misspelt word shares most of its n-grams, and so most of its vector, with the word.

All labels of the sample are learnt from. Toxic words differ by language and are rare in some, so
a label that a model of the other labels contradicts is more often a rare word than a wrong label.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable
from functools import cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.labelled import fit_in_task, held_out, training_sample
from strata.llm.tokens import Known

# At most so many labelled documents of the larger class are learnt from, of the other at that rate.
PER_CLASS = 10_000
BUCKETS = 1 << 17
WIDTH = 8
EPOCHS = 8
# A small sample is gone over more often, until it has made so many steps.
LEAST_STEPS = 1_200
BATCH = 32
RATE = 0.3
# Averages are small numbers, so they enter the linear layer scaled by this.
SCALE = 100.0
# Buckets that fewer training documents than this touch keep a zero vector.
LEAST_DOCUMENTS = 5
# Every text has so many n-grams with a zero vector besides its own, so that few words are not
# taken for much evidence.
PADDING = 100
THRESHOLD = 0.5
NGRAMS = (3, 4, 5)

_WORD = re.compile(r"\w+")
_WORDS_KNOWN = 100_000
_LONGEST_KNOWN = 40
# Characters of text whose new words are hashed together; a longer text is taken alone.
_CHARS_AT_ONCE = 1_000_000
# Runs of more bytes are hashed one by one.
_BYTES_TOGETHER = 64
# Fixed value: the reflected polynomial of crc32.
_POLYNOMIAL = 0xEDB88320


@cache
def _crc_table() -> np.ndarray:
    """What a byte makes of a crc32, from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(_POLYNOMIAL), np.uint32(0))
    return table


def crc32s(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of many runs of bytes, the k-th byte of all runs at once."""
    table, size = _crc_table(), end - start
    out = np.full(len(start), 0xFFFFFFFF, np.uint32)
    for k in range(min(int(size.max(initial=0)), _BYTES_TOGETHER)):
        live = np.flatnonzero(size > k)
        crc = out[live]
        out[live] = table[(crc ^ raw[start[live] + k]) & np.uint32(255)] ^ (crc >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > _BYTES_TOGETHER):
        out[i] = zlib.crc32(raw[start[i] : end[i]])
    return out


def buckets(found: list[str], size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of some words, and the number of the word that each belongs to.

    A word has its n-grams between end marks, those that fit, and the whole of it.
    """
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = "".join([f"<{w}>" for w in found])
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    # Where each character begins, and the end.
    char = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))
    length = np.fromiter(map(len, found), np.int64, len(found)) + 2
    last = np.cumsum(length)
    own = np.repeat(np.arange(len(found)), length)
    left = last[own] - np.arange(len(own))
    codes, owners = [crc32s(raw, char[last - length], char[last])], [np.arange(len(found))]
    for n in NGRAMS:
        at = np.flatnonzero(left >= n)
        codes.append(crc32s(raw, char[at], char[at + n]))
        owners.append(own[at])
    return (np.concatenate(codes) % np.uint32(size)).astype(np.int64), np.concatenate(owners)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


# --- training ---------------------------------------------------------------------------


def train(texts: list[str], labels: np.ndarray, *, seed: int = 11) -> dict[str, np.ndarray]:
    """Weight of each bucket and the bias: the layer is linear, so its product with the vectors
    is all that scoring needs. Labels of one class only, or none, give a constant score."""
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        bias = np.array([20.0 if share else -20.0])
        return {"weights": np.zeros(BUCKETS, np.float32), "bias": bias}
    bags = [_bag(t) for t in texts]
    touched = np.zeros(BUCKETS, np.int64)
    for ids, _ in bags:
        touched[ids] += 1
    used = np.flatnonzero(touched >= LEAST_DOCUMENTS)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    for i, (ids, part) in enumerate(bags):
        kept = place[ids] >= 0
        bags[i] = place[ids][kept], part[kept]

    line, bias = _descend(bags, labels, np.arange(len(bags)), len(used), EPOCHS, seed)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = line
    return {"weights": weights, "bias": np.array([bias])}


def _descend(bags, labels, chosen, n: int, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Train vectors and layer on the chosen texts: weight of each vector, and the bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.01, (n, WIDTH)).astype(np.float32)
    layer = rng.normal(0, 0.5, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full(a.shape, 1e-6, np.float32) for a in (vectors, layer, bias)]
    epochs = max(epochs, -(-LEAST_STEPS * BATCH // max(len(chosen), 1)))
    # The texts of a step as rows over all vectors, empty again after it.
    grid = np.zeros((BATCH, n), np.float32)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(chosen)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            rows = grid[: len(some)]
            for row, i in zip(rows, some, strict=True):
                row[bags[i][0]] = bags[i][1] * SCALE
            _step(vectors, layer, bias, seen, rows, labels[some], rate)
            for row, i in zip(rows, some, strict=True):
                row[bags[i][0]] = 0
    return vectors @ (layer[:, 1] - layer[:, 0]) * SCALE, float(bias[1] - bias[0])


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets and the share of each in its average."""
    counts = Counter(words(text))
    ids, owner = buckets(list(counts))
    often = np.fromiter(counts.values(), np.int64, len(counts))[owner]
    total = np.bincount(ids, often, BUCKETS)
    used = np.flatnonzero(total)
    share = total[used] / (often.sum() + PADDING)
    return used.astype(np.int32), share.astype(np.float32)


def _step(vectors, layer, bias, seen, rows, labels, rate) -> None:
    """One step of Adagrad over some texts, all parameters at once."""
    hidden = rows @ vectors
    logits = hidden @ layer + bias
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    error = odds / odds.sum(axis=1, keepdims=True)
    error[np.arange(len(rows)), labels] -= 1
    error /= len(rows)
    slopes = (rows.T @ (error @ layer.T), hidden.T @ error, error.sum(0))
    for weights, slope, past in zip((vectors, layer, bias), slopes, seen, strict=True):
        past += slope**2
        weights -= rate * slope / np.sqrt(past)


# --- scoring ----------------------------------------------------------------------------


class Scorer:
    """Scores of texts under a trained model, each distinct word looked up once for a while."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self._weights = weights.astype(np.float64)
        self._bias = float(bias[0])
        # A word's sum of weights, and its number of n-grams as the imaginary part: one sum
        # over a text's words then gives both.
        self._known = Known(_WORDS_KNOWN)

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        out, run, size = [], [], 0
        for text in texts:
            run.append(text or "")
            size += len(run[-1])
            if size >= _CHARS_AT_ONCE:
                out += self._run(run)
                run, size = [], 0
        logits = np.array(out + self._run(run), np.float64)
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))

    def _run(self, texts: list[str]) -> list[float]:
        found = [words(t) for t in texts]
        # What is remembered may be replaced as words are met, so the run keeps what it needs.
        known, young, now = self._known, self._known.young, {}
        missing = []
        for word in set().union(*found).difference(young):
            value = known.older(word)
            if value is None:
                missing.append(word)
            else:
                now[word] = value
        now.update(zip(missing, self._values(missing), strict=True))
        logits = []
        for own in found:
            values = list(map(young.get, own))
            if None in values:
                values = [now[w] if v is None else v for w, v in zip(own, values, strict=True)]
            total = sum(values)
            logits.append(self._bias + (total.real / (total.imag + PADDING) if own else 0.0))
        for word in missing:
            if len(word) <= _LONGEST_KNOWN:
                known.put(word, now[word])
        return logits

    def _values(self, found: list[str]) -> list[complex]:
        ids, owner = buckets(found)
        sums = np.bincount(owner, self._weights[ids], len(found))
        return (sums + 1j * np.bincount(owner, minlength=len(found))).tolist()


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict[str, np.ndarray]:
    """Train on documents that ``labels`` marks (toxic 0 or 1), none of the held-out fold."""
    return fit_in_task(training_sample(docs, labels, "toxic", per_class), train)


def score(docs: DataFrame, model: dict[str, np.ndarray]) -> Column:
    """The probability of toxicity of the whole ``text`` of ``docs``, empty if null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scorer = partial(_scorer, uuid.uuid4().hex, shared)

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series(scorer().scores(text), dtype="float64")

    return scored(F.col("text"))


_scorers: dict[str, Scorer] = {}


def _scorer(name: str, shared) -> Scorer:
    """The worker's scorer for a model, kept while that model is in use."""
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = Scorer(**shared.value)
    return _scorers[name]


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.5) for every row of ``docs``.

    A missing or empty text has the model's prior; repeated rows have equal scores. Without
    labelled rows of both classes every score is that of the class there is, of none 0.
    """
    scored = docs.select("doc_id", score(docs, fit(docs, labels, per_class)).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they were.

    The score is part of the filter and never a column, so no name can clash with it.
    """
    return docs.where(score(docs, model) < THRESHOLD)
