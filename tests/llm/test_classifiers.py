import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import quality, toxicity
from strata.llm.labelled import held_out, training_sample
from strata.llm.queries import ORACLES, REGISTERED

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def _corpus(n=800):
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(600)]
    docs, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 120))
        poor, toxic = i % 5 == 0, i % 3 == 0
        if toxic and not poor:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["horrible", "nasty", "vile"]))
        text = [w.upper() + "!!" for w in text[:10]] * 5 if poor else text
        docs.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, int(not poor), int(toxic and not poor)))
    return docs, labels


@pytest.fixture(scope="module")
def corpus(spark):
    docs, labels = _corpus()
    extra = [(5000, None, None, None, None), (5001, "", "", "", 0), (None, "words here", "", "", 0)]
    extra += [(5002, "long " * 200_000, "en", "s", 1), docs[0]]
    labels = labels + [(1, 0, 1), (2, None, None), (None, 1, 1), (9999, 1, 1)]
    return spark.createDataFrame(docs + extra, DOCS), spark.createDataFrame(labels, LABELS)


def test_the_held_out_fold(spark):
    ids = spark.createDataFrame([(i,) for i in range(300)], "doc_id long")
    found = ids.select("doc_id", held_out(F.col("doc_id")).alias("out")).collect()
    assert {r.doc_id: r.out for r in found} == {
        i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(300)
    }


def test_samples_are_bounded_and_hold_nothing_that_is_held_out(spark, corpus):
    rows = training_sample(*corpus, "quality", 30).collect()
    assert max(Counter(r.label for r in rows).values()) == 30
    assert all(zlib.crc32(str(r._id).encode()) % 5 for r in rows)
    assert training_sample(*corpus, "toxic", 30).collect() == training_sample(*corpus, "toxic", 30).collect()


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_samples_keep_the_ratio_of_the_classes(spark, corpus, label):
    whole, some = (Counter(r.label for r in training_sample(*corpus, label, n).collect()) for n in (10_000, 60))
    assert max(some.values()) == 60
    assert abs(some[1] / some[0] / (whole[1] / whole[0]) - 1) < 0.1


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy_and_odd_rows(spark, corpus, module, label):
    docs, labels = corpus
    found = module.classify(docs, labels).cache().collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD) for r in found)
    truth = {r.doc_id: r[label] for r in spark.createDataFrame(_corpus()[1], LABELS).collect()}
    judged = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert len(judged) > 50 and sum(a == b for a, b in judged) / len(judged) >= (0.95 if module is quality else 0.9)
    # No labels, and no documents.
    none = module.classify(docs, labels.where("false")).collect()
    assert {r.score for r in none} == ({0.5} if module is quality else {min(r.score for r in none)})
    assert module.classify(docs.where("false"), labels).collect() == []


def test_toxic_documents_are_found_and_clean_ones_kept():
    docs, labels = _corpus()
    out = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in docs])
    truth = np.array([t for *_, t in labels])
    texts = [t for _, t, *_ in docs]
    model = toxicity.train([t for t, o in zip(texts, out, strict=True) if not o], truth[~out])
    scorer = toxicity.Scorer(**model)
    found = np.array([scorer.score(t) >= toxicity.THRESHOLD for t in texts])
    assert found[out & (truth == 1)].mean() >= 0.9
    assert found[out & (truth == 0)].mean() <= 0.12


def test_misspelt_words_share_vectors():
    docs, labels = _corpus()
    texts = [t for _, t, *_ in docs]
    model = toxicity.train(texts, np.array([t for *_, t in labels]))
    scorer = toxicity.Scorer(**model)
    plain = " ".join(texts[1].split()[:40])
    assert scorer.score(plain) < 0.5
    assert scorer.score(plain + " horrrible horible") > scorer.score(plain)


def test_blocks_give_the_cosines_of_single_texts():
    docs, labels = _corpus(120)
    texts = [t for _, t, *_ in docs]
    model = quality.train(texts[:80], np.array([q for _, q, _ in labels[:80]]))
    together = quality.vote(model, texts)
    alone = np.concatenate([quality.vote(model, [t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-4)
    own = quality._unit(quality._weighted(quality.term_rows(texts[80:90]), model["rarity"]) @ model["axes"])
    for vector, text in zip(own, texts[80:90], strict=True):
        cosine = sorted(((float(vector @ v), n) for n, v in enumerate(model["vectors"])), reverse=True)
        weights = [max(c, 0) for c, _ in cosine[:15]]
        votes = [w * model["labels"][n] for w, (_, n) in zip(weights, cosine, strict=False)]
        assert abs(sum(votes) / sum(weights) - quality.vote(model, [text])[0]) < 1e-3


def test_subword_bags_are_those_of_a_plain_average():
    """Buckets, averages, softmax and a training step, each by its definition."""
    def plainly(word):
        marked = f"<{word}>"
        grams = [marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)]
        return sorted(zlib.crc32(g.encode()) % toxicity.BUCKETS for g in [*grams, marked])

    some = ["a", "ab", "horrible", "ñandú", "x" * 50, "\U0001f600", "_"]
    place, owner = toxicity.buckets(some)
    for n, word in enumerate(some):
        assert sorted(place[owner == n].tolist()) == plainly(word)
    rng = np.random.default_rng(2)
    weights, bias = rng.normal(size=toxicity.BUCKETS), np.array([0.3])
    scorer = toxicity.Scorer(weights, bias)
    texts = ["A horrible, horrible ñandú", "", None, "ab " * 3000, "... !"]
    for text, score in zip(texts, scorer.scores(texts), strict=True):
        ids = [b for w in toxicity.words(text or "") for b in plainly(w)]
        logit = bias[0] + sum(weights[i] for i in ids) / (len(ids) + toxicity.PADDING)
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-9
        assert scorer.score(text) == score
    ids, share = toxicity._bag(texts[0])
    counts = Counter(b for w in toxicity.words(texts[0]) for b in plainly(w))
    total = sum(counts.values()) + toxicity.PADDING
    assert dict(zip(ids.tolist(), share.tolist(), strict=True)) == pytest.approx({b: n / total for b, n in counts.items()})


def test_a_step_follows_the_slope_of_the_loss():
    rng = np.random.default_rng(3)
    rows = rng.random((4, 6))
    labels = np.array([0, 1, 1, 0])
    parts = [rng.normal(size=s) for s in ((6, 3), (3, 2), (2,))]

    def loss(vectors, layer, bias):
        logits = rows @ vectors @ layer + bias
        return np.mean(np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(4), labels])

    wanted = []
    for part in parts:
        slope = np.zeros_like(part)
        for at in np.ndindex(*part.shape):
            kept = part[at]
            part[at] = kept + 1e-6
            up = loss(*parts)
            part[at] = kept - 1e-6
            slope[at] = (up - loss(*parts)) / 2e-6
            part[at] = kept
        wanted.append(slope)
    before, seen = [p.copy() for p in parts], [np.full(p.shape, 0.5) for p in parts]
    toxicity._step(*parts, seen, rows, labels, 0.1)
    for old, new, slope in zip(before, parts, wanted, strict=True):
        assert np.allclose(new, old - 0.1 * slope / np.sqrt(0.5 + slope**2), atol=1e-6)


def test_a_small_memory_changes_no_score(monkeypatch):
    docs, _ = _corpus(60)
    texts = [t for _, t, *_ in docs] + [None, ""]
    weights = np.random.default_rng(1).normal(size=toxicity.BUCKETS)
    plain = toxicity.Scorer(weights, np.array([0.0])).scores(texts)
    monkeypatch.setattr(toxicity, "_WORDS_KNOWN", 5)
    monkeypatch.setattr(toxicity, "_CHARS_AT_ONCE", 300)
    assert np.allclose(toxicity.Scorer(weights, np.array([0.0])).scores(texts), plain)


def test_scores_do_not_depend_on_the_texts_beside():
    docs, labels = _corpus(300)
    texts = [t for _, t, *_ in docs]
    model = quality.train(texts[:120] * 2, np.array([q for _, q, _ in labels[:120]] * 2))
    whole = quality.vote(model, texts)
    for size in (1, 7, 256):
        parts = [quality.vote(model, texts[i : i + size]) for i in range(0, len(texts), size)]
        assert (np.concatenate(parts) == whole).all()


def test_repeats_count_over_the_whole_text():
    short, long = (" ".join(f"w{i % n}" for i in range(2 * n)) for n in (100, 20_000))
    assert quality._repeated(short) > 0.48 and quality._repeated(long) > 0.48
    assert quality._repeated(" ".join(f"w{i}" for i in range(40_000))) == 0
    assert quality._repeated("a a a a") == 1 and quality._repeated("") == 0 and quality._repeated("a") == 0


CLASHING = ("_own_score", "Score", "_sha", "_gone", "_size", "_group", "row", "keep", "fp", "component", "blocks")


def test_stages_leave_odd_columns_alone(spark, corpus, tmp_path):
    docs, labels = corpus
    wide = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in CLASHING])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    own = {r.doc_id: tuple(r) for r in wide.collect()}
    kept = wide
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, kept, str(tmp_path)), "odd")
        assert kept.columns == wide.columns
        assert 0 < kept.count()
        assert all(tuple(r) == own[r.doc_id] for r in kept.collect())
    # Null ids, texts and labels came along; an empty table gives no rows.
    (tmp_path / "empty").mkdir()
    docs.where("false").write.parquet(str(tmp_path / "empty" / "documents.parquet"))
    labels.where("false").write.parquet(str(tmp_path / "empty" / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).collect() == []


def test_filters_keep_columns(spark, corpus):
    docs, labels = corpus
    clash = docs.withColumnRenamed("n_chars", "score")
    for kept in (
        quality.drop_poor(clash, quality.fit(docs, labels)),
        toxicity.drop_toxic(clash, toxicity.fit(docs, labels)),
    ):
        assert sorted(kept.columns) == sorted(clash.columns)
        assert 0 < kept.count() < clash.count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, seen[-1], DATA), "stage")
        assert kept.columns == docs.columns
        assert kept.count() < seen[-1].count()
        seen.append(kept)
    scores = {r.doc_id: r for r in quality.classify(docs, spark.read.parquet(f"{DATA}/labels.parquet")).collect()}
    assert {r.doc_id for r in seen[1].collect()} == {i for i, r in scores.items() if r.predicted}
    texts = [r.text for r in seen[3].collect()]
    assert len(texts) == len(set(texts)) == len({r.text for r in seen[2].collect()})
    left = {r.doc_id for r in seen[4].collect()}
    packed = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in packed} == left
    lengths = Counter()
    for r in packed:
        lengths[r.doc_id] += r.length
    assert all(lengths[r.doc_id] == r.doc_tokens for r in packed)


def test_the_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTERED) == list(range(1, 14))
    assert set(ORACLES) <= set(REGISTERED)
