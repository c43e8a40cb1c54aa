"""Held-out accuracy, and small cases, of the two trained operators."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendora.llm import quality_classifier as Q
from vendora.llm import toxicity as T
from vendora.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def held_out(spark, name, label, by, rest):
    got = {r.doc_id: r for r in QUERIES[name](spark, SF_DIR).collect()}
    docs = [r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()]
    assert sorted(got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % by == rest) and 0 <= r.score <= 1 for i, r in got.items())
    marks = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", label).collect()
    pairs = [(got[i].score, got[i].predicted, y) for i, y in marks if y is not None and got[i].held_out]
    return pairs


def auc(pairs):
    good, bad = [s for s, _, y in pairs if y], [s for s, _, y in pairs if not y]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_quality_on_held_out_labels(spark):
    pairs = held_out(spark, "op7_quality_classifier", "quality", 4, 2)
    assert auc(pairs) > 0.95
    assert np.mean([p == y for _, p, y in pairs]) > 0.93


def test_toxicity_on_held_out_labels(spark):
    pairs = held_out(spark, "op4_toxicity_crf", "toxic", 5, 0)
    assert np.mean([p == y for _, p, y in pairs]) > 0.95


def odd(spark, label):
    docs = [(1, "good words here", "a", 1), (1, "good words here", "a", 1), (2, None, "b", 0), (None, "", "c", 0), (3, "x " * 60_000, "d", 1)]
    docs += [(10 + i, f"fine text number {i} goes on", "e", 1) for i in range(30)]
    docs += [(50 + i, f"bad bad junk number {i} goes {'awful' if i % 2 else 'nasty'} on", "e", 0) for i in range(30)]
    df = spark.createDataFrame(docs, f"doc_id long, text string, score string, {label} int")
    marks = spark.createDataFrame(
        [(i, int(i < 50), "z") for i in [*range(10, 40), *range(50, 80)]] + [(1, None, "z"), (None, 1, "z"), (99, 1, "z"), (2, 7, "z")],
        f"doc_id long, {label} int, text string",
    )
    return df, marks


@pytest.mark.parametrize("run, label", [(Q.classify, "quality"), (T.tag, "toxic")])
def test_odd_rows(spark, run, label):
    df, marks = odd(spark, label)
    got = run(df, marks).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    twice = [r.score for r in got if r.doc_id == 1]
    assert twice[0] == twice[1]
    assert run(df.filter(F.lit(False)), marks).count() == 0
    assert len({r.score for r in run(df, marks.filter(F.lit(False))).collect()}) == 1
    assert len({r.score for r in run(df, marks.filter(f"{label} = 1")).collect()}) >= 1


def test_learns_and_ignores_other_labels(spark):
    df, marks = odd(spark, "quality")
    got = {r.doc_id: r.score for r in Q.classify(df, marks).collect()}
    assert min(got[i] for i in range(10, 40)) > max(got[i] for i in range(50, 80))
    none = Q.classify(df, marks, learn=F.lit(False)).collect()
    assert {r.score for r in none} == {0.5}


def test_score_is_the_sparse_dot_product():
    h, w = Q.Hasher(Q.WIDTH), np.random.default_rng(1).normal(size=1 << Q.WIDTH)
    f = h.features("a b c a b c, d!")
    dense = np.bincount(f, minlength=1 << Q.WIDTH) * Q.SCALE / len(f)
    dense[0] += 1
    assert Q.score(w, f) == pytest.approx(1 / (1 + np.exp(-dense @ w)))
    assert Q.score(w, h.features(None)) == pytest.approx(1 / (1 + np.exp(-w[0])))


def by_enumeration(e, model):
    """Marginals and expected steps over all state sequences of one chain."""
    n, total = len(e), 0.0
    p, steps = np.zeros(n), np.zeros(3)
    for code in range(2**n):
        s = [code >> i & 1 for i in range(n)]
        v = model.start * s[0] + sum(e[i] * s[i] for i in range(n))
        kinds = [{(0, 1): 0, (1, 0): 1, (1, 1): 2}.get(x) for x in zip(s, s[1:], strict=False)]
        v = np.exp(v + sum(model.steps[k] for k in kinds if k is not None))
        total += v
        p += v * np.array(s)
        for k in kinds:
            if k is not None:
                steps[k] += v
    return p / total, steps / total


def test_passes_equal_enumeration():
    rng = np.random.default_rng(5)
    model = T.Field(start=0.3, steps=(0.5, -0.7, 1.1))
    sizes = [1, 5, 0, 3, 7]
    e = np.concatenate([np.append(rng.normal(size=n), np.nan) for n in sizes])
    ends = np.isnan(e)
    p, expected = T.passes(np.where(ends, 0, e), *T.chains(ends), model, (~ends).astype(float))
    at, total = 0, np.zeros(3)
    for n in sizes:
        if n:
            q, steps = by_enumeration(e[at : at + n], model)
            assert np.allclose(p[at : at + n], q)
            total += steps
        at += n + 1
    assert np.allclose(expected, total)


def test_spans_point_at_the_words(spark):
    rng = random.Random(1)
    clean = [f"w{rng.randrange(40)}" for _ in range(4000)]
    rows, marks = [], []
    for i in range(160):
        words = rng.choices(clean, k=12)
        if i % 2:
            words[rng.randrange(12)] = "Vilest"
            words[rng.randrange(12)] = "vilely"
        rows.append((i, " ".join(words) + "."))
        marks.append((i, i % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = T.tag(df, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
    texts = dict(rows)
    for r in got:
        assert (r.score >= 0.5) == bool(r.doc_id % 2)
        assert all(texts[r.doc_id][s.start : s.end].lower().startswith("vile") for s in r.spans)
        assert bool(r.spans) == bool(r.doc_id % 2)


def test_bound_holds_for_repeated_labels(spark):
    """One id holds a third of all label rows, and of all documents."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(2000)] + [(7, "text 7"), (7, "text 6")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(1300)] + [(7, 1)] * 700 + [(8, 1), (9, 0), (None, 1), (5000, 1)], "doc_id long, quality int"
    )
    whole = Q.labelled_texts(docs, labels, "quality", F.lit(True), 5000).collect()
    # Id 8 has two labels that disagree, id 9 too.
    assert sorted(map(tuple, whole)) == sorted((f"text {i}", i % 2) for i in range(1300) if i not in (8, 9))
    chosen = Q.labelled_texts(docs, labels, "quality", F.lit(True), 100).collect()
    assert 60 < len(chosen) < 140 and len(set(chosen)) == len(chosen)


def test_bytes_of_the_sample_are_bounded(spark):
    rows = [(i, "word " * (1 + i % 50)) for i in range(800)] + [(900, "long " * 100_000), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    held = lambda df: sum(len(r.text) for r in df.collect())
    most = 64 * 300
    bounded = Q.labelled_texts(docs, labels, "toxic", F.lit(True), 5000, most_bytes=most)
    assert most * 0.95 < held(bounded) <= most
    assert len(Q.labelled_texts(docs, labels, "toxic", F.lit(True), 5000).collect()) == len(rows)
    for run in (Q.classify, T.tag):
        scored = run(docs, labels.withColumnRenamed("toxic", "quality") if run is Q.classify else labels, most_bytes=most)
        assert scored.count() == len(rows)


def plain_ftrl(examples, width, epochs):
    """Follow the regularised leader, one coordinate of one example after the other."""
    z, n = [0.0] * (1 << width), [0.0] * (1 << width)

    def weight(i):
        if abs(z[i]) <= Q.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * Q.L1) / ((Q.BETA + n[i] ** 0.5) / Q.ALPHA + Q.L2)

    for _ in range(epochs):
        for features, label in examples:
            x = {}
            for f in features:
                x[f] = x.get(f, 0.0) + Q.SCALE / len(features)
            x[0] = 1.0
            w = {i: weight(i) for i in x}
            miss = 1 / (1 + np.exp(-sum(w[i] * x[i] for i in x))) - label
            for i, v in x.items():
                sigma = ((n[i] + (miss * v) ** 2) ** 0.5 - n[i] ** 0.5) / Q.ALPHA
                z[i] += miss * v - sigma * w[i]
                n[i] += (miss * v) ** 2
    return [weight(i) for i in range(1 << width)]


def test_training_equals_the_plain_rule():
    rng, h = random.Random(4), Q.Hasher(8)
    texts = [(" ".join(rng.choices("abcdefgh" if y else "efghijkl", k=rng.randrange(1, 9))), y) for y in (0, 1) * 30]
    examples = [(h.features(t), y) for t, y in texts]
    assert np.allclose(Q.train(examples, 8, 2), plain_ftrl(examples, 8, 2))


def test_training_in_small_blocks(monkeypatch):
    """Blocks of a few plain chains give a field that tells the same texts apart."""
    rng = random.Random(6)
    texts = []
    for i in range(240):
        words = [f"w{rng.randrange(60)}" for _ in range(10)]
        if i % 2:
            words[rng.randrange(10)] = "vilest"
            words[rng.randrange(10)] = "vilely"
        texts.append((" ".join(words) + ".", i % 2))
    whole = T.train(texts)
    monkeypatch.setattr(T, "BLOCK", 7)
    blocks = T.train(texts)
    for model in (whole, blocks):
        a, b, c = model.score
        got = [a + b * x + c * z >= 0 for x, z, _ in T.Measure(model).documents([t for t, _ in texts])]
        assert np.mean([g == bool(y) for g, (_, y) in zip(got, texts, strict=True)]) > 0.97
    assert whole.weights.keys() == blocks.weights.keys()
