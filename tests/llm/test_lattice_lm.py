import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vendora.llm import lattice_lm as L
from vendora.llm.queries import QUERIES

PATH = public_tokenizers.path(L.VOCABULARY)
V = L.pieces(PATH)
NUMBER = {t: i for i, t in enumerate(V.texts)}


def segmentations(text):
    if not text:
        yield []
    for k in range(1, min(V.longest, len(text)) + 1):
        if text[:k] in NUMBER:
            for rest in segmentations(text[k:]):
                yield [NUMBER[text[:k]], *rest]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="theiré中", min_size=1, max_size=4), min_size=1, max_size=5))
def test_lattice_sums_all_segmentations(words):
    lattice = L.Lattice(pa.array(words), V)
    totals = lattice.total(lattice.forward(V.first))
    uses = np.zeros(len(V.first))
    for w, total in zip(words, totals, strict=True):
        weights = [(sum(V.first[i] for i in s), s) for s in segmentations(b" " + w.encode())]
        p = sum(math.exp(x) for x, _ in weights)
        assert total == pytest.approx(math.log(p), rel=1e-9)
        for x, s in weights:
            np.add.at(uses, s, math.exp(x) / p)
    assert np.allclose(lattice.expected(V.first), uses)


def test_long_words_and_no_words():
    lattice = L.Lattice(pa.array(["ab" * 20_000, "x"]), V)
    found = lattice.total(lattice.forward(V.first))
    assert np.isfinite(found).all() and found[0] < -1e4
    empty = L.Lattice(pa.array([], pa.string()), V)
    assert len(empty.total(empty.forward(V.first))) == 0 and empty.expected(V.first).sum() == 0


def slow(docs, held_out, rounds=L.ROUNDS):
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "")) for k, (_, t) in enumerate(docs)}
    c, ends = Counter(), 0
    for k, (i, _) in enumerate(docs):
        if not held_out(i):
            c.update(words[k])
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    logp, first = V.first, np.exp(V.first)
    for _ in range(rounds):
        uses = np.zeros(len(first))
        for w in c:
            uses += L.Lattice(pa.array([w]), V).expected(logp)
        logp = np.log((uses + L.PRIOR * first) / (uses.sum() + L.PRIOR))
    once, twice = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
    d = once / (once + 2 * twice) if once and twice else 0.5
    p_end = math.exp(logp[-1])
    begins = sum(math.exp(logp[i]) for t, i in NUMBER.items() if t[:1] == b" ")

    def p(count, spelled):
        return max(count - d, 0) / n + d * v / n * spelled if n else spelled

    rows = []
    for k, (i, _) in enumerate(docs):
        spelled = {}
        for w in set(words[k]):
            lattice = L.Lattice(pa.array([w]), V)
            spelled[w] = math.exp(lattice.total(lattice.forward(logp))[0])
        score = sum(math.log10(p(c[w], spelled[w])) for w in words[k]) + math.log10(p(ends, p_end / (p_end + begins)))
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words[k]) + math.log10((ends + 1) / (n + v + 1))
        rows.append((i, bool(held_out(i)), len(words[k]) + 1, sum(c[w] > 0 for w in words[k]) + (ends > 0), n, base, score))
    return rows


def same(got, want):
    got, want = (sorted((tuple(r) for r in x), key=str) for x in (got, want))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want])


DOCS = [(1, "The cat sat on the mat"), (1, "The cat sat on the mat"), (2, None), (3, ""), (None, "A cat"), (4, "Élan vital 中文 x"), (5, "unseen mat zzz"), (6, "the " * 3000)]


@pytest.mark.parametrize("block", [L.BLOCK_BYTES, 10])
def test_equals_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    df = spark.createDataFrame([(*d, "k") for d in DOCS], "doc_id long, text string, word string")
    same(L.score(df, F.col("doc_id").isin(5, 6)).collect(), slow(DOCS, lambda i: i in (5, 6)))


def test_nothing_to_learn_and_no_rows(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    same(L.score(df, F.lit(True)).collect(), slow(DOCS, lambda i: True))
    assert L.score(df.filter(F.lit(False)), F.lit(False)).count() == 0


def test_query_counts_and_base(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op1_lattice_lm"](spark, sf).collect()
    want = slow(docs, lambda i: zlib.crc32(str(i).encode()) % 7 == 2, 0)
    got, want = sorted(map(tuple, got)), sorted(want)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    assert all(g[6] < 0 for g in got)
