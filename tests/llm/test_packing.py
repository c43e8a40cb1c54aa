import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vendora.llm import packing as P
from vendora.llm.queries import QUERIES

PATH = public_tokenizers.path(P.TOKENIZER)
TOK = Tokenizer.from_file(PATH)
SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "a", "'s", "\n"]), max_size=6).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \t\n\r\x0b\x0c  'sveé中😀٣²_a1", max_size=40))
def test_ids_equal_the_tokenizer(text):
    assert P.encoder(PATH).encode_ordinary(text) == TOK.encode(text, add_special_tokens=False).ids


def test_cuts():
    assert P.cuts(1, 4) == [(0, 1)] and P.cuts(4, 4) == [(0, 4)]
    assert P.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)] and P.cuts(8, 4) == [(0, 4), (4, 4)]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 50), max_size=24))
def test_plan_is_whole_and_fits(counts):
    groups = P.plan(counts, 24)
    seen = {}
    for m, runs in groups:
        assert m > 0 and 0 < sum(n * t for n, t in runs) <= 24
        assert sum(t for n, t in runs if 3 * n > 24) <= 2
        for n, t in runs:
            seen[n] = seen.get(n, 0) + m * t
    assert seen == counts


def test_plan_is_close_to_the_bound():
    rng = random.Random(2)
    counts = {}
    for _ in range(20_000):
        n = min(2048, int(rng.lognormvariate(6, 1.2)) + 1)
        counts[n] = counts.get(n, 0) + 1
    groups = P.plan(counts)
    bound = -(-sum(n * c for n, c in counts.items()) // 2048)
    assert sum(m for m, _ in groups) <= 1.02 * bound
    assert len(P.slots(groups)) < 8 * 2048


def check(rows, texts):
    by_doc = {}
    for i, t in texts:
        ids = TOK.encode(t or "", add_special_tokens=False).ids + [0]
        for k, (s, n) in enumerate(P.cuts(len(ids), P.CAPACITY)):
            crc = zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())
            by_doc.setdefault((i, k, s, n, crc), 0)
            by_doc[(i, k, s, n, crc)] += 1
    got = {}
    for r in rows:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
    assert got == by_doc
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in bins.values():
        end = 0
        for offset, n in sorted(v):
            assert offset == end
            end += n
        assert end <= P.CAPACITY
    total = sum(r.length for r in rows)
    return len(bins), -(-total // P.CAPACITY)


def test_operator_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET", 3)
    texts = [(1, "hello world"), (1, "hello world"), (2, None), (3, ""), (None, "x"), (4, "word " * 9000), (5, "a")]
    texts += [(10 + i, f"copy {i % 2}") for i in range(40)] + [(6, "<|endoftext|>")]
    df = spark.createDataFrame([(*t, 7) for t in texts], "doc_id long, text string, length int")
    check(P.pack(df).collect(), texts)
    assert P.pack(df.filter(F.lit(False))).count() == 0


def test_query_round_trip(spark):
    sf = "/root/testdata/sf0.01"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    used, bound = check(QUERIES["op5_best_fit_packing"](spark, sf).collect(), texts)
    assert used <= 1.01 * bound + 1
