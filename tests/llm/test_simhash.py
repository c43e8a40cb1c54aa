import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vendora.llm import simhash as S
from vendora.llm.queries import QUERIES

WORD = r"[^\x20\x09-\x0D]+"


def slow_fingerprint(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(WORD, low)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """Rows (id, fp) -> {fp: smallest id reachable}, by comparing all pairs."""
    fps = sorted({f for _, f in rows})
    up = list(range(len(fps)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    arr = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 3):
            a, b = find(i), find(int(j))
            up[max(a, b)] = min(a, b)
    least = {}
    for d, f in rows:
        r = find(fps.index(f))
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return {f: least.get(find(i)) for i, f in enumerate(fps)}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 50, 65_537 + 5])
def test_fingerprint(n):
    text = " ".join(f"Word{i % 97}É" for i in range(n))
    if n < 1000:
        assert S.fingerprint(text) == slow_fingerprint(text)
    else:  # blocks join up
        words = text.translate(S.ASCII_LOWER).split()
        h = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(n - 2)], np.uint64)
        bits = [2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h) for b in range(64)]
        assert S.fingerprint(text) == sum(1 << b for b, x in enumerate(bits) if x)


def test_place_reaches_every_partner():
    rng = np.random.default_rng(3)
    points = rng.integers(0, 2**63, 400, dtype=np.uint64)
    nodes = S.grow(points, 5)
    rows, home = S.place(points, nodes, 0)
    assert sorted(rows) == list(range(400))
    own = dict(zip(rows, home, strict=True))
    near = points ^ np.array([(1 << int(a)) | (1 << int(b)) | (1 << int(c)) for a, b, c in rng.integers(0, 64, (400, 3))], np.uint64)
    rows, at = S.place(near, nodes, 3)
    reached = set(zip(rows.tolist(), at.tolist(), strict=True))
    assert all((i, own[i]) in reached for i in range(400))


def linked_by_spark(spark, fps):
    rows = [(i, 0, int(np.uint64(f).astype(np.int64))) for i, f in fps]
    df = S.linked(spark.createDataFrame(rows, "id long, key long, fp long"))
    return {int(np.int64(r.fp).astype(np.uint64)): r.component_id for r in df.collect()}


def test_linked_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(S, "PART", 20)  # shards have several parts
    monkeypatch.setattr(S, "SIDE", 30)  # and their visitors several sides
    rng = random.Random(5)
    rows, i = [(None, 77), (None, 0)], 0
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 12])):  # chains that drift by three bits a step
            rows.append((i := i + 1, f))
            for _ in range(rng.choice([0, 3, 3, 4])):
                f ^= 1 << rng.randrange(64)
    dense = rng.getrandbits(64)
    rows += [(i + k, dense ^ (1 << k % 64) ^ (1 << k // 64 % 64)) for k in range(1, 300)]
    rng.shuffle(rows)
    assert linked_by_spark(spark, rows) == slow_components(rows)


def test_no_group_grows_with_the_points(spark, monkeypatch):
    monkeypatch.setattr(S, "PART", 20)
    monkeypatch.setattr(S, "SIDE", 30)
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    points = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    placed = S.shards(points, S.grow(fps, 3), 3)
    sizes = placed.groupBy("shard", "part", "side").agg(F.count_if("home").alias("n"), F.count_if(~F.col("home")).alias("m")).collect()
    assert max(r.n for r in sizes) < 60 and max(r.m for r in sizes) < 80


def test_operator_on_odd_rows(spark):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(5, t, "a"), (3, t, "b"), (3, t, "b"), (None, t, "c"), (9, None, None), (8, "", "x"), (2, "one Word", "x"), (None, "odd one out here", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect())
    fps = [(i, slow_fingerprint(x)) for i, x, _ in rows]
    comp = slow_components(fps)
    assert got == sorted((str(i), f"{f:016x}", comp[f]) for i, f in fps)
    kept = S.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "8", "2", "None"])
    assert S.near_duplicates(df.filter(F.lit(False))).count() == 0
    assert S.keep_first(df.filter(F.lit(False))).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = [(r.doc_id, slow_fingerprint(r.text)) for r in docs]
    comp = slow_components(fps)
    got = sorted(tuple(r) for r in QUERIES["op6_simhash"](spark, sf).collect())
    assert got == sorted((i, f"{f:016x}", comp[f]) for i, f in fps)
