import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from vendora.llm import decontamination as D
from vendora.llm.queries import QUERIES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONG = " ".join(f"w{i}" for i in range(14))
ITEMS = [
    (1, LONG), (2, "the the the the"), (3, "Solo"), (4, ""), (5, None), (6, LONG), (6, LONG), (7, "a b a b a b a b a b a b a b"),
    (None, "only here"), (8, "never seen before"), (9, "x y z"),
]
DOCS = [
    (1, "start " + LONG + " end"), (2, "W0, w1! W2 w3 w4 w5 w6 w7 w8 w9 x"), (3, "w0 w1 w2 w3 w4 w5 w6 w7 w8 x w9 w10"),
    (4, "the the the the the solo"), (5, ""), (6, None), (7, "a b " * 40), (8, "only here"), (9, "x then y then z"),
    (1, "start " + LONG + " end"), (1, "solo"), (None, "solo"), (10, ("é " + LONG + " ") * 300), (11, "soloist x y z"),
]


def tokens(t):
    low = "".join(c.lower() if c.isascii() else c for c in t or "")
    return re.findall(WORD, low)


def brute(text, items):
    w, hit, ids = tokens(text), set(), set()
    for item, t in items:
        v = tokens(t)
        n = min(10, len(v))
        found = False
        for s in range(len(v) - n + 1) if v else []:
            for p in range(len(w) - n + 1):
                if w[p : p + n] == v[s : s + n]:
                    hit |= set(range(p, p + n))
                    found = True
        if found and item is not None:
            ids.add(str(item))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(w), len(hit), len(ids), digest, bool(hit)


def frames(spark, docs=DOCS, items=ITEMS):
    return (
        spark.createDataFrame([(*d, "e") for d in docs], "doc_id long, text string, item string"),
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, term int"),
    )


def expected(docs, items):
    return sorted(map(str, [(i, *brute(t, items)) for i, t in docs]))


def found(df):
    return sorted(map(str, [tuple(r)[:6] for r in df.collect()]))


def test_equals_brute_force(spark):
    assert found(D.report(*frames(spark))) == expected(DOCS, ITEMS)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_WORDS", 0)
    assert found(D.report(*frames(spark))) == expected(DOCS, ITEMS)


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert D.report(docs.filter(F.lit(False)), items).count() == 0
    assert found(D.report(docs, items.filter(F.lit(False)))) == expected(DOCS, [])


def test_proximity(spark):
    near = {r.doc_id: r.n_near_items for r in D.report(*frames(spark)).filter("doc_id IN (3, 9)").collect()}
    assert near[9] == 1 and near[3] >= 1


def brute_near(docs, items):
    """Per document the number of items with a proximity match only: the two rarest words of
    a window that any document has stand within five words of their places."""
    known = {w for _, t in items for w in tokens(t)}
    counts = Counter(w for _, t in set(docs) for w in tokens(t) if w in known)
    pairs = set()
    for item, t in items:
        v = tokens(t)
        for s in range(max(0, len(v) - 10) + 1) if v and item is not None else []:
            ranked = sorted((counts[x], s + i, x) for i, x in enumerate(v[s : s + 10]) if counts[x])
            if len(ranked) > 1 or len(ranked) == len(v[s : s + 10]):
                pairs.add((str(item), *[r[1:] for r in (ranked * 2)[:2]]))
    out = []
    for i, t in docs:
        w, at = tokens(t), {}
        for p, x in enumerate(w):
            at.setdefault(x, []).append(p)
        near = {
            item
            for item, (a, x), (b, y) in pairs
            if any(abs(p - a + b - q) <= 5 for p in at.get(x, []) for q in at.get(y, []))
        }
        phrases = {str(item) for item, u in items if item is not None and brute(t, [(item, u)])[2]}
        out.append((i, len(near - phrases)))
    return sorted(map(str, out))


def near_of(df):
    return sorted(map(str, [(r.doc_id, r.n_near_items) for r in df.collect()]))


def near_cases():
    rng = random.Random(9)
    changed = LONG.split()[:10]
    changed[4] = "nowhere"
    items = [*ITEMS, (20, " ".join(changed)), (21, LONG.replace("w3", "unseen")), (22, "unknown solo"), (23, "unknown unheard")]
    items += [(30 + i, " ".join(rng.choice("abcdefghuvwxyz") for _ in range(rng.choice([1, 3, 10, 13])))) for i in range(20)]
    docs = [*DOCS, *[(100 + i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(12)))) for i in range(30)]]
    return docs, items


def test_proximity_equals_brute_force(spark):
    docs, items = near_cases()
    got = D.report(*frames(spark, docs, items))
    assert near_of(got) == brute_near(docs, items)
    assert found(got) == expected(docs, items)


def test_one_rare_word_changed_is_a_proximity_match(spark):
    docs, items = near_cases()
    items = [i for i in items if i[0] in (20, 21)]
    near = {r.doc_id: r.n_near_items for r in D.report(*frames(spark, [(1, LONG)], items)).collect()}
    assert near == {1: 2 - brute(LONG, items)[2]} and near[1] >= 1


def test_proximity_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    read = lambda t, i: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(i, "text").collect()]
    docs, items = read("documents", "doc_id"), read("benchmark", "item_id")
    got = QUERIES["op9_proximity"](spark, sf)
    assert got.columns[:-1] == QUERIES["op9_decontamination"](spark, sf).columns
    assert near_of(got) == brute_near(docs, items)


def test_repeated_rows_have_postings_once(spark, monkeypatch):
    terms = spark.createDataFrame([(f"w{i}",) for i in range(14)], "term string")
    docs = [(1, LONG)] * 50 + [(None, LONG)] * 50 + [(2, LONG), (2, "w1"), (3, None), (3, None)]
    for most in (0, D.REPEATED_ROWS):
        monkeypatch.setattr(D, "REPEATED_ROWS", most)
        index = D.build_index(spark.createDataFrame(docs, "doc_id long, text string"), terms)
        assert index.count() == 3 * 14 + 1 == index.distinct().count()
    docs += DOCS
    assert found(D.report(*frames(spark, docs))) == expected(docs, ITEMS)


def test_keep_clean_keeps_rows_and_columns(spark):
    docs, items = frames(spark)
    kept = D.keep_clean(docs, items)
    assert kept.columns == docs.columns
    want = [i for i, t in DOCS if not brute(t, ITEMS)[4]]
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == sorted(map(str, want))


def test_native(spark):
    plan = D.report(*frames(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_item_and_document_that_repeat_themselves(spark):
    """Every place of one agrees with every place of the other."""
    docs = [(1, "a b " * 20_000), (2, "b " + "a b " * 5 + "c"), (3, "a b " * 4)]
    items = [(1, "a b " * 500), (2, "a a a a a a a a a a a a"), (3, "x " * 12 + LONG + " x" * 12 + " " + LONG)]
    docs += [(4, "y " + LONG + " x x x"), (5, "x " * 30)]
    rows = {r.doc_id: r for r in D.report(*frames(spark, docs, items)).collect()}
    assert [rows[i].n_hit for i in (1, 2, 3, 4, 5)] == [40_000, 11, 0, 17, 30]
    assert found(D.report(*frames(spark, docs[1:], items))) == expected(docs[1:], items)


def test_pieces_hold_each_window_once(spark):
    text = "a b " * 6 + LONG + " " + LONG
    got = D.pieces(spark.createDataFrame([(1, text)], "item_id int, text string"), "item_id", "text", 10).collect()
    held = [tuple(r.words[s : s + 10]) for r in got for s in range(len(r.words) - 9)]
    w = tokens(text)
    assert sorted(held) == sorted({tuple(w[s : s + 10]) for s in range(len(w) - 9)})
