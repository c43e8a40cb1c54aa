import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vendora.llm import spelling as S
from vendora.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_vocabulary(rows, min_length=7, min_count=2, damaged=31):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if damaged and h % damaged == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= min_length:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def plain_variants(counts, times=10):
    """Candidates by deleting one code point anywhere, then the definition."""
    by_hole = {}
    for w in counts:
        for hole in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_hole.setdefault(hole, set()).add(w)
    around = {w: set() for w in counts}
    for group in by_hole.values():
        for a in group:
            around[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(around[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(around[w]), counts.get(form[w])))
    return out


def as_set(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="abé😀", min_size=1, max_size=7), max_size=40))
def test_scan_finds_the_pairs_of_either_half(words):
    words = sorted(words)
    shared = lambda a, b: len(S.commonprefix([a, b]))
    expected = {(a, b) for a in words for b in words if near(a, b)}
    v, w = S.scan(words, words)
    forwards = [(words[i], words[j]) for i, j in zip(v, w, strict=True)]
    assert len(forwards) == len(set(forwards))
    assert set(forwards) == {(a, b) for a, b in expected if shared(a, b) >= min(len(a), len(b)) // 2}
    turned = sorted(x[::-1] for x in words)
    v, w = S.scan(turned, turned)
    assert set(forwards) | {(turned[i][::-1], turned[j][::-1]) for i, j in zip(v, w, strict=True)} == expected


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab", max_size=5), st.text(alphabet="ab", max_size=5), st.text(alphabet="ab", max_size=2))
def test_a_slice_is_skipped_only_if_it_holds_nothing_near(shared, word, rest):
    if near(word, shared + rest) or word == shared + rest:
        assert S.may_hold(shared, word)


def test_scan_of_a_very_long_word():
    long = "x" * 3000
    words = sorted([long, long + "y", long[:-1] + "z", "xyz"])
    v, w = S.scan(words, words)
    assert len(v) == 4


@pytest.mark.parametrize("size", [3, 17, 8192])
def test_variants_equal_brute_force(spark, size):
    """Slices of a few words, a third of which begin alike."""
    rng = random.Random(size)
    counts = {}
    for _ in range(150):
        head = rng.choice(["common", rng.choice("abc") * 3, ""])
        word = head + "".join(rng.choice("abé") for _ in range(rng.randint(1, 5)))
        counts[word] = rng.choice([2, 3, 30, 300, 3000])
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_set(S.variants(df, size=size)) == plain_variants(counts)


def test_chain_of_forms_ends_at_the_last(spark):
    counts = {"abcdefgh": 2, "abcdefgx": 20, "abcdefyx": 200, "abcdzfyx": 2000, "abcdzfyxw": 20000}
    got = {w: root for w, _, root, *_ in as_set(S.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert set(got.values()) == {"abcdzfyxw"}


def test_odd_rows(spark):
    rows = [
        (1, "Holidays holidays HOLIDAYS hollidays hollidays", 1),
        (1, "Holidays holidays HOLIDAYS hollidays hollidays", 1),
        (2, None, 2),
        (3, "", 3),
        (None, "holidays holidays École école écoles ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷", 4),
        (4, "short words only 1234567", 5),
        (5, ("holidays" * 4000 + " ") * 2, 6),
        (6, "tie-onexxxx tie-onexxxx tie-twoxxxx", 7),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, word int")
    plain = plain_vocabulary([r[:2] for r in rows])
    words = S.vocabulary(df)
    assert {r["word"]: r["n"] for r in words.collect()} == plain
    assert as_set(S.variants(words)) == plain_variants(plain)
    assert as_set(S.variants(S.vocabulary(df.filter("false")))) == set()


def test_tables_that_tasks_hold_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(S, "HELD", 3)
    rows = [(i, " ".join(f"{a}wording{b}" for a in "abc" for b in "def")) for i in range(20)]
    assert {r["word"]: r["n"] for r in S.vocabulary(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == plain_vocabulary(rows)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = plain_variants(plain_vocabulary(docs))
    got = as_set(QUERIES["op11_spelling_variants"](spark, SF))
    assert got == expected and any(form for _, form, *_ in got)
