import random
import re
from collections import Counter

import pytest

from vendora.llm import licenses as L


def cut(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(text, templates, phrases, k, share):
    """Spans and phrase places of one text by the definition."""
    w = cut(text)
    spans = set()
    for number, (label, body) in enumerate(templates):
        t = cut(body)
        votes = Counter(
            p - q for p in range(len(w) - k + 1) for q in range(len(t) - k + 1) if w[p : p + k] == t[q : q + k]
        )
        bundles = []
        for g in sorted(votes):
            if bundles and g - bundles[-1][-1] <= min(L.SLACK, len(t) // 4):
                bundles[-1].append(g)
            else:
                bundles.append([g])
        for bundle in bundles:
            if sum(votes[g] for g in bundle) < max(1, L.VOTES * (len(t) - k + 1)):
                continue
            places = [next((g + i for g in bundle if 0 <= g + i < len(w) and w[g + i] == x), None) for i, x in enumerate(t)]
            places = [p for p in places if p is not None]
            if len(places) / len(t) >= share:
                spans.add((min(places), max(places), label, number, len(places) / len(t)))
    found = sorted(
        (i, label) for p, label in phrases for i in range(len(w)) if w[i : i + len(cut(p))] == cut(p)
    )
    return len(w), found, sorted(spans)


def rows_of(df, name="doc_id"):
    return [
        (r[name], r["n_words"], [tuple(x) for x in r["phrases"]], [tuple(x) for x in r["spans"]]) for r in df.collect()
    ]


SMALL = [
    ("one", "a b c d e f g h i j k l"),
    ("two", "a b c a b c a b c d"),
    ("short", "x y z"),
    ("too short", "x y"),
]


@pytest.mark.parametrize("bound", [500_000, 0])
def test_equals_brute_force(spark, monkeypatch, bound):
    """Notices with words changed, put in and left out, in noise of the same words; joined by
    broadcast and by shuffle."""
    monkeypatch.setattr(L, "BROADCAST_WORDS", bound)
    rng = random.Random(5)
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice("abcdxyzq") for _ in range(rng.randint(0, 6))]
            body = rng.choice(SMALL)[1].split()
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(body) + 1)
                body[at : at + rng.randint(0, 1)] = [rng.choice("abq")] * rng.randint(0, 1)
            words += body
        rows.append((i, " ".join(words)))
    phrases = [("a b", "ab"), ("x y z", "xyz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(L.scan(df, templates=SMALL, phrases=phrases, k=3, share=0.7))
    assert sorted(got) == sorted((i, *plain(t, SMALL, phrases, 3, 0.7)) for i, t in rows)
    assert sum(len(s) for *_, s in got) > 40


def test_odd_rows(spark):
    mit, gpl = L.TEMPLATES[1][1], L.TEMPLATES[5][1]
    rows = [
        (1, mit, 1),
        (1, mit, 1),
        (1, "Released under the MIT License.\n" + gpl, 1),
        (None, gpl.replace("hope", "wish"), 2),
        (None, None, 3),
        (2, None, 3),
        (3, "", 4),
        (4, "the MIT licenses and a license from MIT", 5),
        (5, "filler words " * 20000 + mit + " more" * 20000 + " " + mit, 6),
        (6, "mit license mit license", 7),
        (7, " ".join(mit.split()[:30]), 8),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = rows_of(L.scan(df))
    assert sorted(got, key=key) == sorted(
        ((i, *plain(t, L.TEMPLATES, L.PHRASES, L.K, L.SHARE)) for i, t, _ in rows), key=key
    )
    by_id = {r["doc_id"]: r for r in L.report(df).filter("doc_id > 1").collect()}
    assert by_id[5]["labels"] == "mit" and by_id[5]["n_spans"] == 2 and by_id[5]["base_labels"] == ""
    assert by_id[4]["labels"] == "" and by_id[4]["score"] == 0.0
    assert by_id[6]["n_base"] == 2 and by_id[6]["last_word"] == 2 and by_id[6]["score"] == 1.0
    assert by_id[7]["labels"] == ""
    assert L.report(df.filter("false")).count() == 0


def test_repeated_rows_vote_once(spark):
    """Half of a notice's votes from each of two rows are not enough."""
    half = " ".join(L.TEMPLATES[1][1].split()[:14])
    listed = L.template_table(spark, L.TEMPLATES, L.K)
    df = spark.createDataFrame([(1, half)] * 9, "id long, text string").selectExpr("id", "1L AS key", "text")
    assert L.candidates(df, listed).count() == 0
