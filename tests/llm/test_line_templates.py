import random
import re

from pyspark.sql import functions as F

from vendora.llm import line_templates as L
from vendora.llm.queries import QUERIES

WS = r"[\x20\x09-\x0D]+"


def words(line):
    found = [w for w in re.split(WS, line) if w]
    return tuple("<*>" if re.search("[0-9]", w) else w for w in found)


def brute(docs):
    """Texts after dropping, by dictionaries over all lines."""
    texts = {}
    for i, t in docs:
        if t is not None:
            order = (i is None, i if i is not None else 0)
            texts[t] = min(texts.get(t, order), order)
    lines = {}
    for t in texts:
        for line in t.split("\n"):
            if words(line):
                lines.setdefault(words(line), set()).add(t)
    leaves = {}
    for w in lines:
        leaves.setdefault((len(w), w[:3]), []).append(w)
    shape = {}
    for leaf in leaves.values():
        if len(leaf) < 2 or sum(len(lines[w]) for w in leaf) < 3:
            continue
        support = {}
        for w in leaf:
            for p, x in enumerate(w):
                support[p, x] = support.get((p, x), 0) + len(lines[w])
        support = {k: v for k, v in support.items() if v >= 3}
        usual = {}
        for (p, x), v in support.items():
            usual[p] = max(usual.get(p, (0, "")), (v, x))
        for w in leaf:
            if sum((p, x) in support for p, x in enumerate(w)) >= 0.6 * len(w):
                shape[w] = ("t", tuple(x if (p, x) in support else usual.get(p, (0, "<*>"))[1] for p, x in enumerate(w)))
    groups = {}
    for w, ts in lines.items():
        groups.setdefault(shape.get(w, w), set()).update(ts)
    first = {g: min(ts, key=lambda t: texts[t]) for g, ts in groups.items() if len(ts) >= 3}

    def clean(t):
        if t is None:
            return None
        keep = []
        for line in t.split("\n"):
            g = shape.get(words(line), words(line))
            if not (words(line) and g in first and first[g] != t):
                keep.append(line)
        return "\n".join(keep)

    return [(i, clean(t)) for i, t in docs]


def compare(spark, docs):
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(docs)], "doc_id long, text string, leaf int")
    got = L.drop_recurring(df)
    assert got.columns == df.columns
    assert sorted(map(repr, [(r.doc_id, r.text) for r in got.collect()])) == sorted(map(repr, brute(docs)))


NOTICE = "this page was made on {} by the team at {} for all of you"


def cases():
    docs = [(i, f"own line number {chr(97 + i)} here\n" + NOTICE.format(f"2020-{i}", f"site{i}.org") + "\n\nend") for i in range(6)]
    docs += [(20 + i, f"alpha beta gamma delta {x} zeta eta theta\nz{i}x") for i, x in enumerate("pqrs")]
    docs += [(30, "whole copy\nwith two lines")] * 2 + [(31, "whole copy\nwith two lines"), (32, "whole copy\nwith two lines")]
    docs += [(40, None), (41, ""), (42, "  \n\t\n"), (None, "end\nfresh words"), (43, "end " * 5000), (44, "end\nend\nshort")]
    return docs


def test_equals_brute_force(spark):
    compare(spark, cases())


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_ROWS", 0)
    compare(spark, cases())


def test_random_lines(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcd") for _ in range(rng.choice([1, 4, 5, 6]))) for _ in range(60)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(6)))) for i in range(120)]
    compare(spark, docs)


def test_unlike_short_lines_of_a_leaf_stay(spark):
    """Their three leading words alone make no template; one more constant word does."""
    ends = ["Ing eresnt.", "Oues ereaha.", "Are for.", "Of. Restwh."]
    docs = [(i, f"Was erlytion that. {e}\nDes erberber das. {e.split()[0]}\nWas erlytion this. {e.split()[0]} too") for i, e in enumerate(ends)]
    got = L.drop_recurring(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = [(i, t if i == 0 else t.rsplit("\n", 1)[0]) for i, t in docs]
    assert sorted((r.doc_id, r.text) for r in got) == want


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.drop_recurring(df).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [(r.doc_id, r.text) for r in QUERIES["op2_line_templates"](spark, sf).collect()]
    assert sorted(got) == sorted(brute(docs))
