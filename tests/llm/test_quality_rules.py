import re

from pyspark.sql import functions as F

from vendora.llm.quality_rules import STOP_WORDS, judge, keep_good

WORD = r"[^\x20\x09-\x0D]+"
CASES = [
    None, "", " \n\t ", "one", "a b c a b c", "a a a a", "x\nx\n x\n\nx", "#*$ é😀 %&|<>",
    "the quick brown fox jumps over a lazy dog " * 4 + "and so on",
    " ".join(f"word{i} of" for i in range(40)),
    "\n".join(f"line {i} of the same length as any" for i in range(30)),
    "the end of it all\n" * 40, "tok" * 5000,
]


def brute(text):
    t = text or ""
    words = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {p + k for v in at.values() if len(v) > 1 for p in v for k in range(3)}
    n = len(words)
    chars, symbols = sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t))
    dup, stop = len(lines) - len(set(lines)), sum(w.lower() in STOP_WORDS for w in words)
    base = n < 50 or 100 * len(hit) > 50 * n
    bad = not 2 * n <= chars <= 12 * n or 4 * symbols > n or 25 * stop < n or 2 * dup > len(lines)
    return n, chars, symbols, dup, len(hit), base, not (base or bad)


def test_measures_equal_a_plain_count(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(CASES)], "doc_id long, text string, kept string")
    got = judge(df).select("doc_id", "quality.*").collect()
    assert len(got) == len(CASES)
    for r in got:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
        assert found == brute(CASES[r.doc_id]), CASES[r.doc_id]


def test_clashing_columns_repeated_rows_and_no_rows(spark):
    rows = [(1, CASES[9], "a", 3), (1, CASES[9], "a", 3), (None, CASES[9], None, None), (4, None, "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _quality string, _N_WORDS int")
    kept = keep_good(df)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, [r for r in df.collect() if r.text]))
    assert keep_good(df.filter(F.lit(False))).count() == 0


def test_no_exchange_and_no_python(spark):
    plan = judge(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan
