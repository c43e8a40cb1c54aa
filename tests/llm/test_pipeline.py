"""The pipeline against the plain versions of its stages' tests."""

import sys
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[2])]

import corpus_pipeline  # noqa: E402
import test_decontamination  # noqa: E402
import test_line_templates  # noqa: E402
import test_packing  # noqa: E402
import test_quality_rules  # noqa: E402
import test_simhash  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    read = lambda t: spark.read.parquet(f"{SF_DIR}/{t}.parquet")
    docs = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in read("benchmark").select("item_id", "text").collect()]
    docs = [d for d in docs if test_quality_rules.brute(d[1])[-1]]
    docs = test_line_templates.brute(docs)
    fps = [(i, test_simhash.slow_fingerprint(t)) for i, t in docs]
    comp = test_simhash.slow_components(fps)
    docs = [d for d, (i, f) in zip(docs, fps, strict=True) if comp[f] == i]
    grams = {tuple(w[s : s + 10]) for w in (test_decontamination.tokens(t) for _, t in items) for s in range(max(1, len(w) - 9)) if w}

    def clean(text):
        w = test_decontamination.tokens(text)
        return not any(tuple(w[p : p + n]) in grams for n in {len(g) for g in grams} for p in range(len(w) - n + 1))

    docs = [d for d in docs if clean(d[1])]
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    used, bound = test_packing.check(rows, docs)
    assert used <= 1.01 * bound + 1


def test_stages_keep_the_columns(spark):
    rows = [(1, " ".join(f"word{i} of" for i in range(40)), "en", 3, 5), (2, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, id int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "/root/testdata/sf0.001")
        assert out.columns == df.columns and out.dtypes == df.dtypes
