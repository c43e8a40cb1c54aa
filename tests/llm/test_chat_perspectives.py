from pyspark.sql import functions as F

from vendora.functions import grouping
from vendora.llm.chat_perspectives import rotate

ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello"), (1, 3, "ann", "é😀"), (1, 4, "eve", None),
    (2, 0, "system", "nobody here"),
    (3, 1, "ann", "same"), (3, 1, "ann", "same"), (3, None, None, "late"), (3, 1, "bob", ""),
    (None, 0, "ann", "lost"), (None, 1, "bob", "too"),
]
SCHEMA = "conv_id long, turn long, role string, text string, side string"


def rendered(rows):
    """{(conversation, side): (whole dialogue, trained parts)}."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(t is None, t or 0, who or "unknown", x or "") for c, t, who, x in rows if c == conv]
        for side in {t[2] for t in turns} - {"system"}:
            whole, mask = "", []
            for _, _, who, x in sorted(turns):
                role = "system" if who == "system" else "assistant" if who == side else f"user name={who}"
                whole += f"<|im_start|>{role}\n"
                if role == "assistant":
                    mask.append((len(whole), len(whole) + len(x) + len("<|im_end|>")))
                whole += x + "<|im_end|>\n"
            out[conv, side] = whole, mask
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.position):
        whole, mask = out.get((r.conv_id, r.side), ("", []))
        assert r.begins == len(whole) and r.ends == r.begins + len(r.segment)
        assert (r.mask_begins is None) == (r.role != "assistant")
        if r.role == "assistant":
            mask.append((r.mask_begins, r.mask_ends))
        out[r.conv_id, r.side] = whole + r.segment, mask
    return out


def test_every_side(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA)
    assert collected(rotate(df)) == rendered(ROWS)
    assert rotate(df.filter(F.lit(False))).count() == 0


def test_one_conversation_over_many_slices(spark):
    rows = [(7, i, "abc"[i % 3], f"turn {i}") for i in range(600)] + [(i, 0, "a", "x") for i in range(30, 60)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = collected(rotate(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == rendered(rows)


def test_one_repeated_turn_over_many_slices(spark, monkeypatch):
    """A third and more of all rows is one row again and again: no slice holds them all."""
    rows = [(7, 1, "a", "again")] * 600 + [(i, 0, "b", "x") for i in range(30, 60)]
    stored = []
    settle = grouping.settle
    monkeypatch.setattr(grouping, "settle", lambda df, label: stored.append(settle(df, label)) or stored[-1])
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = collected(rotate(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)))
        largest = stored[0].groupBy("_slice").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == rendered(rows)
    assert largest < 200
