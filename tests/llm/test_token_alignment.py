import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vendora.llm import token_alignment as T
from vendora.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path(T.FIRST), public_tokenizers.path(T.SECOND)
A, B = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
A.encode_special_tokens = True

PLAIN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
BYTE_OF = {chr(b): b for b in PLAIN} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(PLAIN)))}


def bytes_a(i):
    return bytes(BYTE_OF[c] for c in A.id_to_token(i))


def bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def groups_of(text):
    """The groups of a text, one place after the other."""
    if not text:
        return None
    whole = (" " + text).encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    pa, pb = [bytes_a(i) for i in a], [bytes_b(i) for i in b]
    if b"".join(pa) != whole or b"".join(pb) != whole:
        return None
    ends_a, ends_b, n = [], [], 0
    for p in pa:
        n += len(p)
        ends_a.append(n)
    n = 0
    for p in pb:
        n += len(p)
        ends_b.append(n)
    out, low = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        out.append(
            ([i for i, e in zip(a, ends_a, strict=True) if low < e <= end], [i for i, e in zip(b, ends_b, strict=True) if low < e <= end])
        )
        low = end
    return out


def plain_report(texts):
    found = [groups_of(t) for t in texts]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in found]
    docs = Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in docs.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for g, c in zip(found, links, strict=True):
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g or [])
        out.append(
            (
                sum(len(a) for a, _ in g or []),
                sum(len(b) for _, b in g or []),
                len(g or []),
                sum(c.values()),
                sum(n for p, n in c.items() if docs[p] == most[p[0]]),
                sum(n * docs[p] for p, n in c.items()),
                hashlib.sha256(shown.encode()).hexdigest() if g else "",
            )
        )
    return out


def reported(df):
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=repr)


def check_texts(texts):
    rows, pairs = T.align_texts(texts, *PATHS)
    for text, row, held in zip(texts, rows, pairs.to_pylist(), strict=True):
        g = groups_of(text) or []
        links = Counter((x, y) for a, b in g for x in a for y in b)
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        assert row == (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(links.values()), shown)
        assert {(p["a"], p["b"]): p["times"] for p in held} == links and len(held) == len(links)


WORDS = st.lists(st.sampled_from(["the", "Les", "ciónado", "  ", "\n\n", "中文字", "é", "😀", "▁", "<s>", "<|endoftext|>", "<0x0A>", "x1.5"]), max_size=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(max_size=20) | WORDS.map(" ".join) | WORDS.map("".join), max_size=5))
def test_alignment_equals_the_definition(texts):
    check_texts(texts)


@settings(max_examples=50, deadline=None)
@given(st.lists(WORDS.map(" ".join), max_size=4))
def test_any_bounds_give_the_same(texts):
    most, held = T.MOST, T.HELD
    T.MOST, T.HELD = 1, 10
    try:
        check_texts(texts)
    finally:
        T.MOST, T.HELD = most, held


def test_windows_are_remembered():
    *_, windows = T.aligner(*PATHS)
    windows.forget()
    T.align_texts(["some words and some words and some words"], *PATHS)
    assert len(windows.shown) == 3
    T.align_texts(["and some words"] * 5, *PATHS)
    assert len(windows.shown) == 3


def test_odd_rows(spark, monkeypatch):
    texts = ["some words", "some words", None, "", "with ▁ mark", "<|endoftext|> <s>", "long 中文" * 900, " ", "words some", "a" * 5000]
    rows = [(1, texts[0], 1)] + [(i, t, i) for i, t in enumerate(texts[1:], 1)] + [(None, "some", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int")
    expected = sorted(((r[0], *x) for r, x in zip(rows, plain_report([r[1] for r in rows]), strict=True)), key=repr)
    assert reported(T.report(df)) == expected
    monkeypatch.setattr(T, "BROADCAST_ROWS", 0)
    assert reported(T.report(df)) == expected
    assert reported(T.report(df.filter("false"))) == []


def test_groups_written_out(spark):
    df = spark.createDataFrame([(1, "tokenizers differ")], "doc_id long, text string")
    row = T.align(df).first()
    g = groups_of("tokenizers differ")
    assert row["groups"] == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = sorted(((d[0], *x) for d, x in zip(docs, plain_report([t for _, t in docs]), strict=True)), key=repr)
    assert reported(QUERIES["op12_token_alignment"](spark, SF)) == expected
