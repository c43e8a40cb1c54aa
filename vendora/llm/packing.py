"""Packing token sequences: large items in pairs, small ones into the best gap.

1. **Pieces.** Documents become token ids followed by an end id, and those longer
   than a sequence are cut.  This is the only pass over the texts.
2. **Plan.** Which lengths share a sequence depends on nothing but how many pieces there
   are of each length, at most ``capacity`` numbers.  Lengths above a third of the
   capacity are paired greedily, the largest with the largest that still fits, so
   that a sequence holds at most two of them; smaller lengths then go, largest
   first, into the tightest gap that takes them, and open new sequences only when no gap
   does.  The plan says how many sequences have which lengths.
3. **Places.** Pieces of one length are interchangeable, so a piece needs only its rank
   among its own length.  Ranks come from row numbers within hashed buckets of a
   few hundred pieces and running totals of the buckets; a length that a third of
   all pieces share has as many more buckets.  A join with the plan gives sequence
   and offset.

The driver holds the counts and the plan, whose sizes the capacity bounds, and no
pieces.

Defined results: a null text is an empty one and has the end id alone; repeated rows
are packed each; an empty table gives an empty result; other columns are not read.
Texts are tokenized whole.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendora.llm.common import arrow_map
from vendora.session import settle

CAPACITY = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
# Pieces of one bucket whose rows are numbered together.
BUCKET = 512


@lru_cache(2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-pair vocabulary of a tokenizers file.

    Ids in such a file follow the order of its merges, so they serve as ranks."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocab, special = file["model"]["vocab"], {t["content"]: t["id"] for t in file["added_tokens"]}
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if all(c in byte_of for c in token)}
    for name in special:
        ranks.pop(name.encode(), None)
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """Ids as the file's own library gives them without adding any: a special token's name in a
    text is that token."""
    if any(name in text for name in encoding.special_tokens_set):
        return encoding.encode(text, allowed_special="all")
    return encoding.encode_ordinary(text)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids; only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None
) -> DataFrame:
    """Rows ``(id, piece, start, length, ids_crc32)``."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding = encoder(path)
        rows, out = [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            ids = np.array(token_ids(encoding, text or "") + [END_ID], "<u4")
            for k, (start, n) in enumerate(cuts(len(ids), capacity)):
                rows.append(row)
                out.append((k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
        columns = np.array(out, np.int64).reshape(-1, 4).T
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(pa.array(rows, pa.int64())),
                pa.array(columns[0].astype(np.int32)),
                *[pa.array(c) for c in columns[1:]],
            ],
            ["id", "piece", "start", "length", "ids_crc32"],
        )

    given = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return arrow_map(given, per_batch, f"id {kind}, piece int, start long, length long, ids_crc32 long", "text")


# --- The plan ------------------------------------------------------------------------

Run = tuple[int, int]  # a length, and how often it stands in a row in a sequence


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[Run]]]:
    """Groups of alike sequences: how many there are, and the runs of lengths they hold."""
    left = {n: c for n, c in counts.items() if c > 0}
    groups: list[tuple[int, int, list[Run]]] = []  # gap, sequences, runs
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        at = bisect_left(large, capacity - a + 1) - 1
        b = large[at] if at >= 0 else None
        if b is None or (b == a and left[a] == 1 and at == 0):
            groups.append((capacity - a, left[a], [(a, 1)]))
            left[a] = 0
        elif b == a and left[a] == 1:
            b = large[at - 1]
            groups.append((capacity - a - b, 1, [(a, 1), (b, 1)]))
            left[a], left[b] = 0, left[b] - 1
        else:
            m = left[a] // 2 if a == b else min(left[a], left[b])
            groups.append((capacity - a - b, m, [(a, 2)] if a == b else [(a, 1), (b, 1)]))
            left[a] -= m
            left[b] -= m
        large = [n for n in large if left[n]]

    gaps: dict[int, list[tuple[int, list[Run]]]] = {}
    for gap, m, runs in groups:
        gaps.setdefault(gap, []).append((m, runs))
    order = sorted(gaps)

    def put(gap: int, m: int, runs: list[Run]) -> None:
        if m:
            if gap not in gaps:
                insort(order, gap)
                gaps[gap] = []
            gaps[gap].append((m, runs))

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        while todo:
            at = bisect_left(order, n)
            if at == len(order):
                times = capacity // n
                m = max(1, todo // times)
                put(capacity, m, [])
                at = len(order) - 1
            gap = order[at]
            m, runs = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            # The tightest gap stays the tightest until it takes no more.
            times = min(gap // n, max(1, todo // m))
            used = min(m, todo // times)
            put(gap, m - used, runs)
            put(gap - times * n, used, [*runs, (n, times)])
            todo -= used * times
    return [(m, runs) for gap in sorted(gaps) for m, runs in gaps[gap]]


def slots(groups: Iterable[tuple[int, list[Run]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end of ranks, first sequence, pieces in a row, offset)."""
    used: dict[int, int] = {}
    out, first = [], 0
    for m, runs in groups:
        offset = 0
        for n, times in runs:
            rank = used.get(n, 0)
            out.append((n, rank, rank + m * times, first, times, offset))
            used[n] = rank + m * times
            offset += n * times
        first += m
    return out


# --- Places --------------------------------------------------------------------------


def ranked(found: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Add ``rank``, from 0 within each length; ``found`` is stored."""
    spark = found.sparkSession
    sizes = spark.createDataFrame([(n, -(-c // BUCKET)) for n, c in counts.items()], "length long, buckets long")
    # One row for each length: at most as many as a sequence has tokens.
    dealt = found.join(F.broadcast(sizes), "length").withColumn(
        "bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.col("buckets"))
    )
    totals = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = W.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32")
    return (
        dealt.withColumn("row", F.row_number().over(within))
        .join(before, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("row") - 1)
        .drop("bucket", "buckets", "row", "before")
    )


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None
) -> DataFrame:
    """Rows ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one per piece."""
    found = settle(pieces(docs, doc_id, text, capacity, tokenizer), "pieces")
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    table = slots(plan(counts, capacity))
    schema = "length long, low long, high long, first long, times long, base long"
    places = docs.sparkSession.createDataFrame(table, schema)
    r = F.col("rank") - F.col("low")
    return (
        ranked(found, counts)
        # A few rows for each length; see ``plan``.
        .join(F.broadcast(places), "length")
        .filter((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        .select(
            F.col("id").alias(doc_id),
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first") + F.floor(r / F.col("times"))).alias("sequence_id"),
            (F.col("base") + F.pmod(r, F.col("times")) * F.col("length")).alias("offset"),
        )
    )
