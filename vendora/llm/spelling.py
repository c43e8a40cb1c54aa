"""Grouping spelling variants by dynamic programming over sorted word lists.

1. **Vocabulary.** Every task counts the words of its texts in a table of bounded size;
   the counts are added up by word.
2. **Sorted lists.** Two words within one edit share their first or their last
   ``m // 2`` code points, ``m`` being the length of the shorter.  So the vocabulary is sorted
   twice, forwards and backwards, and either list is cut by range partitioning
   into slices of about ``SLICE`` words.  A word is compared with the words that begin like
   its first half: it visits the slices which that range of the list meets, unless what
   all words of a slice begin with is already more than one edit away.
3. **Scan.** Within a slice, the words that share a prefix share the rows of the edit matrix up
   to there, as the common prefixes of neighbours (LCP) tell.  Only three cells of a row can
   hold a value of at most one (the band).  The scan keeps one row for each range of words with
   one prefix and each visitor, extends it by the next code point of each part of the range,
   and skips a part as soon as its row exceeds one edit.  All visitors of a slice go down together,
   in blocks.
4. **Forms.** A visit returns one row for each word: how many near words it met and the most
   frequent of them.  A pair that shares both halves is taken from the forward list only.
5. **Roots.** Every word points to its form, whose count is several times its own, so there
   are no circles; pointers are doubled until all stand at their last form.

Slices meet in pairs (list slice, slice of the visitors), so a group has at most two slices' words
however many words begin alike.

Defined results: null texts have no words; a null id counts as an empty one; repeated rows
count each; empty tables give no words; other columns are not read.  Texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendora.llm.common import ASCII_LOWER, slices, small_batches, text_of
from vendora.session import settle

MIN_LENGTH = 7
MIN_COUNT = 2
# A form is at least so many times as frequent.
TIMES = 10
# One word in so many, by hash, loses a code point before it is counted.
DAMAGED = 31
# Words of a slice of the sorted list.
SLICE = 8_192
# Visitors that go down a slice together.
BLOCK = 2_048
# Words that a task counts before it hands them on.
HELD = 200_000

LAST = "\U0010ffff"


# --- The vocabulary -------------------------------------------------------------------


def runs(text: str, doc: str, min_length: int = MIN_LENGTH, damaged: int = DAMAGED) -> Iterator[tuple[str, int]]:
    """Words of a text with their counts; runs that end up shorter are left out."""
    head = zlib.crc32(f"{doc}:".encode())
    pattern = r"[A-Za-zÀ-ÿ]{%d,}" % min_length
    for run, n in Counter(re.findall(pattern, text)).items():
        word = run.lower() if run.isascii() else run.translate(ASCII_LOWER)
        if damaged:
            h = zlib.crc32(word.encode(), head)
            if h % damaged == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
        if len(word) >= min_length:
            yield word, n


def vocabulary(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    damaged: int = DAMAGED,
) -> DataFrame:
    """Rows ``(word, n)`` of all words with at least ``min_count`` occurrences."""

    def out(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in slices([batch], "text"):
                for doc, t in zip(part.column("doc").to_pylist(), part.column("text").to_pylist(), strict=True):
                    for word, n in runs(t, doc, min_length, damaged):
                        held[word] += n
                    if len(held) > HELD:
                        yield out(held)
                        held.clear()
        yield out(held)

    given = docs.select(text_of(doc_id).alias("doc"), text_of(text).alias("text"))
    counted = small_batches(given).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- One slice ------------------------------------------------------------------------


class Codes:
    """Code points of words, one after the other."""

    def __init__(self, words: list[str]):
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)

    def at(self, word: np.ndarray, place: int) -> np.ndarray:
        """Code points at a place; any value for words without it."""
        where = np.minimum(self.begin[word] + max(place, 0), max(len(self.flat) - 1, 0))
        return self.flat[where]


def shared_prefixes(codes: Codes) -> np.ndarray:
    """For every word of a sorted list, how many code points it shares with the one before."""
    lcp = np.zeros(len(codes.length), np.int64)
    alike, d = np.arange(1, len(lcp)), 0
    while len(alike):
        alike = alike[(codes.length[alike] > d) & (codes.length[alike - 1] > d)]
        alike = alike[codes.at(alike, d) == codes.at(alike - 1, d)]
        lcp[alike] += 1
        d += 1
    return lcp


def scan(words: list[str], visitors: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (visitor, word) of exactly one edit among those that share the first
    ``m // 2`` code points; ``words`` is sorted and without repeats."""
    own = Codes(words)
    lcp = shared_prefixes(own)
    found_v, found_w = [], []
    for start in range(0, len(visitors), BLOCK):
        v, w = _descend(words, own, lcp, visitors[start : start + BLOCK])
        found_v.append(v + start)
        found_w.append(w)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_v]), np.concatenate([none, *found_w])


def _descend(words: list[str], own: Codes, lcp: np.ndarray, visitors: list[str]) -> tuple[np.ndarray, np.ndarray]:
    other = Codes(visitors)
    half = np.maximum(other.length - 1, 0) // 2
    low, high = (np.zeros(len(visitors), np.int64) for _ in range(2))
    for i, (word, h) in enumerate(zip(visitors, half.tolist(), strict=True)):
        low[i] = bisect_left(words, word[:h])
        high[i] = bisect_right(words, word[:h] + LAST)
    waiting = np.flatnonzero(low < high)
    waiting = waiting[np.argsort(half[waiting], kind="stable")]
    hits_v, hits_w = [], []
    # For each visitor and range: both, how much of the prefix is the visitor's, the three cells.
    v = lo = hi = same = np.zeros(0, np.int64)
    cells = np.zeros((3, 0), np.int8)
    d = int(half[waiting[0]]) if len(waiting) else 0
    while len(v) or len(waiting):
        if not len(v):
            d = int(half[waiting[0]])
        new = waiting[: np.searchsorted(half[waiting], d, "right")]
        if len(new):
            waiting = waiting[len(new) :]
            v, lo, hi = np.concatenate([v, new]), np.concatenate([lo, low[new]]), np.concatenate([hi, high[new]])
            same = np.concatenate([same, np.full(len(new), d)])
            first = np.array([[1 if d else 2], [0], [1]], np.int8)
            cells = np.concatenate([cells, np.repeat(first, len(new), 1)], 1)
        # Words that end here.
        cell = other.length[v] - d + 1
        ends = np.flatnonzero((own.length[lo] == d) & (cell >= 0) & (cell <= 2))
        ends = ends[cells[cell[ends], ends] == 1]
        ends = ends[same[ends] >= np.minimum(d, other.length[v[ends]]) // 2]
        hits_v.append(v[ends])
        hits_w.append(lo[ends])
        # Ranges of words with one more code point in common.
        begins = (lcp <= d) & (own.length > d)
        starts = np.append(np.flatnonzero(begins), len(words))
        before = np.append(0, np.cumsum(begins))
        times = before[hi] - before[lo]
        up = np.repeat(np.arange(len(v)), times)
        child = np.arange(len(up)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(before[lo], times)
        v, lo, hi, same = v[up], starts[child], np.minimum(starts[child + 1], hi[up]), same[up]
        r0, r1, r2 = cells[:, up]
        c, room = own.at(lo, d), other.length[v] - d
        n0 = np.minimum(r0 + (other.at(v, d - 1) != c), r1 + 1)
        n0[room < 0] = 2
        n1 = np.minimum(np.minimum(r1 + (fits := other.at(v, d) != c), r2 + 1), n0 + 1)
        n1[room < 1] = 2
        n2 = np.minimum(r2 + (other.at(v, d + 1) != c), n1 + 1)
        n2[room < 2] = 2
        same = same + ((same == d) & ~fits & (room > 0))
        near = np.flatnonzero((n0 < 2) | (n1 < 2) | (n2 < 2))
        v, lo, hi, same = v[near], lo[near], hi[near], same[near]
        cells = np.minimum(np.stack([n0[near], n1[near], n2[near]]), 2).astype(np.int8)
        d += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *hits_v]), np.concatenate([none, *hits_w])


def may_hold(shared: str, word: str) -> bool:
    """Whether a word that begins with ``shared`` can be within one edit of ``word``."""
    e = len(commonprefix([shared, word]))
    rest = shared[e + 1 :]
    return e == len(shared) or word.startswith(rest, e + 1) or word.startswith(rest, e) or word.startswith(shared[e:], e + 1)


# --- All slices -----------------------------------------------------------------------


def _visits(cut: DataFrame) -> DataFrame:
    """Rows ``(slice, visitor, key)``: words with the slices they visit and the slice they come from."""
    edges = cut.groupBy("slice").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("lo").collect()
    # One row for each slice.
    names, los, his = ([r[c] for r in edges] for c in ("slice", "lo", "hi"))
    shared = [commonprefix([lo, hi]) for lo, hi in zip(los, his, strict=True)]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 16_384) for i in range(0, batch.num_rows, 16_384)):
                rows, to = [], []
                for row, word in enumerate(part.column("key").to_pylist()):
                    head = word[: max(len(word) - 1, 0) // 2]
                    for s in range(bisect_left(his, head), bisect_right(los, head + LAST)):
                        if may_hold(shared[s], word):
                            rows.append(row)
                            to.append(names[s])
                at = pa.array(rows, pa.int64())
                columns = [pa.array(to, pa.int32()), part.column("slice").take(at), part.column("key").take(at)]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "visitor", "key"])

    return cut.select("slice", "key").mapInArrow(send, "slice int, visitor int, key string")


def _pass(words: DataFrame, backwards: bool, size: int) -> DataFrame:
    """Rows ``(word, n_near, best)`` of the near pairs that one of the two sorted lists shows."""
    key = F.reverse("word") if backwards else F.col("word")
    parts = max(1, -(-words.count() // size))
    ordered = words.select(key.alias("key"), "n").repartitionByRange(parts, "key")
    cut = settle(ordered.withColumn("slice", F.spark_partition_id()), "sorted_words")
    visits = settle(_visits(cut), "visits")
    met = visits.select("slice", "visitor").distinct()
    both = cut.join(met, "slice").select("slice", "visitor", "key", "n").unionByName(
        visits.withColumn("n", F.lit(None).cast("long"))
    )

    def per_pair(group: pa.Table) -> pa.Table:
        keys, counts = (group.column(c).to_pylist() for c in ("key", "n"))
        listed = sorted((k, c) for k, c in zip(keys, counts, strict=True) if c is not None)
        words, n = [k for k, _ in listed], np.array([c for _, c in listed], np.int64)
        visitors = [k for k, c in zip(keys, counts, strict=True) if c is None]
        v, w = scan(words, visitors)
        if backwards:
            # What the forward list shows as well is left to it.
            words, visitors = [x[::-1] for x in words], [x[::-1] for x in visitors]
            k = [min(len(visitors[i]), len(words[j])) // 2 for i, j in zip(v, w, strict=True)]
            other = np.array([visitors[i][:m] != words[j][:m] for i, j, m in zip(v, w, k, strict=True)], bool)
            v, w = v[other], w[other]
        rank = np.empty(len(words), np.int64)
        rank[np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)] = np.arange(len(words))
        order = np.lexsort((rank[w], -n[w], v))
        v, w = v[order], w[order]
        who, first, times = np.unique(v, return_index=True, return_counts=True)
        return pa.table(
            {
                "word": pa.array([visitors[i] for i in who], pa.string()),
                "n_near": pa.array(times, pa.int64()),
                "best_n": pa.array(n[w[first]], pa.int64()),
                "best": pa.array([words[j] for j in w[first]], pa.string()),
            }
        )

    return both.groupBy("slice", "visitor").applyInArrow(per_pair, "word string, n_near long, best_n long, best string")


def near_words(words: DataFrame, size: int = SLICE) -> DataFrame:
    """Rows ``(word, n_near, best_n, best)`` for every word of ``words (word, n)`` with a near one:
    how many there are, and the most frequent (the smallest of several)."""
    found = _pass(words, False, size).unionByName(_pass(words, True, size))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("b")
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """Rows ``(word, root)`` for ``forms (word, form)``, which have no circles: the last of
    the forms that a word leads to."""
    at = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = settle(at.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if new.filter("next IS NOT NULL").isEmpty():
            return new.select("word", "root")
        at = new.select("word", "root")


def variants(words: DataFrame, times: int = TIMES, size: int = SLICE) -> DataFrame:
    """Rows ``(word, n, n_near, form, form_n, root)`` for ``words (word, n)``, words being distinct."""
    words = settle(words, "vocabulary")
    near = settle(words.join(near_words(words, size), "word", "left"), "near_words")
    has = F.col("best_n") >= F.lit(times) * F.col("n")
    formed = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best")).alias("form"),
        F.when(has, F.col("best_n")).alias("form_n"),
    )
    last = roots(formed.filter("form IS NOT NULL"))
    return formed.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
