"""Aligning the tokens of two tokenizers of one text.

1. **Tokens.** Whole texts are encoded by both tokenizers (a space stands before the text, as the
   second one adds it).  A text counts only if the bytes of either's tokens are the text again.
2. **Anchors.** Places where tokens of both end and the next token of both is marked with a
   space.  They split a text into windows of token ids, mostly one word long.
3. **Windows.** A window's alignment follows from its ids alone: the places inside where tokens of both
   end cut it into groups.  Alignments are remembered by the pair of id tuples (packed as
   bytes); what is remembered is dropped when it holds ``HELD`` ids.
4. **Counts.** Every document carries its different pairs of linked ids with how often each is linked.
   They are counted over documents, and the counts joined back, by broadcast only if
   counted to be few (``BROADCAST_ROWS``).

A pair that a third of all documents share is one row for each task before the shuffle.
Documents are never regrouped: a stored row number names them.

Defined results: null and empty texts, and texts that the tokens do not give back, have no tokens,
no groups, and zeros; names of special tokens are ordinary text; repeated rows are documents of
their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendora.llm.common import sized_broadcast, slices, small_batches
from vendora.llm.packing import encoder
from vendora.session import settle

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
# Ids in remembered windows.
HELD = 400_000
# Pairs of a group that are made one by one.
MOST = 4_096
# Text that is aligned at a time.
PART = 1 << 19
# Most rows of a broadcast table of counts: about 25 MB.
BROADCAST_ROWS = 500_000

MARK = "▁"

PAIRS = "array<struct<a:int,b:int,times:bigint>>"


class First:
    """The byte-level tokenizer."""

    def __init__(self, path: str):
        self.encoding = encoder(path)
        self.ids = self.encoding.encode_ordinary
        size = self.encoding.n_vocab
        self.bytes = [b""] * size
        for token, i in self.encoding._mergeable_ranks.items():
            self.bytes[i] = token

    def encode(self, text: str) -> list[int] | None:
        """Ids of a text; none if they do not give it back."""
        ids = self.ids(text)
        return ids if self.encoding.decode_bytes(ids) == text.encode() else None


class Second:
    """The piece tokenizer, which puts a space before a text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]

    def encode(self, text: str) -> list[int] | None:
        """Ids of a text; none if they do not give back a space and the text."""
        ids = self.model.encode(text)
        return ids if b"".join(map(self.bytes.__getitem__, ids)) == b" " + text.encode() else None


class Windows:
    """Alignments of windows, remembered by their ids."""

    def __init__(self, first: list[bytes], second: list[bytes]):
        self.n_a, self.n_b = len(first), len(second)
        self.length_a = np.array([len(b) for b in first], np.int64)
        self.length_b = np.array([len(b) for b in second], np.int64)
        self.marked_a = np.array([b[:1] == b" " for b in first])
        self.marked_b = np.array([b[:1] == b" " for b in second])
        # An id as it is written inside and at the end of a group's ids.
        self.written = [f"{i}{end}" for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for end in ends for i in range(n)]
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.number: dict[bytes, int] = {}
        self.shown: list[str] = []
        # Per window; its pairs of ids lie from ``start`` to the next window's.
        self.groups, self.links, self.start = none, none, np.zeros(1, np.int64)
        self.pairs, self.times = none, none
        self.held = 0

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the windows of aligned ids, and the places in ``a`` where they begin."""
        cut_a, cut_b = self.shared_ends(a, b)
        both = self.marked_a[a[cut_a[:-1]]] & self.marked_b[b[cut_b[:-1]]]
        i, k = (np.concatenate([[0], cut[:-1][both], cut[-1:]]) for cut in (cut_a, cut_b))
        # A window's key: its ids in ``a``, then those in ``b``, told apart by their range.
        flat = np.empty(len(a) + len(b), "<u4")
        flat[np.arange(len(a)) + np.repeat(k[:-1], np.diff(i))] = a
        flat[np.arange(len(b)) + np.repeat(i[1:], np.diff(k))] = b + self.n_a
        packed, edges = flat.tobytes(), (4 * (i + k)).tolist()
        keys = [packed[s:e] for s, e in zip(edges, edges[1:], strict=False)]
        number, out, new = self.number, list(map(self.number.get, keys)), []
        for w in [w for w, at in enumerate(out) if at is None]:
            out[w] = number.setdefault(keys[w], len(number))
            if out[w] == len(self.shown) + len(new):
                new.append(w)
        if new:
            self.learn(a[_ranges(i[new], i[1:][new])], b[_ranges(k[new], k[1:][new])], np.diff(i)[new])
        return np.array(out, np.int64), i[:-1]

    def shared_ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens of either stand before each place where tokens of both end."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        there = np.minimum(np.searchsorted(ends_b, ends_a), len(b) - 1)
        i = np.flatnonzero(ends_b[there] == ends_a)
        return i + 1, there[i] + 1

    def learn(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> None:
        """Align new windows, given one after the other, with ``sizes`` tokens in ``a``."""
        to_a, to_b = self.shared_ends(a, b)
        from_a, from_b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
        n, m = to_a - from_a, to_b - from_b
        last = np.searchsorted(to_a, np.cumsum(sizes)) + 1
        first = np.append(0, last[:-1])
        window = np.repeat(np.arange(len(sizes)), last - first)
        # Groups of very many pairs are counted by their different ids, the others pair by pair.
        small = np.flatnonzero(n * m <= MOST)
        times = (n * m)[small]
        group = np.repeat(small, times)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(times) - times, times)
        pair = a[from_a[group] + nth // m[group]] * self.n_b + b[from_b[group] + nth % m[group]]
        owner, weight = window[group], np.ones(len(group), np.int64)
        for g in np.flatnonzero(n * m > MOST):
            x, x_times = np.unique(a[from_a[g] : to_a[g]], return_counts=True)
            y, y_times = np.unique(b[from_b[g] : to_b[g]], return_counts=True)
            pair = np.append(pair, (x[:, None] * self.n_b + y[None, :]).ravel())
            weight = np.append(weight, np.outer(x_times, y_times).ravel())
            owner = np.append(owner, np.full(len(x) * len(y), window[g]))
        owner, pair, weight = _summed(owner, pair, weight, self.n_a * self.n_b)
        self.pairs, self.times = np.append(self.pairs, pair), np.append(self.times, weight)
        counts = np.bincount(owner, minlength=len(sizes))
        self.start = np.append(self.start, self.start[-1] + np.cumsum(counts))
        self.groups = np.append(self.groups, last - first)
        self.links = np.append(self.links, np.add.reduceat(n * m, first))
        # Written out: the ids of a group in a, then those in b.
        text = np.empty(len(a) + len(b), np.int64)
        text[np.arange(len(a)) + np.repeat(from_b, n)] = a
        text[to_a + from_b - 1] += self.n_a
        text[np.arange(len(b)) + np.repeat(to_a, m)] = b + 2 * self.n_a
        text[to_a + to_b - 1] += self.n_b
        written = self.written
        ids = [written[i] for i in text.tolist()]
        ends = (to_a + to_b)[last - 1].tolist()
        self.shown += ["".join(ids[s:e]) for s, e in zip([0, *ends], ends, strict=False)]
        self.held += len(ids)


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers from each start up to its end, one range after the other."""
    size = end - start
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def _summed(owner: np.ndarray, pair: np.ndarray, weight: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Each pair once for each owner, with the sum of its weights, in order."""
    both = owner * span + pair
    order = np.argsort(both, kind="stable")
    both = both[order]
    first = np.flatnonzero(np.diff(both, prepend=-1))
    owner, pair = np.divmod(both[first], span)
    return owner, pair, np.add.reduceat(weight[order], first) if len(first) else weight


@lru_cache(2)
def aligner(first: str, second: str) -> tuple[First, Second, Windows]:
    a, b = First(first), Second(second)
    return a, b, Windows(a.bytes, b.bytes)


def align_texts(texts: list[str | None], first: str, second: str) -> tuple[list, pa.Array]:
    """Per text (tokens of either, groups, links, the groups written out), and its pairs."""
    a, b, windows = aligner(first, second)
    if windows.held > HELD:
        windows.forget()
    encoded = [(a.encode(" " + t), b.encode(t)) if t else (None, None) for t in texts]
    at = [i for i, (x, y) in enumerate(encoded) if x is not None and y is not None]
    rows: list = [(0, 0, 0, 0, "")] * len(texts)
    sizes = np.zeros(len(texts), np.int64)
    pair = times = np.zeros(0, np.int64)
    if at:
        ids_a, ids_b = (np.concatenate([np.array(encoded[i][side], np.int64) for i in at]) for side in (0, 1))
        # Bytes of both run alike through all texts, and a space begins each, so texts begin windows.
        numbers, begins = windows.of(ids_a, ids_b)
        edges = np.searchsorted(begins, np.cumsum([0] + [len(encoded[i][0]) for i in at]))
        named = numbers.tolist()
        for i, s, e in zip(at, edges.tolist(), edges[1:].tolist(), strict=False):
            mine = numbers[s:e]
            shown = "".join([windows.shown[w] for w in named[s:e]])[:-1]
            counts = (int(windows.groups[mine].sum()), int(windows.links[mine].sum()))
            rows[i] = (len(encoded[i][0]), len(encoded[i][1]), *counts, shown)
        # A document's windows, each once, then its pairs, each once.
        of_doc = np.repeat(np.array(at), np.diff(edges))
        seen, repeats = np.unique(of_doc * len(windows.shown) + numbers, return_counts=True)
        doc, window = np.divmod(seen, len(windows.shown))
        start, end = windows.start[window], windows.start[window + 1]
        where = _ranges(start, end)
        weight = windows.times[where] * np.repeat(repeats, end - start)
        doc, pair, times = _summed(np.repeat(doc, end - start), windows.pairs[where], weight, windows.n_a * windows.n_b)
        sizes = np.bincount(doc, minlength=len(texts))
    left, right = np.divmod(pair, windows.n_b)
    fields = [pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(times)]
    held = pa.StructArray.from_arrays(fields, ["a", "b", "times"])
    return rows, pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), held)


def align(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    first: str | None = None,
    second: str | None = None,
    digest: bool = False,
) -> DataFrame:
    """Rows ``(id, n_a, n_b, n_groups, n_links, groups, pairs)``, one per document.

    ``groups`` is written ``a1,a2|b1;a3|b2,b3``, or with ``digest`` is the SHA-256 of that, which keeps
    long texts short."""
    paths = first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], "text", PART):
                rows, pairs = align_texts(part.column("text").to_pylist(), *paths)
                shown = [r[4] for r in rows]
                if digest:
                    shown = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in shown]
                numbers = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *numbers, pa.array(shown, pa.string()), pairs],
                    ["id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"],
                )

    given = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return small_batches(given).mapInArrow(
        run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs {PAIRS}"
    )


def linked(aligned: DataFrame) -> DataFrame:
    """Rows ``(a, b, docs, best)``: how many documents link two ids, and whether no id is
    linked with ``a`` by more."""
    pairs = aligned.select(F.explode("pairs").alias("p")).select("p.a", "p.b")
    counts = settle(pairs.groupBy("a", "b").agg(F.count("*").alias("docs")), "pair_counts")
    # One row for each id of a vocabulary.
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return settle(counts.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best")), "linked")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """Per document its tokens, groups and links, and how usual its links are in the corpus."""
    aligned = settle(
        align(docs, doc_id, text, digest=True, **more).withColumn("row", F.monotonically_increasing_id()), "aligned"
    )
    usual = sized_broadcast(linked(aligned), BROADCAST_ROWS)
    times = F.col("times")
    sums = (
        aligned.select("row", F.inline("pairs"))
        .join(usual, ["a", "b"])
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), times)).alias("n_best"), F.sum(times * F.col("docs")).alias("count_sum"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return aligned.drop("pairs").join(sums, "row", "left").select(
        F.col("id").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"),
        F.col("groups").alias("groups_sha256"),
    )
