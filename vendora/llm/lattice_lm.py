"""Document likelihood under a subword lattice: all segmentations count.

**Model.** A text is its words, lower-cased, and an end; a word is a mark followed by its
bytes, spelled by pieces of an existing vocabulary (single bytes included).  Pieces are
drawn one by one from a unigram distribution that also has the end, so the
probability of spelling a word is the sum over all its segmentations, found by a forward
recursion in log space.  A word that training has seen has one more arc, which spans it
whole and weighs its discounted count; what the discount takes off the counts is the
weight of spelling.  No arc crosses words, hence a document's marginal is the product over
its words and its end, and the probabilities of all next words and the end sum to one.

**Weights.** The vocabulary's own scores (the rank of a piece) give the first weights.
They weight all segmentations of the training words, whose expected piece counts
(forward and backward recursion over the distinct words) give the weights of the next
of ``ROUNDS`` rounds, smoothed by the first ones.  The pieces themselves are never
changed.  The discount follows from the numbers of words seen once and twice.

**Jobs.** One pass over the texts codes documents in blocks of some megabytes: each block
has a dictionary of its words and lists of word numbers and counts.  Dictionaries, not
tokens, are shuffled by word to add up counts and to fetch each word's count and
likelihood; blocks are then joined with their dictionaries.  A word that every document
holds is one row for each block.  What comes to the driver is one number for each piece.

The plain baseline (add-one word unigrams) is worked out from the same counts.

Defined results: null and empty texts have the end alone; a null id is learned from;
repeated rows score alike; with nothing to learn from, the first weights remain and the
baseline's counts are zero; an empty table gives an empty result; other columns are not
read.  Texts and words of any length are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendora.llm.common import LOWER, UPPER, arrow_map
from vendora.session import settle, work_path

VOCABULARY = "piece_bpe_32k.model"
ROUNDS = 2
# Pieces in training words that the vocabulary's own scores count for.
PRIOR = 1_000.0
# Bytes of text whose documents share a dictionary.
BLOCK_BYTES = 16 << 20

MARK = b" "  # begins a word; no word holds it
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BASE, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """``bytes.split`` cuts at just the characters that words do not have."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWERED).split()


class Pieces:
    """The usable pieces of a vocabulary file, found by hashes of their bytes."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled: dict[bytes, float] = {}
        # A byte alone comes last in rank; its piece number is the byte.
        least = min(s for s in map(model.get_score, range(model.get_piece_size())) if s > -1e6)
        for i in range(model.get_piece_size()):
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.get_score(i) < -1e6:
                continue
            raw = model.id_to_piece(i).replace("▁", " ").encode("utf-8")
            if MARK not in raw[1:]:
                spelled[raw] = model.get_score(i)
        texts = [t for t in spelled if len(t) > 1 or t == MARK]
        single = [t for t in spelled if len(t) == 1 and t != MARK]
        self.texts = [bytes([b]) for b in range(256)] + texts
        scores = np.array([least] * 256 + [spelled[t] for t in texts])
        for t in single:  # a one-byte piece and its byte are the same string
            scores[t[0]] = spelled[t]
        scores[MARK[0]] = spelled.get(MARK, least)
        self.longest = max(map(len, texts))
        self.begins = np.array([t[:1] == MARK for t in self.texts])
        # Rank weights, and the end as the last piece, as frequent as a middling one.
        weight = 1.0 / (1.0 - scores)
        weight = np.append(weight, np.median(weight))
        self.first = np.log(weight / weight.sum())
        keys = np.array([self._hash(t) for t in self.texts], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order.astype(np.int64)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(keys * _MIX) >> np.uint64(42)] = True

    @staticmethod
    def _hash(text: bytes) -> np.uint64:
        h = 0
        for b in text:
            h = (h * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(h)

    @property
    def end(self) -> int:
        return len(self.first) - 1

    def edges(self, stream: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every piece inside the words of the stream; ``left``
        has the bytes from each position to its word's end."""
        found = []
        at = np.arange(len(stream))
        h = np.zeros(len(stream), np.uint64)
        for k in range(1, self.longest + 1):
            on = left[at] >= k
            at, h = at[on], h[on]
            if not len(at):
                break
            h = h * _BASE + (stream[at + k - 1].astype(np.uint64) + np.uint64(1))
            likely = np.flatnonzero(self.maybe[(h * _MIX) >> np.uint64(42)])
            where = np.minimum(np.searchsorted(self.keys, h[likely]), len(self.keys) - 1)
            hit = self.keys[where] == h[likely]
            found.append((at[likely[hit]], np.full(hit.sum(), k), self.ids[where[hit]]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _stream(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marked words side by side: bytes, start of each word, and its length."""
    raw = words.cast(pa.binary()).to_pylist()
    joined = np.frombuffer(MARK + MARK.join(raw), np.uint8) if raw else np.zeros(0, np.uint8)
    sizes = np.array([len(w) + 1 for w in raw], np.int64)
    return joined, np.cumsum(sizes) - sizes, sizes


def _gather(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials of each run of values that starts at a cut."""
    top = np.maximum.reduceat(values, cuts)
    sizes = np.diff(np.append(cuts, len(values)))
    return top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, sizes)), cuts))


def _sweep(into: np.ndarray, out_of: np.ndarray, step: np.ndarray, weight: np.ndarray, value: np.ndarray) -> None:
    """Fill ``value[into]`` from ``value[out_of]`` along edges, in the order of ``step``."""
    order = np.lexsort((into, step))
    into, out_of, weight, step = into[order], out_of[order], weight[order], step[order]
    cuts = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(step))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        goal = into[a:b]
        runs = np.flatnonzero(np.diff(goal, prepend=-1))
        value[goal[runs]] = _gather(value[out_of[a:b]] + weight[a:b], runs)


class Lattice:
    """All segmentations of a batch of words; every byte alone is a piece, so there is always one."""

    def __init__(self, words: pa.Array, vocabulary: Pieces):
        stream, self.starts, self.sizes = _stream(words)
        # Word w's nodes are its positions and one more behind them.
        self.node0 = self.starts + np.arange(len(self.starts))
        place = np.arange(len(stream)) - np.repeat(self.starts, self.sizes)
        start, k, self.piece = (
            vocabulary.edges(stream, np.repeat(self.sizes, self.sizes) - place)
            if len(stream)
            else (np.zeros(0, np.int64),) * 3
        )
        self.low, self.low_step = start + np.repeat(np.arange(len(self.sizes)), self.sizes)[start], place[start]
        self.high, self.high_step = self.low + k, self.low_step + k
        self.nodes = len(stream) + len(self.sizes)

    def forward(self, logp: np.ndarray) -> np.ndarray:
        value = np.full(self.nodes, -np.inf)
        value[self.node0] = 0.0
        _sweep(self.high, self.low, self.high_step, logp[self.piece], value)
        return value

    def total(self, forward: np.ndarray) -> np.ndarray:
        return forward[self.node0 + self.sizes]

    def expected(self, logp: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in the words."""
        forward = self.forward(logp)
        back = np.full(self.nodes, -np.inf)
        back[self.node0 + self.sizes] = 0.0
        word = np.searchsorted(self.node0, self.low, side="right") - 1
        _sweep(self.low, self.high, self.sizes[word] - self.low_step, logp[self.piece], back)
        share = np.exp(forward[self.low] + logp[self.piece] + back[self.high] - self.total(forward)[word])
        return np.bincount(self.piece, share, len(logp))


# --- Jobs -----------------------------------------------------------------------------


def coded(docs: DataFrame) -> DataFrame:
    """Rows of documents ``(block, id, held_out, n_words, codes, times)`` and of dictionaries
    ``(block, local, word, n)`` in one stored table; ``n`` counts training documents only."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = (
        f"block long, id {kind}, held_out boolean, n_words long, codes binary, times binary, "
        "local int, word string, n long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, made, size = TaskContext.get().partitionId(), 0, 0
        known: dict[bytes, int] = {}
        rows, learned = [], []

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal made, size
            name = (number << 24) + made
            made, size = made + 1, 0
            at, n = (np.concatenate(x) for x in zip(*learned, strict=True)) if learned else (np.zeros(0, int),) * 2
            counts = np.bincount(at, n, len(known)).astype(np.int64) if len(known) else np.zeros(0, np.int64)
            w, d = len(known), len(rows)
            ids = pa.concat_arrays([r[0] for r in rows])
            yield from pa.table(
                {
                    "block": pa.array(np.full(d, name)),
                    "id": ids,
                    "held_out": pa.array([r[1] for r in rows], pa.bool_()),
                    "n_words": pa.array([r[2] for r in rows], pa.int64()),
                    "codes": pa.array([r[3] for r in rows], pa.binary()),
                    "times": pa.array([r[4] for r in rows], pa.binary()),
                    "local": pa.nulls(d, pa.int32()),
                    "word": pa.nulls(d, pa.string()),
                    "n": pa.nulls(d, pa.int64()),
                }
            ).to_batches()
            yield from pa.table(
                {
                    "block": pa.array(np.full(w, name)),
                    "id": pa.nulls(w, ids.type),
                    "held_out": pa.nulls(w, pa.bool_()),
                    "n_words": pa.nulls(w, pa.int64()),
                    "codes": pa.nulls(w, pa.binary()),
                    "times": pa.nulls(w, pa.binary()),
                    "local": pa.array(np.arange(w, dtype=np.int32)),
                    "word": pa.array(list(known), pa.binary()).cast(pa.string()),
                    "n": pa.array(counts),
                }
            ).to_batches(max_chunksize=100_000)
            known.clear()
            rows.clear()
            learned.clear()

        for batch in batches:
            for i, (text, out) in enumerate(
                zip(batch.column("text").to_pylist(), batch.column("held_out").to_pylist(), strict=True)
            ):
                number_of = known.setdefault
                found = [number_of(w, len(known)) for w in words_of(text)]
                codes, times = np.unique(np.array(found, np.int32), return_counts=True)
                times = times.astype(np.int32)
                rows.append((batch.column("id").slice(i, 1), out, len(found), codes.tobytes(), times.tobytes()))
                if not out:
                    learned.append((codes, times))
                size += len(text or "") + 100
                if size >= BLOCK_BYTES:
                    yield from block()
        if rows:
            yield from block()

    # The largest table set down on the way; zstd takes less room than the default.
    path = work_path(docs.sparkSession, "coded")
    found = docs.select("id", "held_out", "text").mapInArrow(run, schema)
    found.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def fit(words: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log weights of all pieces and the end, from the column ``word`` of distinct words."""
    first = np.exp(pieces(path).first)
    logp = pieces(path).first
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(logp)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(shared.value))
            for batch in batches:
                total += Lattice(batch.column("word"), pieces(path)).expected(shared.value)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["piece", "n"])

        sums = words.select("word").mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        n = np.zeros(len(logp))
        for at, x in sums.collect():  # one row for each piece
            n[at] = x
        logp = np.log((n + PRIOR * first) / (n.sum() + PRIOR))
    return logp


@dataclass(frozen=True)
class Counts:
    """What training adds up: tokens, kinds of tokens, documents, and words seen once and twice."""

    tokens: int
    kinds: int
    ends: int
    once: int
    twice: int

    def base(self, c):
        """Add-one estimate of a token seen ``c`` times, as log10."""
        return np.log10((c + 1) / (self.tokens + self.kinds + 1))

    def mixed(self, c, spelled):
        """Log10 of the probability of a token seen ``c`` times, ``spelled`` being the log of its lattice."""
        if not self.tokens:
            return spelled / np.log(10)
        d = self.once / (self.once + 2 * self.twice) if self.once and self.twice else 0.5
        with np.errstate(divide="ignore"):
            arc = np.log(np.maximum(np.asarray(c, float) - d, 0.0) / self.tokens)
        return np.logaddexp(arc, np.log(d * self.kinds / self.tokens) + spelled) / np.log(10)


def score(
    docs: DataFrame,
    held_out: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Rows ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    given = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("text")
    )
    stored = coded(given)
    listed = stored.filter("local IS NOT NULL").select(F.col("block").alias("listed_in"), "local", "word", "n")
    coded_docs = stored.filter("local IS NULL").select("block", "id", "held_out", "n_words", "codes", "times")
    words = settle(listed.groupBy("word").agg(F.sum("n").alias("c")), "words")
    learned = words.filter("c > 0")
    row = learned.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("once"),
        F.count_if(F.col("c") == 2).alias("twice"),
    ).first()
    ends = coded_docs.filter("NOT held_out").count()
    counts = Counts(row.n + ends, row.v + (ends > 0), ends, row.once, row.twice)
    logp = fit(learned, path, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(logp)

    def spell(batch: pa.RecordBatch) -> pa.RecordBatch:
        lattice = Lattice(batch.column("word"), pieces(path))
        c = batch.column("c").to_numpy(zero_copy_only=False)
        found = counts.mixed(c, lattice.total(lattice.forward(shared.value)))
        return pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(found)], ["word", "c", "lp"])

    known = arrow_map(words, spell, "word string, c long, lp double", "word")
    # The rows of a block's dictionary in order, as two lists.
    fetched = listed.drop("n").join(known, "word").select("listed_in", "local", "c", "lp")
    # After a word comes a piece that begins one, or the end.
    begins = np.exp(logp[:-1][pieces(path).begins]).sum()
    end_base, end_score = counts.base(ends), counts.mixed(ends, logp[-1] - np.log(begins + np.exp(logp[-1])))
    kind = given.schema["id"].dataType.simpleString()

    def add_up(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("local")
        c, lp = right["c"].to_numpy(), right["lp"].to_numpy()
        base = counts.base(c)
        out = []
        for codes, times in zip(left["codes"], left["times"], strict=True):
            at, n = np.frombuffer(codes, np.int32), np.frombuffer(times, np.int32)
            out.append((n[c[at] > 0].sum() + (ends > 0), n @ base[at] + end_base, n @ lp[at] + end_score))
        known_, base_, score_ = zip(*out, strict=True)
        return pd.DataFrame(
            {
                "id": left["id"],
                "held_out": left["held_out"],
                "n_tokens": left["n_words"] + 1,
                "n_known": np.array(known_, np.int64),
                "base_score": np.array(base_, float),
                "score": np.array(score_, float),
            }
        )

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return (
        coded_docs.groupBy("block")
        .cogroup(fetched.groupBy("listed_in"))
        .applyInPandas(add_up, schema)
        .select(
            F.col("id").alias(doc_id),
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(counts.tokens).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )
