"""Toxic spans and document scores by a linear-chain conditional random field.

**Tokens.** Runs of word characters, lower-cased; a sentence (up to ``.``, ``!``, ``?`` or
a line end, ``CHAIN`` tokens at most) is one chain with the states clean and toxic.

**Labelled tokens.** Labels stand on documents.  A token of a toxic document is
labelled toxic if its word or the beginning of its word is tied to toxic documents
beyond chance (likelihood ratio of document counts above ``TIED``, hardly found in clean
documents, and after different words); all others, and all of clean documents, are
labelled clean.

**Training.** The field has weights for words and word beginnings, a bias, and
transitions.  They climb the exact gradient of the chains' likelihood, from forward and
backward passes.  Last, a document's marginals give two numbers, the largest and
the damped sum of squares, and logistic regression on the document labels turns them into the
score.  All of it sees about ``TRAIN_ROWS`` labelled documents and ``TRAIN_BYTES`` of their text at
most, chosen by hash, and runs in one task; both bounds are parameters.  All chains of that
sample are trained on, those without a tied word in blocks that take turns.

**Scoring** covers every whole text: emission scores by word, both passes over all
chains of a batch at once, marginals, score, and the offsets (in characters) of
tokens that are more likely toxic than not.

Defined results: null and empty texts have no tokens and get the score of an empty
document; without any label, or without both kinds, every score is 0 for lack of toxic
evidence; a repeated label counts once, and ids whose labels disagree teach nothing; repeated rows score alike; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendora.llm.common import arrow_map
from vendora.llm.quality_classifier import TRAIN_BYTES, labelled_texts, sigmoid

TRAIN_ROWS = 8_000
TIED = 20.0
# Share of toxic documents among those with a tied word, and words it follows there.
PURE = 0.9
CONTEXTS = 6
# Chains without a tied word that one step of the training takes, besides all with one; the steps
# go through all of them in turn.
BLOCK = 10_000
CHAIN = 256
ROUNDS = 50
STEP = 0.3
PENALTY = 1e-3
SPAN = 0.5

_TOKENS = re.compile(r"\w+|[.!?\n]")
_ENDS = frozenset(".!?\n")


def features_of(word: str) -> tuple[str, str, str]:
    return "w" + word, "4" + word[:4], "5" + word[:5]


@dataclass
class Field:
    """Weights of the field (clean has score 0) and of the score."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    start: float = 0.0  # of toxic, at the first token
    steps: tuple[float, float, float] = (0.0, 0.0, 0.0)  # clean-toxic, toxic-clean, toxic-toxic
    score: tuple[float, float, float] = (-35.0, 0.0, 0.0)  # constant, largest, damped sum

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features_of(word))


# --- Chains -----------------------------------------------------------------------------


def chains(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the chains between the true entries of ``ends``, longest first."""
    cut = np.concatenate([[-1], np.flatnonzero(ends), [len(ends)]])
    starts, lengths = cut[:-1] + 1, np.diff(cut) - 1
    more = np.maximum(1, -(-lengths // CHAIN))
    which = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    starts, lengths = np.repeat(starts, more) + which * CHAIN, np.repeat(lengths, more) - which * CHAIN
    lengths = np.minimum(lengths, CHAIN)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    return starts[order], lengths[order]


def passes(e: np.ndarray, starts: np.ndarray, lengths: np.ndarray, model: Field, weight: np.ndarray | None = None):
    """Marginals of toxic, and with ``weight`` of tokens the weighted sums of expected
    steps (clean-toxic, toxic-clean, toxic-toxic).

    The passes hold, for each token, the share of toxic in the forward and in the
    backward message; all chains move one token at a time together."""
    odds = np.exp(np.clip(e, -30, 30))
    ct, tc, tt = np.exp(model.steps)
    fore, back, p = np.zeros(len(e)), np.full(len(e), 0.5), np.zeros(len(e))
    depth = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(depth), side="left")  # chains longer than t
    for t in range(depth):
        at = starts[: alive[t]] + t
        if t == 0:
            toxic, clean = odds[at] * np.exp(model.start), np.ones(len(at))
        else:
            r = fore[at - 1]
            toxic, clean = odds[at] * ((1 - r) * ct + r * tt), (1 - r) + r * tc
        fore[at] = toxic / (toxic + clean)
    expected = np.zeros(3)
    for t in range(depth - 1, -1, -1):
        at = starts[: alive[t]] + t
        if t + 1 < depth:
            on = at[: alive[t + 1]]
            q, o = back[on + 1], odds[on + 1]
            clean, toxic = (1 - q) + ct * o * q, tc * (1 - q) + tt * o * q
            r = fore[on]
            if weight is not None:
                share = weight[on] / ((1 - r) * clean + r * toxic)
                expected += [
                    (share * (1 - r) * ct * o * q).sum(),
                    (share * r * tc * (1 - q)).sum(),
                    (share * r * tt * o * q).sum(),
                ]
            back[on] = toxic / (clean + toxic)
        r, q = fore[at], back[at]
        p[at] = r * q / (r * q + (1 - r) * (1 - q))
    return p, expected


# --- Training ----------------------------------------------------------------------------


def _ratio(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Signed likelihood ratio of a feature's document counts."""

    def part(k, n, p):
        p = min(max(p, 1e-9), 1 - 1e-9)
        return k * np.log(p) + (n - k) * np.log(1 - p)

    both = (toxic + clean) / (n_toxic + n_clean)
    g = part(toxic, n_toxic, toxic / n_toxic) + part(clean, n_clean, clean / n_clean)
    g = 2 * (g - part(toxic, n_toxic, both) - part(clean, n_clean, both))
    return g if toxic * n_clean > clean * n_toxic else -g


def _coded(texts: Iterator[str]) -> tuple[list[str], list[np.ndarray]]:
    """The different tokens, and each text as their numbers; every text ends with an end."""
    known: dict[str, int] = {}
    out = []
    for t in texts:
        out.append(np.array([known.setdefault(w, len(known)) for w in [*_TOKENS.findall(t.lower()), "."]], np.int32))
    return list(known), out


def train(examples: list[tuple[str, int]]) -> Field:
    labels = [y for _, y in examples]
    n_toxic, n_clean = sum(labels), len(labels) - sum(labels)
    model = Field()
    if not n_toxic or not n_clean:
        return model
    words, texts = _coded(t for t, _ in examples)
    is_end = np.array([w in _ENDS for w in words])
    name_of: dict[str, int] = {}
    of_word = np.array([[name_of.setdefault(f, len(name_of)) for f in features_of(w)] for w in words], np.int32)
    names = list(name_of)
    del name_of
    counts = np.zeros((2, len(names)), np.int64)
    pairs = []
    for text, y in zip(texts, labels, strict=True):
        real = text[~is_end[text]]
        counts[y][np.unique(of_word[real])] += 1
        if y:  # each feature with the token before it
            before = np.append(-1, text[:-1])[~is_end[text]].astype(np.int64) + 1
            pairs.append(np.unique(before[:, None] * len(names) + of_word[real]))
    around = np.bincount(np.unique(np.concatenate(pairs)) % len(names), minlength=len(names))
    some = np.flatnonzero(counts[1] > 1)
    ratios = np.zeros(len(names))
    ratios[some] = [_ratio(int(counts[1][f]), int(counts[0][f]), n_toxic, n_clean) for f in some]
    # Copies of one toxic text repeat all its words, but in the same company.
    tied = (ratios > TIED) & (counts[1] >= PURE * counts.sum(0)) & (around >= CONTEXTS)
    used = some
    number = np.zeros(len(names), np.int32)
    number[used] = np.arange(len(used)) + 1

    # Every step sees the chains with a tied word, from documents of either kind, and one block of the
    # others, each of which stands for one of every block.
    tied_word = tied[of_word].any(1) & ~is_end
    tokens = np.concatenate(texts)
    toxic = np.repeat(np.array(labels, bool), [len(t) for t in texts])
    starts, lengths = chains(is_end[tokens])
    tied_before = np.concatenate([[0], np.cumsum(tied_word[tokens])])
    hot = tied_before[starts + lengths] > tied_before[starts]
    gold_of = tied_word[tokens] & toxic
    if not gold_of.any():
        return model
    plain = np.flatnonzero(~hot)
    n_blocks = max(1, -(-len(plain) // BLOCK))
    part = [(starts[c], lengths[c]) for c in (np.flatnonzero(hot), *(plain[b::n_blocks] for b in range(n_blocks)))]
    n = float(lengths.sum())
    # Adaptive steps along the gradient: features, then bias, start and transitions.
    w = np.zeros(len(used) + 1 + 5)
    w[-5] = np.log(max(1.0, gold_of.sum()) / n)
    squares = np.zeros(len(w))
    for step in range(max(ROUNDS, n_blocks)):
        model.bias, model.start, model.steps = w[-5], w[-4], tuple(w[-3:])
        g = np.zeros(len(w))
        for which, times in ((0, 1.0), (1 + step % n_blocks, float(n_blocks))):
            s, k = part[which]
            # The chains side by side, one empty token after each.
            first = np.concatenate([[0], np.cumsum(k + 1)])
            take = np.arange(first[-1]) - np.repeat(first[:-1], k + 1) + np.repeat(s, k + 1)
            real = np.ones(len(take), bool)
            real[first[1:] - 1] = False
            take[~real] = 0
            ids = number[of_word[tokens[take]]] * real[:, None]
            gold = (gold_of[take] & real).astype(float)
            p, expected = passes(w[: len(used) + 1][ids].sum(1) + model.bias, first[:-1], k, model, real.astype(float))
            miss = (gold - p) * real * times
            g[: len(used) + 1] += np.bincount(ids.ravel(), np.repeat(miss, 3), len(used) + 1)
            g[-5] += miss.sum()
            g[-4] += miss[first[:-1]].sum()
            a, z, link = gold[:-1], gold[1:], real[:-1] & real[1:]
            seen = np.array([(link * (1 - a) * z).sum(), (link * a * (1 - z)).sum(), (link * a * z).sum()])
            g[-3:] += (seen - expected) * times
        g[0] = 0
        g -= PENALTY * n * np.concatenate([np.full(len(used) + 1, 1e-2), np.zeros(5)]) * w
        squares = 0.9 * squares + 0.1 * g * g
        w += STEP * g / (np.sqrt(squares) + 1e-6)
        w = np.clip(w, -15, 15)
    model.bias, model.start, model.steps = float(w[-5]), float(w[-4]), tuple(map(float, w[-3:]))
    model.weights = {names[f]: float(x) for f, x in zip(used, w[1:], strict=False) if abs(x) > 1e-6}

    # The score, by a few Newton steps of penalised logistic regression.
    measure = Measure(model)
    del texts, tokens, toxic, pairs
    x = np.array([m[:2] for i in range(0, len(examples), 500) for m in measure.documents([t for t, _ in examples[i : i + 500]])])
    x, y = np.column_stack([np.ones(len(x)), x]), np.array(labels, float)
    b = np.zeros(3)
    for _ in range(25):
        q = sigmoid(x @ b)
        h = (x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(3)
        b = b + np.linalg.solve(h, x.T @ (y - q) - 0.1 * b)
    model.score = tuple(map(float, b))
    return model


# --- Scoring -----------------------------------------------------------------------------


class Measure:
    """Marginals of documents; remembers the scores of words it has met, up to a bound."""

    def __init__(self, model: Field, most: int = 400_000):
        self.model, self.most = model, most
        self.seen = dict.fromkeys(_ENDS, np.nan)

    def _word(self, word: str) -> float:
        if len(self.seen) >= self.most:
            self.seen = dict.fromkeys(_ENDS, np.nan)
        e = self.seen[word] = self.model.emission(word.lower())
        return e

    def documents(self, texts: list[str | None]) -> list[tuple[float, float, list[tuple[int, int, float]]]]:
        """Largest marginal, damped sum of squares, and toxic spans of each text."""
        word, sizes, parts = self._word, [], []
        for t in texts:
            get = self.seen.get
            found = [get(w) or word(w) for w in _TOKENS.findall(t or "")]
            parts.append(np.array([*found, np.nan]))
            sizes.append(len(found) + 1)
        e = np.concatenate(parts) if parts else np.zeros(0)
        ends = np.isnan(e)
        p, _ = passes(np.where(ends, 0.0, e), *chains(ends), self.model)
        cuts = np.cumsum([0, *sizes])[:-1]
        tops = np.maximum.reduceat(p, cuts) if len(cuts) else []
        sums = np.log1p(np.add.reduceat(p * p, cuts)) if len(cuts) else []
        out = []
        for t, at, n, top, total in zip(texts, cuts, sizes, tops, sums, strict=True):
            spans = []
            if top >= SPAN:
                mine = p[at : at + n]
                spans = [(m.start(), m.end(), float(v)) for m, v in zip(_TOKENS.finditer(t), mine[:-1], strict=True) if v >= SPAN]
            out.append((float(top), float(total), spans))
        return out


def fit(labelled: DataFrame) -> Field:
    """The field learned from the rows ``(text, label)``, a bounded number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            examples += zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True)
        m = train(examples)
        flat = {"bias": m.bias, "start": m.start}
        flat |= {f"step{i}": v for i, v in enumerate(m.steps)} | {f"score{i}": v for i, v in enumerate(m.score)}
        names, values = [*flat, *m.weights], [*flat.values(), *m.weights.values()]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(values, pa.float64())], ["name", "value"])

    chosen = labelled.repartition(1).sortWithinPartitions(F.xxhash64("text", F.lit(23)), "label")
    got = dict(map(tuple, chosen.mapInArrow(run, "name string, value double").collect()))  # as many as the sample has features
    if not got:
        return Field()
    own = [got.pop(n) for n in ("bias", "start", "step0", "step1", "step2", "score0", "score1", "score2")]
    return Field(got, own[0], own[1], tuple(own[2:5]), tuple(own[5:]))


def score_all(docs: DataFrame, model: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(doc_id, score, spans)``; spans are (start, end, probability) in characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held: dict[str, Measure] = {}
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        measure = held.setdefault("it", Measure(shared.value))
        a, b, c = measure.model.score
        found = measure.documents(batch.column("text").to_pylist())
        scores = [float(sigmoid(a + b * top + c * total)) for top, total, _ in found]
        spans = [[{"start": s, "end": e, "p": p} for s, e, p in x] for _, _, x in found]
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(scores, pa.float64()), pa.array(spans, spans_type)], ["id", "score", "spans"]
        )

    given = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    schema = f"id {kind}, score double, spans array<struct<start: int, end: int, p: double>>"
    return arrow_map(given, per_batch, schema, "text").withColumnRenamed("id", doc_id)


def tag(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    learn: Column | None = None,
    rows: int = TRAIN_ROWS,
    most_bytes: int = TRAIN_BYTES,
) -> DataFrame:
    """Rows ``(doc_id, score, spans)`` for every document; ``learn``, a condition on the id, says
    which labels may be used."""
    learn = F.lit(True) if learn is None else learn
    chosen = labelled_texts(docs, labels, label, learn, rows, doc_id, text, most_bytes)
    return score_all(docs, fit(chosen), doc_id, text)
