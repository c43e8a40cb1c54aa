"""Document quality by logistic regression on hashed word n-grams.

Tokens are runs of word characters and runs of signs.  Features are hashed tokens and
pairs of neighbours, and one more for each three-token window that the text has had
before, all as shares of the text's tokens.  Weights are learned by the
follow-the-regularised-leader rule with L1 and L2 terms, one example after the
other, from about ``TRAIN_ROWS`` labelled documents and ``TRAIN_BYTES`` of their text at most,
chosen by hash (both bounds are parameters).  Scoring covers every document: a sparse dot product of its
features with the weights, which are ``2 ** WIDTH`` numbers whatever the data's size.

Defined results: null and empty texts have no features and get the bias' score; rows
without a label, or whose label has no document, teach nothing; a repeated label counts once, and
ids whose labels disagree teach nothing; of documents that share an id the greatest text is learned
from; with no labels at all every score is 0.5; repeated rows score alike; an empty table gives an empty
result; other columns are not read.  Only the text enters a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendora.llm.common import arrow_map
from vendora.session import settle

WIDTH = 18
TRAIN_ROWS = 12_000
# Bytes of labelled texts; beyond them no text of over a 64th of that is learned from.
TRAIN_BYTES = 64 << 20
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.6, 1.0, 1e-3, 1e-4
# Features are shares of a few hundredths; this brings a common one to about 1.
SCALE = 30.0

_TOKENS = re.compile(r"\w+|[^\w\s]+")
_AGAIN = 1
_BIAS = 0


class Hasher:
    """Feature numbers of texts; remembers the hashes of words it has met, up to a bound."""

    def __init__(self, width: int, most: int = 400_000):
        self.mask, self.most, self.seen = (1 << width) - 1, most, {}

    def _word(self, word: str) -> int:
        if len(self.seen) >= self.most:
            self.seen.clear()
        h = self.seen[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h

    def features(self, text: str | None) -> np.ndarray:
        """One number for every token, pair and repeated window of the text."""
        get, word = self.seen.get, self._word
        hashes = [get(w) or word(w) for w in _TOKENS.findall((text or "").lower())]
        h = np.array(hashes, np.uint64)
        pairs = h[:-1] * np.uint64(0x9E3779B1) + h[1:]
        threes = pairs[:-1] * np.uint64(0x85EBCA6B) + h[2:]
        again = len(threes) - len(np.unique(threes))
        grams = np.concatenate([h, (pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)])
        # The first two numbers are the bias and the repeats.
        found = (grams & np.uint64(self.mask)).astype(np.int64)
        return np.concatenate([np.maximum(found, 2), np.full(again, _AGAIN)])


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def train(examples: list[tuple[np.ndarray, int]], width: int = WIDTH, epochs: int = EPOCHS) -> np.ndarray:
    """Weights by follow-the-regularised-leader over (features, label)."""
    z, n = np.zeros(1 << width), np.zeros(1 << width)
    packed = []
    for features, label in examples:
        at, times = np.unique(features, return_counts=True)
        packed.append((np.append(at, _BIAS), np.append(SCALE * times / max(1, len(features)), 1.0), label))

    def weights(at):
        zs = z[at]
        w = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zs) <= L1, 0.0, w)

    for _ in range(epochs):
        for at, x, label in packed:
            w = weights(at)
            g = (sigmoid(w @ x) - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(1 << width))


def score(weights: np.ndarray, features: np.ndarray) -> float:
    mean = weights[features].sum() / max(1, len(features))
    return float(sigmoid(weights[_BIAS] + SCALE * mean))


def fit(labelled: DataFrame, width: int = WIDTH, epochs: int = EPOCHS) -> np.ndarray:
    """Weights learned from the rows ``(text, label)``, a bounded number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, examples = Hasher(width), []
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                examples.append((hasher.features(text), label))
        w = train(examples, width, epochs)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["at", "w"])

    # The rows' order decides how examples follow each other, so it is fixed.
    chosen = labelled.repartition(1).sortWithinPartitions(F.xxhash64("text", F.lit(23)), "label")
    weights = np.zeros(1 << width)
    for at, w in chosen.mapInArrow(run, "at long, w double").collect():  # as many as there are features
        weights[at] = w
    return weights


def labelled_texts(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    rows: int,
    doc_id: str = "doc_id",
    text: str = "text",
    most_bytes: int = TRAIN_BYTES,
) -> DataFrame:
    """Rows ``(text, label)`` of about ``rows`` documents and ``most_bytes`` of text at most, of those with
    a label of 0 or 1 that may be learned from.

    Label rows are folded to one for each id before they are counted and sampled, so that what is broadcast
    has a bound however often an id comes; so are the documents found.  Texts of the sample alone are shuffled."""
    marks = labels.filter(learn & F.col(label).cast("int").isin(0, 1) & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("_labelled"), F.col(label).cast("int").alias("label")
    )
    folded = marks.groupBy("_labelled").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    marks = settle(folded.filter("label = other").drop("other"), "marks")
    n = marks.count()
    if n > rows:
        marks = marks.filter(F.pmod(F.xxhash64("_labelled", F.lit(11)), F.lit(n)) < rows)
    texts = docs.select(F.col(doc_id).alias("_doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(marks), F.col("_doc") == F.col("_labelled"))
    chosen = settle(found.groupBy("_labelled").agg(F.max("text").alias("text"), F.max("label").alias("label")), "labelled")
    held = F.octet_length("text")
    if (chosen.agg(F.sum(held)).first()[0] or 0) > most_bytes:
        # About `rows` numbers; texts that would push out many others are passed over.
        along = W.orderBy(F.xxhash64("_labelled", F.lit(17)), "_labelled").rowsBetween(W.unboundedPreceding, 0)
        sizes = chosen.select("_labelled", held.alias("held")).filter(F.col("held") <= most_bytes // 64)
        fits = sizes.withColumn("so_far", F.sum("held").over(along)).filter(F.col("so_far") <= most_bytes)
        chosen = chosen.join(F.broadcast(fits.select("_labelled")), "_labelled", "left_semi")
    return chosen.select("text", "label")


def remainder(doc_id: str, by: int) -> Column:
    """The rest of the crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % by


def score_all(docs: DataFrame, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Rows ``(doc_id, score)``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))
    held: dict[str, Hasher] = {}

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        hasher = held.setdefault("it", Hasher(width))
        w = shared.value
        found = [score(w, hasher.features(t)) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.float64())], ["id", "score"])

    given = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return arrow_map(given, per_batch, f"id {kind}, score double", "text").withColumnRenamed("id", doc_id)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    learn: Column | None = None,
    rows: int = TRAIN_ROWS,
    most_bytes: int = TRAIN_BYTES,
) -> DataFrame:
    """Rows ``(doc_id, score)`` for every document; ``learn``, a condition on the id, says
    which labels may be used."""
    learn = F.lit(True) if learn is None else learn
    chosen = labelled_texts(docs, labels, label, learn, rows, doc_id, text, most_bytes)
    return score_all(docs, fit(chosen), doc_id, text)
