"""Finding benchmark passages in documents with a positional inverted index.

0. **Pieces.** Of windows of the same words an item keeps the first; each run of kept windows is a
   piece that stands for the item.  Most items are one piece.  An item that repeats itself, held
   against a document that does, would else agree at every place with every place.
1. **Index.** Every document is cut into words; the positions of words that some
   benchmark item uses are stored as postings ``(document, position, term)``.
   Documents are neither shuffled nor collected, but for one of each group of repeated
   rows: a posting list lies spread over the files, in document order.
2. **Rarest terms.** Counts from the index rank the words of each window of ten
   item words.  The rarest word anchors the window.  Neighbouring windows share
   their anchor, so an item has few.  A window with a word that the index lacks
   occurs nowhere as a phrase; its other words, two at least, are ranked for proximity.
3. **Intersection.** Each posting of an anchor proposes an alignment (item,
   document, shift).  It is kept if the second rarest word of a window stands at
   its place: an equality join of proposals with that word's postings, so work
   follows the rarer list and never a product of lists.  The same join finds
   second words a few places off: those items are proximity matches.
4. **Phrases.** Kept alignments, for each document and piece a list of shifts beside the words once,
   are compared with the document word by word.  All words inside any window that agrees in
   full are hit.

Only DataFrame functions are used.  What is broadcast is counted first
(``BROADCAST_WORDS``); beyond the bound the same joins shuffle.

Defined results: null and empty texts have no words and are clean; items without
words match nothing; repeated documents each get their row, repeated items count
once by id and items of the same text each count; null ids of items are not
counted; empty tables give empty or clean results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendora.llm.common import LOWER, UPPER, fresh, let, sized_broadcast, text_of
from vendora.session import settle

# --- Fixed value: what stands between words, the words being lower-cased ---------
BETWEEN = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

WINDOW = 10
# Words that a proximity match may be off its place.
SLOP = 5
# Most words, in all rows together, of a table that is broadcast: about 15 MB.
BROADCAST_WORDS = 500_000
# Most repeated (id, key) that are broadcast: about 10 MB.
REPEATED_ROWS = 200_000


def words(text: str) -> Column:
    """The words of the lower-cased text; cutting at spaces is cheaper than a pattern."""
    spaced = F.translate(text_of(text), UPPER + BETWEEN, LOWER + " " * len(BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def _key(text: str) -> Column:
    """Tells apart texts that share an id; copies of a row share it."""
    return F.xxhash64(text_of(text))


def distinct_rows(docs: DataFrame) -> DataFrame:
    """``docs (id, key, text)`` with one row for each id and key; only texts of repeated
    rows are shuffled, one a task."""
    repeated = settle(docs.groupBy("id", "key").agg(F.count("*").alias("n")).filter("n > 1").select("id", "key"), "repeated")
    d, r = docs.alias("d"), sized_broadcast(repeated, REPEATED_ROWS).alias("r")
    same = F.col("d.id").eqNullSafe(F.col("r.id")) & (F.col("d.key") == F.col("r.key"))
    folded = d.join(r, same, "left_semi").groupBy("id", "key").agg(F.max("text").alias("text"))
    return d.join(r, same, "left_anti").unionByName(folded)


def pieces(benchmark: DataFrame, item_id: str, item_text: str, window: int) -> DataFrame:
    """Rows ``(item, item_id, words)``: for each item the runs of its windows that are not copies of
    earlier ones."""
    given = (
        benchmark.select(F.col(item_id).cast("string").alias("item_id"), words(item_text).alias("words"))
        .filter(F.size("words") > 0)
        .distinct()
        .withColumn("whole", F.xxhash64("item_id", "words"))
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    kept = (
        given.select("whole", F.posexplode(F.transform(starts, lambda s: F.slice("words", s + 1, window))).alias("s", "held"))
        .groupBy("whole", "held")
        .agg(F.min("s").alias("s"))
    )
    # At most as many rows as the item has words.
    along = W.partitionBy("whole").orderBy("s")
    runs = (
        kept.select("whole", "s", (F.col("s") - F.row_number().over(along)).alias("run"))
        .groupBy("whole", "run")
        .agg(F.min("s").alias("low"), F.max("s").alias("high"))
    )
    piece = F.slice("words", F.col("low") + 1, F.col("high") - F.col("low") + window)
    return (
        given.join(runs, "whole")
        .select("item_id", piece.alias("words"))
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "words"))
    )


def build_index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored postings ``(id, key, pos, term)`` of the given terms; repeated rows have them once."""
    given = docs.select(F.col(doc_id).alias("id"), _key(text).alias("key"), F.col(text).alias("text"))
    tokens = distinct_rows(given).select("id", "key", F.posexplode(words("text")).alias("pos", "term"))
    return settle(tokens.join(sized_broadcast(terms, BROADCAST_WORDS), "term").select("id", "key", "pos", "term"), "postings")


def _anchors(items: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """Rows ``(item, at, term, seconds)``: the rarest word of some window, at its
    place in the item, with the places and terms of those windows' second words, and
    whether the index has all words of such a window."""
    counts = index.groupBy("term").agg(F.count("*").alias("n"))
    placed = items.select("item", F.posexplode("words").alias("at", "term"))
    ranked = (
        placed.join(counts, "term", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .groupBy("item")
        .agg(F.sort_array(F.collect_list(F.struct("at", "n", "term"))).alias("w"))
    )
    inside = F.slice("w", F.col("s") + 1, window)
    indexed = F.filter(inside, lambda x: x["n"] > 0)
    by_rarity = F.sort_array(
        F.transform(indexed, lambda x: F.struct(x["n"].alias("n"), x["at"].alias("at"), x["term"].alias("term")))
    )
    windows = (
        ranked.withColumn("s", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))))
        .select("item", by_rarity.alias("r"), (F.size(indexed) == F.size(inside)).alias("whole"))
        .filter((F.size("r") > 1) | ((F.size("r") == 1) & F.col("whole")))
    )
    second = F.get("r", F.lit(1))
    return (
        windows.groupBy(
            "item",
            F.col("r")[0]["at"].alias("at"),
            F.col("r")[0]["term"].alias("term"),
            second["at"].alias("at2"),
            second["term"].alias("term2"),
        )
        .agg(F.max("whole").alias("whole"))
        .groupBy("item", "at", "term")
        .agg(F.collect_list(F.struct(F.col("at2").alias("at"), F.col("term2").alias("term"), "whole")).alias("seconds"))
    )


def _alignments(index: DataFrame, anchors: DataFrame, slop: int) -> DataFrame:
    """Rows ``(id, key, item, shift, exact)``: item word ``i`` would be document word ``i + shift``."""
    proposed = (
        index.join(sized_broadcast(anchors, BROADCAST_WORDS, F.size("seconds") + 1), "term")
        .select("id", "key", "item", (F.col("pos") - F.col("at")).alias("shift"), F.explode("seconds").alias("b"))
        .select(
            "id", "key", "item", "shift", F.col("b.term").alias("term"), (F.col("shift") + F.col("b.at")).alias("due"), "b.whole"
        )
    )
    step = slop + 1
    wanted = anchors.select(F.explode("seconds.term").alias("term")).filter("term IS NOT NULL").distinct()
    lists = index.join(sized_broadcast(wanted, BROADCAST_WORDS), "term", "left_semi").select(
        "id", "key", "pos", "term", F.floor(F.col("pos") / step).alias("cell")
    )
    cell = F.floor(F.col("due") / step)
    meets = [F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in ("id", "key", "term", "cell")]
    near = (
        proposed.filter("term IS NOT NULL")
        .withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
        .alias("p")
        .join(lists.alias("q"), meets)
        .filter(F.abs(F.col("due") - F.col("pos")) <= slop)
        .select("p.id", "p.key", "item", "shift", (F.col("whole") & (F.col("due") == F.col("pos"))).alias("exact"))
    )
    # Windows of one word have no second list to meet.
    alone = proposed.filter("term IS NULL").select("id", "key", "item", "shift", F.lit(True).alias("exact"))
    return near.unionByName(alone).groupBy("id", "key", "item", "shift").agg(F.max("exact").alias("exact"))


def match(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slop: int = SLOP,
) -> DataFrame:
    """Per document its id, key of the text, ``n_words``, ``hits`` (item id, start
    and length in words of each phrase match) and ``near_items`` (ids of items with a
    proximity match)."""
    items = settle(pieces(benchmark, item_id, item_text, window), "items")
    index = build_index(docs, items.select(F.explode("words").alias("term")).distinct(), doc_id, text)
    anchors = settle(_anchors(items, index, window), "anchors")
    found = (
        _alignments(index, anchors, slop)
        .groupBy("id", "key", "item")
        .agg(F.collect_list(F.when(F.col("exact"), F.col("shift"))).alias("shifts"))
    )
    of_doc = (
        found.join(sized_broadcast(items, BROADCAST_WORDS, F.size("words") + 1), "item")
        .groupBy("id", "key")
        .agg(
            F.collect_list(F.when(F.size("shifts") > 0, F.struct("item_id", "shifts", "words"))).alias("tries"),
            F.array_sort(F.collect_set("item_id")).alias("near_items"),
        )
    )
    tried = settle(of_doc, "alignments")
    d = docs.select(F.col(doc_id).alias("id"), _key(text).alias("key"), F.col(text).alias("text"))
    on = d["id"].eqNullSafe(tried["id"]) & (d["key"] == tried["key"])
    listed = F.aggregate("tries", F.lit(0), lambda n, t: n + F.size(t["words"]) + F.size(t["shifts"]))
    held = listed + F.size("near_items") + 1
    both = d.join(sized_broadcast(tried, BROADCAST_WORDS, held), on, "left").select(d["id"], d["key"], words("text").alias("w"), "tries", "near_items")
    return both.select(
        "id",
        "key",
        F.size("w").alias("n_words"),
        F.coalesce(F.flatten(F.transform("tries", lambda t: _phrases(F.col("w"), t, window))), F.array()).alias("hits"),
        F.coalesce("near_items", F.array()).alias("near_items"),
    )


def _phrases(w: Column, t: Column, window: int) -> Column:
    """Windows of the piece in ``t`` that agree with the words ``w`` in full, at any of its shifts."""
    length = F.least(F.size(t["words"]), F.lit(window))
    at = lambda p: F.when(p >= 0, F.get(w, p))

    def here(shift: Column) -> Column:
        agrees = F.transform(t["words"], lambda x, i: F.coalesce(at(shift + i) == x, F.lit(False)))
        starts = let(
            agrees,
            lambda a: F.filter(
                F.sequence(F.lit(0), F.size(a) - length), lambda s: F.forall(F.slice(a, s + 1, length), lambda x: x)
            ),
        )
        return F.transform(
            starts, lambda s: F.struct(t["item_id"].alias("item_id"), (shift + s).alias("start"), length.alias("length"))
        )

    return F.flatten(F.transform(t["shifts"], here))


def _covered(hits: Column) -> Column:
    """How many words lie in any of the hits."""
    spans = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"].alias("low"), (h["start"] + h["length"]).alias("high"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("high"))

    def add(so_far: Column, x: Column) -> Column:
        high = F.greatest(so_far["high"], x["high"])
        new = high - F.least(F.greatest(so_far["high"], x["low"]), high)
        return F.struct((so_far["n"] + new).alias("n"), high.alias("high"))

    return F.aggregate(spans, start, add, lambda x: x["n"])


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """Per document: words, words hit, items with phrase matches, their digest, and the verdict."""
    items = F.array_sort(F.array_distinct(F.filter(F.transform("hits", lambda h: h["item_id"]), lambda x: x.isNotNull())))
    return match(docs, benchmark, doc_id, text, **more).select(
        F.col("id").alias(doc_id),
        F.col("n_words").cast("long").alias("n_words"),
        _covered(F.col("hits")).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size(F.array_except("near_items", items)).cast("long").alias("n_near_items"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without a phrase match, with all their columns."""
    id_, key = fresh(docs, "_id", "_key")
    bad = (
        match(docs, benchmark, doc_id, text)
        .filter(F.size("hits") > 0)
        .select(F.col("id").alias(id_), F.col("key").alias(key))
        .distinct()
    )
    same = F.col(doc_id).eqNullSafe(F.col(id_)) & (_key(text) == F.col(key))
    return docs.join(sized_broadcast(settle(bad, "contaminated"), REPEATED_ROWS), same, "left_anti")
