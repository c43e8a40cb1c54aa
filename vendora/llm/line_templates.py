"""Dropping boilerplate lines by a log-template tree.

A line goes down a tree of fixed depth: first by its number of words, then by its
leading words.  Words with a digit are variable from the start.  In a leaf, a word
at a place is **constant** if at least ``MIN_DOCS`` documents have it there; other words
are variable fields.  A line fits the leaf's template if enough of its words are
constant (``SIMILARITY``), one behind the leading words at least: those are the same
in the whole leaf and say nothing of the lines in it.  Its variable words are then
generalised to the leaf's most frequent word of the place, or to a wildcard where no
word is frequent.  A line that fits no template stands for itself.

A template that ``MIN_DOCS`` different texts contain is recurring.  Its lines are
dropped, but for those of the first document (by id), so that the text is not lost
altogether.  Copies of a whole document are one text here: removing them is the work of
the near-duplicate stage, and a document does not lose its lines to its own copies.

Everything is counted by hashes of lines in aggregations that combine before
they shuffle, so a line that a third of all documents share is one row per
task.  Words are exploded only for the distinct lines of leaves with several lines.
No leaf, template or document list is ever gathered in one place.

Defined results: null texts stay null; lines without a word stay; a text whose lines
all go becomes empty; documents are never removed; among equal ids the order of
the text's hash decides; null ids come last; repeated rows are treated alike; an empty
table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendora.llm.common import WHITE, WORD, fresh, sized_broadcast
from vendora.session import settle

WILDCARD = "<*>"
DEPTH = 3
MIN_DOCS = 3
SIMILARITY = 0.6
# Most rows of a table that is broadcast; such rows hold hashes and ids only, 100 bytes
# at most, so that is 20 MB.
BROADCAST_ROWS = 200_000

LINE = ["leaf", "h1", "h2"]


def tokens(line: Column) -> Column:
    digits = r"[^\x20\x09-\x0D0-9]*[0-9][^\x20\x09-\x0D]*"
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, digits, WILDCARD)).otherwise(line)
    return F.array_remove(F.split(F.translate(masked, WHITE, " " * len(WHITE)), " "), "")


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def _identity(words: Column) -> list[Column]:
    """Two hashes that tell lines apart; words are joined by what no word holds."""
    line = F.array_join(words, " ")
    return [F.xxhash64(line).alias("h1"), F.hash(line).alias("h2")]


def _lines(docs: DataFrame) -> DataFrame:
    """Rows ``(id, key, words)``: the different lines of each document of ``docs (id, key, text)``."""
    lines = F.array_distinct(F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)))
    return docs.select("id", "key", F.explode(lines).alias("line")).select("id", "key", tokens(F.col("line")).alias("words"))


def parse(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Rows ``(id, key, leaf, h1, h2)``: the leaf and identity of every line."""
    leaf = F.xxhash64(F.size("words"), F.slice("words", 1, depth)).alias("leaf")
    return _lines(docs).select("id", "key", leaf, *_identity(F.col("words")))


def _counted(lines: DataFrame, by: list[str]) -> DataFrame:
    """Add up different texts and find the first (id, key) of each group."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    return lines.groupBy(*by).agg(F.count_distinct("key").alias("docs"), first)


def generalise(docs: DataFrame, counted: DataFrame, depth: int, min_docs: int, similarity: float) -> DataFrame:
    """Rows ``(leaf, h1, h2, template, t1, t2)`` for lines that fit a template of their leaf;
    the last two are hashes of the template."""
    leaves = (
        counted.groupBy("leaf")
        .agg(F.count("*").alias("n"), F.sum("docs").alias("docs"))
        .filter((F.col("n") > 1) & (F.col("docs") >= min_docs))
    )
    several = settle(counted.join(leaves.select("leaf"), "leaf", "left_semi"), "leaf_lines")
    # A line's words are read from the first document that has it.
    hosts = several.select(F.col("first.id").alias("host"), F.col("first.key").alias("host_key")).distinct()
    same = F.col("id").eqNullSafe(F.col("host")) & (F.col("key") == F.col("host_key"))
    found = _lines(docs.join(sized_broadcast(hosts, BROADCAST_ROWS), same, "left_semi")).select(
        "words", *_identity(F.col("words")), F.xxhash64(F.size("words"), F.slice("words", 1, depth)).alias("leaf")
    )
    lines = settle(
        found.join(sized_broadcast(several.select(*LINE, "docs"), BROADCAST_ROWS), LINE)
        .groupBy(*LINE)
        .agg(F.any_value("words").alias("words"), F.any_value("docs").alias("docs")),
        "leaf_words",
    )
    each = lines.select(*LINE, "docs", F.posexplode("words").alias("at", "word"))
    constant = (
        each.groupBy("leaf", "at", "word").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    )
    usual = constant.groupBy("leaf", "at").agg(F.max_by("word", F.struct("docs", "word")).alias("usual"))
    settled = (
        each.drop("docs")
        .join(constant.withColumnRenamed("docs", "support"), ["leaf", "at", "word"], "left")
        .join(usual, ["leaf", "at"], "left")
    )
    fits = F.col("support").isNotNull()
    word = F.when(fits, F.col("word")).otherwise(F.coalesce("usual", F.lit(WILDCARD)))
    shape = F.sort_array(F.collect_list(F.struct("at", word.alias("word"))))
    return (
        settled.groupBy(*LINE)
        .agg(
            shape.alias("shape"),
            F.avg(fits.cast("double")).alias("share"),
            F.max(fits & (F.col("at") >= depth)).alias("behind"),
        )
        .filter((F.col("share") >= similarity) & F.col("behind"))
        .select(*LINE, F.array_join(F.transform("shape", lambda x: x["word"]), " ").alias("template"))
        .withColumns({"t1": F.xxhash64("template"), "t2": F.hash("template")})
    )


def recurring(
    docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY
) -> tuple[DataFrame, DataFrame]:
    """All lines of ``docs (id, key, text)``, and rows ``(leaf, h1, h2, template, docs, first)`` of
    lines whose template recurs; ``template`` is null for a line that stands for itself."""
    lines = settle(parse(docs, depth), "lines")
    counted = settle(_counted(lines, LINE), "line_counts")
    shaped = settle(generalise(docs, counted, depth, min_docs, similarity), "templates")
    named = lines.join(sized_broadcast(shaped.select(*LINE, "t1", "t2"), BROADCAST_ROWS), LINE)
    # Stored apart, so that a template of very many lines is split in the join.
    groups = settle(_counted(named, ["leaf", "t1", "t2"]).filter(F.col("docs") >= min_docs), "template_counts")
    alike = shaped.join(sized_broadcast(groups, BROADCAST_ROWS), ["leaf", "t1", "t2"]).select(
        *LINE, "template", "docs", "first"
    )
    alone = counted.filter(F.col("docs") >= min_docs).join(shaped, LINE, "left_anti")
    return lines, settle(
        alike.unionByName(alone.select(*LINE, F.lit(None).cast("string").alias("template"), "docs", "first")), "recurring"
    )


def drop_recurring(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
    similarity: float = SIMILARITY,
    out: str | None = None,
) -> DataFrame:
    """The documents without their recurring lines; ``out`` names a column for the number dropped."""
    given = docs.select(
        F.col(doc_id).alias("id"), _key(F.col(text)).alias("key"), F.col(text).cast("string").alias("text")
    )
    lines, bad = recurring(given, depth, min_docs, similarity)
    i, k, gone, kept, n = fresh(docs, "_id", "_key", "_gone", "_kept", "_dropped")
    drops = (
        lines.join(sized_broadcast(bad.select(*LINE, F.col("first.key").alias("first_key")), BROADCAST_ROWS), LINE)
        .filter(F.col("first_key") != F.col("key"))
        .groupBy(F.col("id").alias(i), F.col("key").alias(k))
        .agg(F.collect_set(F.struct("h1", "h2")).alias(gone))
    )
    # A document's list is no longer than the document.
    found = docs.join(drops, F.col(doc_id).eqNullSafe(F.col(i)) & (_key(F.col(text)) == F.col(k)), "left")
    split = F.split(F.col(text), "\n", -1)
    left = F.filter(split, lambda x: ~F.array_contains(F.col(gone), F.struct(*_identity(tokens(x)))))
    found = found.withColumn(kept, F.when(F.col(gone).isNotNull(), left))
    changed = F.col(kept).isNotNull()
    found = found.withColumn(n, F.when(changed, F.size(split) - F.size(kept)).otherwise(0).cast("long"))
    columns = [
        F.when(changed, F.array_join(kept, "\n")).otherwise(F.col(text)).alias(c) if c == text else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return found.select(*columns, *([F.col(n).alias(out)] if out else []))
