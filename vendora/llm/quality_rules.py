"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a count in the text itself; every rule compares two counts with
whole-number arithmetic, so no verdict depends on rounding.  There is no
shuffle, no join and no user function: measures and verdict are worked out
row by row in the scan of the documents.  Three-word windows of one text are told
apart by 64-bit hashes.

Defined results: null and empty texts have no words and fail ``min_words``; a
repeated row gets the same verdict each time; an empty table gives an empty
result; other columns of the input, whatever their names, are neither read nor
changed.  Texts of any length are measured whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendora.llm.common import WHITE, WORD, fresh, let, text_of, words_of

# --- Fixed values -------------------------------------------------------------
SYMBOLS = "#*$%&|<>"
STOP_WORDS = [
    # English
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "he", "in", "is", "it", "of", "on", "or",
    "that", "the", "this", "to", "was", "with",
    # French
    "au", "avec", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "ne", "par", "pas", "pour",
    "que", "qui", "sur", "un", "une",
    # German
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    # Spanish
    "como", "con", "del", "el", "las", "los", "no", "por", "se", "su", "una", "y",
]


@dataclass(frozen=True)
class Rule:
    """Fails unless ``low * per <= 100 * count <= high * per`` (bounds may be absent)."""

    name: str
    count: str
    per: str | None
    low: int | None = None
    high: int | None = None

    def failed(self, measure: dict[str, Column]) -> Column:
        count, per = measure[self.count], measure[self.per] if self.per else F.lit(100)
        tests = []
        if self.low is not None:
            tests.append(100 * count < self.low * per)
        if self.high is not None:
            tests.append(100 * count > self.high * per)
        return reduce(or_, tests)


# ``low`` and ``high`` are plain counts without ``per``, else a count per hundred of it.
BASE_RULES = [
    Rule("min_words", "n_words", None, low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=50),
]
RULES = [
    Rule("word_length", "word_chars", "n_words", low=200, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=25),
    Rule("stop_words", "n_stop_words", "n_words", low=4),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=50),
]


MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines",
]


def with_measures(docs: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """Add the counts of the column ``text`` under the given names."""
    t, w, g, n = fresh(docs, "_t", "_w", "_g", "_n")
    # Each step is used several times by the next, so it is worked out once.
    df = docs.withColumn(t, text_of(text)).withColumn(w, words_of(F.col(t)))
    windows = F.slice(F.col(w), F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
    df = df.withColumn(
        g, F.transform(windows, lambda x, i: F.xxhash64(x, F.get(F.col(w), i + 1), F.get(F.col(w), i + 2)))
    ).withColumn(n, F.filter(F.split(F.col(t), "\n", -1), lambda x: x.rlike(WORD)))
    measures = {
        "n_words": F.size(w),
        "word_chars": F.length(F.translate(F.col(t), WHITE, "")),
        "n_symbols": F.length(t) - F.length(F.translate(F.col(t), SYMBOLS, "")),
        "n_dup_lines": F.size(n) - F.size(F.array_distinct(n)),
        # Most texts repeat no window and need no closer look.
        "n_repeat_words": F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
            _repeat_words(F.col(g))
        ),
        "n_stop_words": F.size(F.filter(F.col(w), lambda x: F.lower(x).isin(STOP_WORDS))),
        "n_lines": F.size(n),
    }
    return df.withColumns({names[k]: c.cast("long") for k, c in measures.items()}).drop(t, w, g, n)


def _repeat_words(windows: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    A window is told by its 64-bit hash within one text.  Sorting puts equal
    windows side by side; the cost is that of one sort, however often a window
    repeats.
    """
    ordered = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("w"), i.alias("at"))))
    same = lambda a, x, i: F.coalesce(F.get(a, i)["w"] == x["w"], F.lit(False))
    starts = let(
        ordered,
        lambda a: F.sort_array(
            F.transform(F.filter(a, lambda x, i: same(a, x, i - 1) | same(a, x, i + 1)), lambda x: x["at"])
        ),
    )
    # Each window adds the words up to the next window's start, three at most.
    added = lambda s: F.transform(s, lambda p, i: F.least(F.coalesce(F.get(s, i + 1), p + 3) - p, F.lit(3)))
    return let(starts, lambda s: F.aggregate(added(s), F.lit(0), lambda a, x: a + x))


def verdict(measure: dict[str, Column], rules: list[Rule]) -> Column:
    """Names of the rules that fail, in the order of the table."""
    return F.filter(F.array(*[F.when(r.failed(measure), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())


def judge(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES, out: str = "quality") -> DataFrame:
    """Add the struct ``out``: every measure, ``base_failed``, ``kept`` and the names of failed rules."""
    names = dict(zip(MEASURES, fresh(docs, *[f"_{m}" for m in MEASURES]), strict=True))
    base, more = fresh(docs, "_base", "_more")
    df = with_measures(docs, text, names)
    measure = {k: F.col(v) for k, v in names.items()}
    df = df.withColumns({base: verdict(measure, BASE_RULES), more: verdict(measure, rules)})
    return df.withColumn(
        out,
        F.struct(
            *[c.alias(k) for k, c in measure.items()],
            (F.size(base) > 0).alias("base_failed"),
            (F.size(base) + F.size(more) == 0).alias("kept"),
            F.array_join(F.concat(base, more), ",").alias("failed_rules"),
        ),
    ).drop(base, more, *names.values())


def keep_good(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects, with all their columns.

    One row is generated for each document kept.  A filter would do the same, but
    the optimizer moves filters below projections and would write out every
    measure once more for each place that uses it."""
    q, one = fresh(docs, "_quality", "_one")
    times = F.array_repeat(F.lit(1), F.col(q)["kept"].cast("int"))
    return judge(docs, text, rules, q).withColumn(one, F.explode(times)).drop(q, one)
