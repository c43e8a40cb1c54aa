"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: what counts as a word --------------------------------------
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Bytes of text that a Python worker takes at a time; longer texts come alone.
BATCH_BYTES = 4 << 20

ASCII_LOWER = str.maketrans(UPPER, LOWER)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not use yet, whatever their case."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def text_of(column: str) -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sized_broadcast(df: DataFrame, most: int, width: Column | None = None) -> DataFrame:
    """``df`` to be broadcast if it is known to be small: at most ``most`` rows, or with
    ``width``, a number for each row, at most that many in all.

    Beyond that the join is a shuffle join and gives the same rows.  ``df``
    should be stored, since it is read to be counted."""
    if width is None:
        return F.broadcast(df) if df.limit(most + 1).count() <= most else df
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= most else df


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``, so that
    what a worker holds does not depend on how long texts happen to be."""
    for batch in batches:
        start, held = 0, 0
        for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            held += n or 0
            if held >= most:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends Python workers batches of that size too; by default
    it would hold 10,000 rows or 64 MB of texts for each task, beside its heap."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def arrow_map(df: DataFrame, per_batch: Callable, schema: str, column: str) -> DataFrame:
    """``mapInArrow`` over bounded batches; ``per_batch`` returns a table or batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            out = per_batch(batch)
            yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return small_batches(df).mapInArrow(run, schema)
