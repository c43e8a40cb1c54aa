"""Checksums of groups of rows that no order of the rows changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str], salt: str | None = None) -> Column:
    """A hash of the columns' values; a hash passes over NULLs, so which of them are NULL is hashed too.

    Another ``salt`` gives another hash."""
    start = [] if salt is None else [F.lit(salt)]
    return F.xxhash64(*start, *columns, *[F.col(c).isNull() for c in columns])


def hash_sum(columns: Sequence[str]) -> Column:
    """The sum of the rows' hashes; tasks add up before a shuffle."""
    return F.sum(row_hash(columns).cast("decimal(38,0)"))
