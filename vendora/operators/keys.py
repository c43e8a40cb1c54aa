"""Keys that rows are matched by."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def unusable(rows: DataFrame, key: str) -> Row | None:
    """A key that is missing or comes twice, if there is one; copies are combined before they are shuffled."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return next(iter(counts.filter((F.col("n") > 1) | F.col(key).isNull()).limit(1).collect()), None)


def reject_unusable(rows: DataFrame, key: str, what: str) -> None:
    """Raise if a key is missing or comes twice."""
    bad = unusable(rows, key)
    if bad:
        found = bad[key]
        raise ValueError(f"{key} is {'NULL' if found is None else f'not unique ({found!r})'} in the {what}")
