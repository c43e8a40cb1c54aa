"""Row numbers, running sums, carried values and sizes within groups, safe when one group is huge.

Rows are put in order by one range partitioning on (keys, order) and stored, so
that slices stay what they are.  A group lies in one slice or in a run of
neighbouring slices; within a slice a plain window does the work, and what earlier
slices of the same group hold is added.  A slice continues at most one group, its
first, so there is at most one such offset for each slice, however many groups
there are and however large they grow.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendora.session import settle


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows in order, stored with the number of their slice."""
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return settle(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Add, for each ``{column: whole number}``, its sum over earlier rows of the group."""
    return _summed(_sliced(df, keys, order), keys, order, sums).drop("_slice")


def _summed(sliced: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    of = {name: value.cast("long") for name, value in sums.items()}
    totals = sliced.groupBy(*keys, "_slice").agg(*[F.sum(value).alias(f"_of_{name}") for name, value in of.items()])
    # As many rows for a group as it has slices.
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    at = {k: f"_at_{k}" for k in [*keys, "_slice"]}
    before = (
        totals.select(
            *[F.col(k).alias(name) for k, name in at.items()],
            F.lag(F.lit(True)).over(W.partitionBy(*keys).orderBy("_slice")).alias("_continued"),
            *[F.sum(f"_of_{name}").over(earlier).alias(f"_before_{name}") for name in sums],
        )
        .filter("_continued")
        .drop("_continued")
    )
    within = W.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = sliced.withColumns({name: F.coalesce(F.sum(value).over(within), F.lit(0)) for name, value in of.items()})
    return (
        summed.join(F.broadcast(before), _same(list(at), list(at.values())), "left")
        .withColumns({name: F.col(name) + F.coalesce(f"_before_{name}", F.lit(0)) for name in sums})
        .select(*sliced.columns, *sums)
    )


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Add, for each ``{column: value}``, the group's last value that is not NULL, up to and with the
    row itself; ``order`` names columns, and rows equal in all of them must not have different values."""
    sliced = _sliced(df, keys, [F.col(c) for c in order])
    rank = F.struct(*order)
    ends = sliced.groupBy(*keys, "_slice").agg(
        *[F.max_by(value, F.when(value.isNotNull(), rank)).alias(f"_of_{name}") for name, value in values.items()]
    )
    # As many rows for a group as it has slices.
    along = W.partitionBy(*keys).orderBy("_slice")
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    at = {k: f"_at_{k}" for k in [*keys, "_slice"]}
    before = (
        ends.select(
            *[F.col(k).alias(name) for k, name in at.items()],
            F.lag(F.lit(True)).over(along).alias("_continued"),
            *[F.last(f"_of_{name}", ignorenulls=True).over(earlier).alias(f"_before_{name}") for name in values],
        )
        .filter("_continued")
        .drop("_continued")
    )
    so_far = W.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    own = sliced.withColumns({name: F.last(value, ignorenulls=True).over(so_far) for name, value in values.items()})
    return (
        own.join(F.broadcast(before), _same(list(at), list(at.values())), "left")
        .withColumns({name: F.coalesce(F.col(name), F.col(f"_before_{name}")) for name in values})
        .select(*df.columns, *values)
    )


# Groups of more rows than this are cut into slices; a smaller one is a small part of a task.
HUGE = 500_000
# Hash buckets whose sizes are counted first; there are no more sizes than these, whatever the keys.
BUCKETS = 65_536


def huge_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys of groups of more than ``HUGE`` rows, or None if there are none.

    Hash buckets are counted first, which combines before it shuffles; keys are counted in buckets with that many
    rows only.  There is at most one such key for each ``HUGE`` rows."""
    bucketed = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket"))
    large = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n")).filter(F.col("_n") > HUGE).select("_bucket")
    listed = large.collect()
    if not listed:
        return None
    near = bucketed.join(F.broadcast(df.sparkSession.createDataFrame(listed, large.schema)), "_bucket", "left_semi")
    counts = near.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > HUGE).select(*keys)
    found = counts.collect()
    return df.sparkSession.createDataFrame(found, counts.schema) if found else None


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    row: str | None = None,
    size: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``ROW_NUMBER()`` by ``order`` as ``row`` and ``COUNT(*)`` as ``size`` per group.

    Plain windows do it after one shuffle by the keys, which later joins and groupings by them use again; rows of
    huge groups are cut into slices.  ``counted``, if given, has the same keys and rows as ``df`` and is cheaper to
    read: it tells which groups are huge."""
    huge = huge_groups(df if counted is None else counted, keys)
    if huge is None:
        return _windowed(df, keys, order, row, size)
    of = {k: f"_of_{k}" for k in keys}
    listed = F.broadcast(huge.withColumnsRenamed(of))
    same = _same(keys, list(of.values()))
    usual, sliced = (df.join(listed, same, how) for how in ("left_anti", "left_semi"))
    return _windowed(usual, keys, order, row, size).unionByName(_in_slices(sliced, keys, order, row, size))


def _windowed(df: DataFrame, keys: Sequence[str], order: Sequence[Column], row: str | None, size: str | None) -> DataFrame:
    group = W.partitionBy(*keys)
    if row is not None:
        df = df.withColumn(row, F.row_number().over(group.orderBy(*order)))
    return df if size is None else df.withColumn(size, F.count("*").over(group))


def _in_slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column], row: str | None, size: str | None) -> DataFrame:
    """Sizes are counted before they meet the rows, so a hot group is one row per
    task of the count, and its join is split at run time."""
    rows = df
    if row is not None:
        df = _sliced(df, keys, order)
        rows = _summed(df, keys, order, {row: F.lit(1)}).drop("_slice").withColumn(row, (F.col(row) + 1).cast("int"))
    if size is not None:
        of = {k: f"_of_{k}" for k in keys}
        counts = df.groupBy(*[F.col(k).alias(name) for k, name in of.items()]).agg(F.count("*").alias(size))
        rows = rows.join(counts, _same(keys, list(of.values()))).drop(*of.values())
    return rows
