"""Slowly changing dimensions: overwrite, previous value, full history.

A stored history has one folder for each snapshot, with the versions that it closed
and, in hashed buckets, the open versions of the buckets that it changed.  Closed versions are
written once; a snapshot reads and writes changed buckets only, and shows once it is published.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructType, TimestampNTZType

from vendora.functions.checksums import hash_sum
from vendora.functions.grouping import carried
from vendora.operators.keys import reject_unusable
from vendora.session import remove
from vendora.sources.tables import newest_version, publish

# --- Fixed values: names of the validity columns -----------------------------
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"

BUCKET = "bucket"
BUCKETS = "buckets int, bucket int, run long, rows long, hashes decimal(38,0), rule string"
# Rows of one bucket, the fewest buckets, and how far buckets may outgrow that before there are more.
BUCKET_ROWS = 1_000_000
MIN_BUCKETS = 16
GROWTH = 4


def first_snapshot(source: DataFrame, valid_from: Column) -> DataFrame:
    """Every source row as an open version; see :func:`take_snapshot` for the check of keys."""
    return source.select(
        *source.columns,
        valid_from.cast("timestamp_ntz").alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def by_timestamp(history: DataFrame, source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """A row is a new version if its timestamp is newer than the open one's."""
    newer = F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}")
    return _apply(history, source, key, F.coalesce(newer, F.lit(False)), F.col(f"new.{updated_at}"))


def by_check(
    history: DataFrame, source: DataFrame, key: str, check_cols: Sequence[str], snapshot_ts: Column
) -> DataFrame:
    """A row is a new version if one of ``check_cols`` differs, NULLs included."""
    same = F.struct(*[F.col(f"new.{c}") for c in check_cols]).eqNullSafe(
        F.struct(*[F.col(f"old.{c}") for c in check_cols])
    )
    return _apply(history, source, key, ~same, snapshot_ts)


def _apply(history: DataFrame, source: DataFrame, key: str, changed: Column, since: Column) -> DataFrame:
    """Close changed versions, open their successors, keep everything else.

    A key that is gone from the source keeps its open version."""
    reject_unusable(source, key, "snapshot source")
    columns = source.columns
    opened = current(history).withColumn("_known", F.lit(True)).alias("old")
    given = source.withColumn("_given", F.lit(True)).alias("new")
    paired = opened.join(given, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    since = since.cast("timestamp_ntz")
    is_new = F.col("_known").isNull()
    is_changed = ~is_new & F.col("_given").isNotNull() & changed

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in columns]
        return F.struct(*fields, valid_from.alias(VALID_FROM), valid_to.cast("timestamp_ntz").alias(VALID_TO))

    kept = version("old", F.col(f"old.{VALID_FROM}"), F.when(is_changed, since))
    added = version("new", since, F.lit(None))
    versions = paired.select(
        F.explode(
            F.when(is_new, F.array(added)).when(is_changed, F.array(kept, added)).otherwise(F.array(kept))
        ).alias("v")
    ).select("v.*")
    closed = history.filter(F.col(VALID_TO).isNotNull())
    return closed.unionByName(versions)


# --- The stored history ---------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """How a snapshot tells new versions: ``apply(open versions, source)`` gives all versions, and ``name``
    says in full what it does; without a name, nothing is known of what an earlier snapshot did."""

    name: str
    apply: Callable[[DataFrame, DataFrame], DataFrame]


def timestamp_rule(key: str, updated_at: str) -> Rule:
    return Rule(f"timestamp {key} {updated_at}", lambda opened, given: by_timestamp(opened, given, key, updated_at))


def check_rule(key: str, check_cols: Sequence[str], snapshot_ts: Column) -> Rule:
    name = f"check {key} {' '.join(check_cols)}"
    return Rule(name, lambda opened, given: by_check(opened, given, key, check_cols, snapshot_ts))


def take_snapshot(
    source: DataFrame, root: str, key: str, valid_from: Column, step: Callable[[DataFrame], DataFrame]
) -> None:
    """:func:`snapshot` by any ``step`` from open versions to versions; as it has no name, every bucket is
    looked at."""
    snapshot(source, root, key, valid_from, Rule("", lambda opened, given: step(opened)))


def snapshot(source: DataFrame, root: str, key: str, valid_from: Column, rule: Rule) -> None:
    """Bring the history below ``root`` up to date with ``source``.

    The first snapshot opens every row at ``valid_from``; later ones apply ``rule`` to the open
    versions.  These lie in hashed buckets of keys.  A list beside them has, for each bucket, the run that
    wrote it, and the checksum of the source's rows as that run saw them.  Where the checksum is still
    the same, the rule has nothing to tell: the bucket is neither read nor written, and stays the
    earlier run's.  Without any difference no run is added.

    A run that is cut off is not published, and the next one writes its folder anew."""
    spark = source.sparkSession
    run, _ = newest_version(spark, root)
    known = _buckets(spark, root, run)
    buckets = known[0]["buckets"] if known else 0
    sums = _checksums(source, key, buckets) if buckets else {}
    total = sum(n for n, _ in sums.values()) if buckets else source.count()
    grown = total > GROWTH * BUCKET_ROWS * buckets
    if grown or not buckets:
        buckets = max(MIN_BUCKETS, -(-total // BUCKET_ROWS))
        sums = _checksums(source, key, buckets)
    before = {r["bucket"]: r for r in known}
    if grown or not rule.name:
        touched = set(before) | set(sums) | set(range(buckets))
    else:
        same = {b for b, r in before.items() if (r["rows"], r["hashes"]) == sums.get(b, (0, None)) and r["rule"] == rule.name}
        touched = (set(before) | set(sums)) - same
    if run and not touched:
        return
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    changed = bucket.isin(sorted(touched)) if len(touched) < buckets else F.lit(True)
    given = source.filter(changed)
    if run == 0:
        reject_unusable(source, key, "snapshot source")
        versions = first_snapshot(given, valid_from)
    else:
        opened = _open(spark, root, source.schema, run, [r for r in known if r["bucket"] in touched])
        versions = rule.apply(opened, given).filter(changed)
    path = f"{root}/run={run + 1}"
    is_open = F.col(VALID_TO).isNull()
    # Closed versions are not looked up by bucket.
    placed = versions.withColumns({"is_open": is_open, BUCKET: F.when(is_open, bucket).otherwise(-1)})
    placed.hint("rebalance", "is_open", BUCKET).write.mode("overwrite").partitionBy("is_open", BUCKET).parquet(path)
    # As many rows as there are buckets.
    now = {
        b: (buckets, b, run + 1, *sums.get(b, (0, None)), rule.name) if b in touched else tuple(before[b])
        for b in (set(range(buckets)) & touched) | (set(before) - touched)
    }
    spark.createDataFrame(list(now.values()), BUCKETS).coalesce(1).write.mode("overwrite").parquet(f"{root}/_buckets/run={run + 1}")
    publish(spark, root, path)
    # Readers may still be at the run before; what that one had no more shows nowhere.
    kept = {(r["run"], r["bucket"]) for r in known}
    for r in _buckets(spark, root, run - 1):
        if (r["run"], r["bucket"]) not in kept:
            remove(spark, f"{root}/run={r['run']}/is_open=true/{BUCKET}={r['bucket']}")


def _checksums(source: DataFrame, key: str, buckets: int) -> dict[int, tuple]:
    """For each bucket the number of the source's rows and the sum of their hashes."""
    by_bucket = source.groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET))
    sums = by_bucket.agg(F.count("*").alias("rows"), hash_sum(source.columns).alias("hashes"))
    return {r[BUCKET]: (r["rows"], r["hashes"]) for r in sums.collect()}


def _buckets(spark: SparkSession, root: str, run: int) -> list:
    """The list of buckets of a run: one row for each."""
    return spark.read.schema(BUCKETS).parquet(f"{root}/_buckets/run={run}").collect() if run > 0 else []


def _stored(spark: SparkSession, root: str, schema: StructType, run: int) -> DataFrame:
    """What the published runs wrote; a run that was cut off is not looked at."""
    whole = StructType([*schema.fields]).add(VALID_FROM, TimestampNTZType()).add(VALID_TO, TimestampNTZType())
    whole = whole.add("run", LongType()).add("is_open", BooleanType()).add(BUCKET, IntegerType())
    return spark.read.schema(whole).option("basePath", root).parquet(*[f"{root}/run={n + 1}" for n in range(run)])


def _open(spark: SparkSession, root: str, schema: StructType, run: int, listed: list) -> DataFrame:
    """Open versions of the listed buckets; no others are opened."""
    places = [f"{r['run']}-{r['bucket']}" for r in listed]
    here = F.concat_ws("-", "run", BUCKET).isin(places) if places else F.lit(False)
    return _stored(spark, root, schema, run).filter(F.col("is_open") & here).drop("run", "is_open", BUCKET)


def read_history(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """All versions as of the last published snapshot; ``schema`` is the source's."""
    run, _ = newest_version(spark, root)
    closed = _stored(spark, root, schema, run).filter(~F.col("is_open")).drop("run", "is_open", BUCKET)
    return closed.unionByName(_open(spark, root, schema, run, _buckets(spark, root, run)))


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col(VALID_TO).isNull())


def _covers(moment: Column) -> Column:
    """Half-open validity: the closing moment belongs to the next version."""
    return (moment >= F.col(VALID_FROM)) & (F.col(VALID_TO).isNull() | (moment < F.col(VALID_TO)))


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    return history.filter(_covers(moment.cast("timestamp_ntz")))


def point_in_time(facts: DataFrame, history: DataFrame, key: str, moment: str, columns: Sequence[str]) -> DataFrame:
    """Each fact with the version valid at its own ``moment``; NULLs where none is.

    Facts and versions are put in one order by key and moment, and each fact takes the last version
    before it: no fact meets versions of other moments, and a key with very many facts or versions
    lies in many slices.  Versions of a key must not overlap, which snapshots see to."""
    opens = F.col(VALID_FROM)
    # A version that was closed at the moment it opened covers nothing.
    versions = history.filter(
        opens.isNotNull() & F.col(key).isNotNull() & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > opens))
    )
    told = F.struct(F.col(VALID_TO).alias("until"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    rows = versions.select(F.col(key).alias("_key"), opens.alias("_at"), F.lit(0).alias("_tie"), told.alias("_told"))
    # Facts of one key and moment stand in order of a hash, so that they may lie in several slices.
    hashed = F.xxhash64(*[f.name for f in facts.schema.fields if "map<" not in f.dataType.simpleString()])
    asked = facts.select(
        F.col(key).alias("_key"),
        F.col(moment).cast("timestamp_ntz").alias("_at"),
        (F.pmod(hashed, F.lit(1 << 30)) + 1).cast("int").alias("_tie"),
        F.struct(*facts.columns).alias("_fact"),
    )
    both = rows.unionByName(asked, allowMissingColumns=True)
    last = carried(both, ["_key"], ["_at", "_tie"], {"_last": F.col("_told")}).filter("_fact IS NOT NULL")
    valid = F.col("_at").isNotNull() & (F.col("_last.until").isNull() | (F.col("_at") < F.col("_last.until")))
    return last.select(
        "_fact.*", *[F.when(valid, F.col(f"_last.v{i}")).alias(c) for i, c in enumerate(columns)]
    )


def overwrite(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Type 1: the newest values, no history."""
    reject_unusable(source, key, "source")
    return target.join(source.select(key), key, "left_anti").select(*source.columns).unionByName(source)


def keep_previous(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Type 3: the newest values plus the value before the last change."""
    reject_unusable(source, key, "source")
    previous = f"prev_{column}"
    earlier = F.col(f"old.{previous}") if previous in target.columns else F.lit(None).cast("string")
    paired = source.alias("new").join(target.alias("old"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    taken = F.col(f"new.{key}").isNotNull()
    known = F.col(f"old.{key}").isNotNull()
    moved = taken & known & ~F.col(f"old.{column}").eqNullSafe(F.col(f"new.{column}"))
    return paired.select(
        *[F.when(taken, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in source.columns],
        F.when(moved, F.col(f"old.{column}")).otherwise(earlier).alias(previous),
    )


def insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Type 0: a known key never changes."""
    reject_unusable(source, key, "source")
    return target.unionByName(source.join(target.select(key), key, "left_anti").select(*target.columns))
