"""The order fact as a stream of files, merged by key: a line may come at any time, again and again.

**State.** Lines that come again unchanged within ``LATENESS`` are dropped by a keyed state store
(``dropDuplicatesWithinWatermark`` on the key and a hash of the line); the watermark lets go of
older state, so the store does not grow with the stream.  A changed line is no repetition.  Keys and hashes
pass the state in a stream of its own, fed by each batch, and only those that it can know or that a later batch can ask
for: a line newer than all earlier batches is in no state, and one that is behind the next mark is asked for by nobody.
So a first load of many years keeps the last days and no more.  Lines twice in one batch are settled by key.

**Late lines.** Behind the watermark the state operator would drop lines.  Lines at or before the mark are late: they
go past the state, are set aside in the table's ``_late`` folder, one folder for each batch, and merged with the
batch.  The mark is the newest event of earlier batches less ``LATENESS``, kept beside the
checkpoint; the state's own watermark is never ahead of it, so a line is late or may pass the state.

**Replays.** What a batch feeds to the state is put in its place at once and in full, and what passed is kept till the next
batch, so a batch that is replayed after a failure finds the same lines new.  Both lie in the checkpoint's folder.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vendora.functions.metrics import gmv
from vendora.operators.incremental import KEY, PART, PARTITION, in_months, merge, month_rows, one_per_key, spread
from vendora.operators.keys import unusable
from vendora.session import discard, exists, remove, settle, work_path
from vendora.sources.tables import holds_rows, names_in, read_table, take_partitions

LATENESS = timedelta(days=7)
EVENT, LINE, IN_STATE, BATCH = "_event", "_line", "_in_state", "batch"
# Events up to this moment move no mark.
FIRST = datetime(1970, 1, 2)


def line_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Order lines from new files."""
    return spark.readStream.schema(schema).parquet(folder)


def merge_into(lines: DataFrame, path: str, checkpoint: str, lateness: timedelta = LATENESS) -> None:
    """Process what is there and stop.  A batch that is replayed after a failure
    merges the same keys again and changes nothing; a table that exists is
    merged into, whatever the checkpoint.  A line without a date is always late."""
    event = F.coalesce(F.col("order_date").cast("timestamp"), F.lit(0).cast("timestamp"))
    marks = f"{checkpoint}-marks"
    spark = lines.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        before = _newest(spark, marks, batch_id)
        mark = None if before is None else before - lateness
        # Spark's own mark begins at zero.
        zero = F.lit(0).cast("timestamp")
        late = F.col(EVENT) <= (zero if mark is None else F.greatest(F.lit(mark).cast("timestamp"), zero))
        newest = F.max(F.when(F.col(EVENT) > F.lit(FIRST), F.col(EVENT)))
        # One row per calendar month.
        months = batch.groupBy(PARTITION).agg(F.count("*"), newest, F.count(F.when(late, 1))).collect()
        if not months:
            return
        newest = max((m[2] for m in months if m[2] is not None), default=None)
        known = before or FIRST
        kept = max(known, newest or FIRST) - lateness
        in_state = ~late & ((F.col(EVENT) <= F.lit(known)) | (F.col(EVENT) > F.lit(kept)))
        rows = batch.withColumn(IN_STATE, in_state)
        if any(m[3] for m in months):
            aside = batch.filter(late).select(*lines.columns).drop(PARTITION)
            aside.withColumn("newest_before", F.lit(mark).cast("timestamp_ntz")).write.mode("overwrite").parquet(
                f"{path}/_late/{checkpoint.rsplit('/', 1)[-1]}-{batch_id}"
            )
        asked = rows.filter(IN_STATE).select(KEY, PARTITION, EVENT, F.xxhash64(*lines.columns).alias(LINE))
        asked, fresh = _pass_state(spark, asked, f"{checkpoint}/lines", batch_id, lateness)
        _merge_lines(rows, lines.columns, {m[0]: m[1] for m in months}, asked, fresh, path)
        if newest is not None:
            spark.createDataFrame([(batch_id, newest)], "batch long, newest timestamp").coalesce(1).write.mode("overwrite").parquet(
                f"{marks}/batch={batch_id}"
            )

    query = lines.withColumn(EVENT, event).writeStream.foreachBatch(apply)
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _pass_state(
    spark: SparkSession, asked: DataFrame, folder: str, batch_id: int, lateness: timedelta
) -> tuple[DataFrame, DataFrame]:
    """The asked lines of a batch, stored, and those that the state did not know, of copies one; it knows them from now on."""
    feed, passed = f"{folder}/feed", f"{folder}/passed"
    mine = f"{BATCH}={batch_id}"
    if not exists(spark, f"{feed}/{mine}"):
        asked.write.mode("overwrite").parquet(f"{folder}/asked/{mine}")
        take_partitions(spark, f"{folder}/asked", feed, [mine])

    def keep(batch: DataFrame, state_batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{passed}/{mine}/part={state_batch_id}")

    new = (
        spark.readStream.schema(StructType([*asked.schema.fields, StructField(BATCH, LongType())])).parquet(feed)
        .withWatermark(EVENT, f"{int(lateness.total_seconds())} seconds")
        .dropDuplicatesWithinWatermark([KEY, LINE])
        .drop(BATCH)
    )
    query = new.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/state")
    query.trigger(availableNow=True).start().awaitTermination()
    # Earlier batches are merged in full.
    for place in (feed, passed):
        for name in names_in(spark, place):
            if name != mine:
                remove(spark, f"{place}/{name}")
    stored = read_table(spark, f"{feed}/{mine}", asked.schema)
    if not exists(spark, f"{passed}/{mine}"):
        return stored, stored.limit(0)
    return stored, read_table(spark, f"{passed}/{mine}", asked.schema)


def _merge_lines(rows: DataFrame, columns: list[str], counts: dict, asked: DataFrame, fresh: DataFrame, path: str) -> None:
    """Merge the lines of a batch that are new or not asked for, one of each key.

    The merge reads its delivery several times, so keys are settled once, by month as the table lies.  Where as many
    lines are fresh as were asked for, none was dropped: only lines of other months are looked up."""
    spark = fresh.sparkSession
    own, settled = work_path(spark, "delta"), None
    passed = month_rows(fresh)
    repeated = {month for month, n in month_rows(asked).items() if n != passed.get(month, 0)}
    whole = spread(rows.select(*columns), counts)
    if repeated:
        inside = in_months(repeated)
        given = rows.filter(inside).withColumn(LINE, F.xxhash64(*columns)).drop(EVENT).withColumn("fresh", F.lit(False))
        marked = fresh.filter(inside).drop(EVENT).withColumn("fresh", F.lit(True))
        both = spread(given.unionByName(marked, allowMissingColumns=True), {month: 2 * n for month, n in counts.items()})
        new = F.max("fresh").over(W.partitionBy(PARTITION, PART, KEY, LINE))
        taken = both.withColumn("new", new).filter(~F.col("fresh") & (~F.col(IN_STATE) | F.col("new")))
        _settle_lines(taken, columns, own)
        whole = whole.filter(~inside)
    _settle_lines(whole, columns, own)
    delta = read_table(spark, own, rows.select(*columns).schema)
    # A key that came with two months in one batch has a line in each.
    checked = unusable(delta, KEY) is None
    if not checked:
        delta = settled = settle(one_per_key(delta), "delta")
    # A line's month is that of its purchase, which never changes.
    merge(delta, path, key_keeps_month=True, checked=checked, stored_at=own if checked else None)
    remove(spark, own)
    if settled is not None:
        discard(settled)


def _settle_lines(lines: DataFrame, columns: list[str], folder: str) -> None:
    taken = one_per_key(lines.select(*columns, PART), PARTITION, PART).select(*columns)
    taken.write.mode("append").partitionBy(PARTITION).parquet(folder)


def _newest(spark: SparkSession, marks: str, batch_id: int) -> datetime | None:
    """The newest event of earlier batches; lines at or before it less the lateness are late."""
    if not holds_rows(spark, marks):
        return None
    earlier = spark.read.schema("newest timestamp, batch long").parquet(marks).filter(F.col("batch") < batch_id)
    return earlier.agg(F.max("newest")).first()[0]


def late_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every line that came late, as it came."""
    kept = StructType([f for f in schema.fields if f.name != PARTITION])
    if not holds_rows(spark, f"{path}/_late"):
        return spark.createDataFrame([], kept)
    return spark.read.schema(kept).parquet(f"{path}/_late/*")


def monthly_gmv(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.groupBy("order_month").agg(
        F.count("*").alias("line_count"), gmv("order_amount").cast("decimal(38,2)").alias("gmv_delivered")
    )
