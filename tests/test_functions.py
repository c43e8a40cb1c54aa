import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendora.functions import fixed_values as V
from vendora.functions import grouping
from vendora.functions.grouping import numbered, running
from vendora.functions.metrics import first_level, haversine_km, label_of, weight_tier
from vendora.functions.rounding import half_up, money_mean, month_of, percent
from vendora.functions.tiles import with_ntiles, with_rank_desc


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "a, b, expected",
    [(1, 200, 0.5), (201, 20000, 1.01), (1, 3, 33.33), (-201, 20000, -1.01), (5, 0, None), (0, 7, 0.0), (None, 7, None)],
)
def test_percent_is_exact_half_up(spark, a, b, expected):
    assert value(spark, percent(F.lit(a).cast("long"), F.lit(b).cast("long"))) == expected


def test_ratio_of_large_sums_does_not_overflow(spark):
    big = F.lit("99999999999999999999").cast("decimal(38,0)")
    assert value(spark, half_up(big, big, 4)) == 1.0


def test_money_mean_rounds_to_the_cent(spark):
    total = F.lit("10.01").cast("decimal(38,2)")
    assert value(spark, money_mean(total, F.lit(2))) == 5.01
    assert value(spark, money_mean(total, F.lit(0))) is None


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Shanghai"])
def test_month_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        month = month_of(F.lit("2018-11-04 00:30:00").cast("timestamp_ntz"))
        assert str(value(spark, month)) == "2018-11-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "grams, tier",
    [(None, "unknown"), (-1, "unknown"), (0, "unknown"), (1, "light"), (499, "light"), (500, "medium"),
     (1999, "medium"), (2000, "heavy")],
)
def test_weight_tier(spark, grams, tier):
    assert value(spark, weight_tier(F.lit(grams).cast("int"))) == tier


@pytest.mark.parametrize(
    "score, level", [(3.4999, "critical"), (3.5, "warning"), (3.8, "good"), (4.2, "excellent"), (None, "critical")]
)
def test_health_level(spark, score, level):
    assert value(spark, first_level(F.lit(score).cast("double"), V.HEALTH_LEVELS, V.HEALTH_LOWEST)) == level


def test_label_of_null_is_other(spark):
    assert value(spark, label_of(F.lit(None).cast("string"), V.CATEGORY_LABELS, V.CATEGORY_OTHER)) == "其他"


def test_haversine_quarter_of_the_equator(spark):
    km = value(spark, haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    assert abs(km - 10007.5) < 1


# --- tiles -------------------------------------------------------------------


def tiles_match(spark, rows, k, parts=4):
    df = spark.createDataFrame(rows, "id string, x decimal(12,2)").repartition(parts)
    plain = F.ntile(k).over(W.orderBy(F.col("x").asc_nulls_last(), "id"))
    both = with_ntiles(df.withColumn("expected", plain), "id", {"tile": "x"}, k)
    return both.filter("tile <> expected").count() == 0 and both.count() == len(rows)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 10])
def test_ntiles_of_few_rows_with_ties(spark, n):
    assert tiles_match(spark, [(f"{i:03}", Decimal(i // 3)) for i in range(n)], 4)


def test_ntiles_with_one_value_for_a_third_of_the_rows_and_nulls(spark):
    rng = random.Random(7)
    rows = [(f"{i:05}", Decimal(5) if i % 3 == 0 else None if i % 11 == 0 else Decimal(rng.randrange(10**6)) / 100)
            for i in range(5000)]
    assert tiles_match(spark, rows, 4)
    assert tiles_match(spark, rows, 10, parts=7)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), max_size=60), st.integers(2, 6))
def test_ntiles_equal_the_window_form(spark, values, k):
    assert tiles_match(spark, [(f"{i:03}", Decimal(v)) for i, v in enumerate(values)], k)


def test_several_tiles_of_dates_and_counts_at_once(spark):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 37).cast("int")).alias("day"),
        (F.col("id") % 5).alias("n"),
    )
    got = with_ntiles(df, "id", {"d": "day", "c": "n"}, 4)
    for tile, col in (("d", "day"), ("c", "n")):
        got = got.withColumn(f"{tile}_w", F.ntile(4).over(W.orderBy(col, "id")))
    assert got.filter("d <> d_w OR c <> c_w").count() == 0


@pytest.mark.parametrize("kind", ["double", "decimal(12,4)", "date", "timestamp", "string"])
def test_ntiles_of_any_type(spark, kind):
    """Values that differ by less than a hundredth, or are no numbers, keep their order."""
    x = {
        "double": (F.col("id") % 997) / 100000.0,
        "decimal(12,4)": ((F.col("id") % 997) / 10000).cast("decimal(12,4)"),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % 301).cast("int")),
        "timestamp": F.timestamp_seconds((F.col("id") * 7 % 301) / 1000),
        "string": F.md5(F.col("id").cast("string")),
    }[kind]
    df = spark.range(2000).select(F.format_string("%05d", "id").alias("id"), F.when(F.col("id") % 13 != 0, x).alias("x"))
    got = with_ntiles(df, "id", {"t": "x"}, 7)
    plain = F.ntile(7).over(W.orderBy(F.col("x").asc_nulls_last(), "id"))
    assert got.withColumn("w", plain).filter("t <> w").count() == 0


def test_ntiles_plan_has_no_window_over_the_whole_table(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("id"), F.rand(1).alias("x")).write.parquet(f"{tmp_path}/t")
    df = with_ntiles(spark.read.parquet(f"{tmp_path}/t"), "id", {"t": "x"}, 4)
    main_query = df._jdf.queryExecution().executedPlan().toString().split("Subquer")[0]
    assert "Window" not in main_query


def test_rank_desc_with_ties_and_nulls(spark):
    rows = [(i, None if i == 0 else Decimal(i // 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, x decimal(10,2)")
    got = with_rank_desc(df, "x", "r")
    plain = got.withColumn("w", F.rank().over(W.orderBy(F.desc_nulls_last("x"))))
    assert plain.filter("r <> w").count() == 0 and plain.count() == 40


# --- groups ------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some under NULL."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 40).cast("string"))
    return spark.range(3000).select(
        key.alias("k"), F.when(F.col("id") % 7 != 0, F.col("id") % 100).alias("x"), F.col("id").alias("u")
    )


@pytest.mark.parametrize("slices", ["1", "4", "37"])
def test_numbered_equals_the_window_form(spark, skewed, slices, monkeypatch):
    """Slices of a few rows: hot groups span many of them, and every slice has an edge."""
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = [F.col("x").desc_nulls_last(), F.col("u").asc()]
        got = numbered(skewed, ["k"], order, row="rn", size="n")
        group = W.partitionBy("k")
        checked = got.withColumn("rn_w", F.row_number().over(group.orderBy(*order)))
        checked = checked.withColumn("n_w", F.count("*").over(group))
        assert checked.count() == 3000
        assert checked.filter("rn <> rn_w OR n <> n_w").count() == 0
        sums = running(skewed, ["k"], order, {"before": F.coalesce("x", F.lit(0))})
        plain = F.coalesce(F.sum("x").over(group.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        assert sums.withColumn("w", plain).filter("before <> w").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_more_than_a_thousand_hot_groups(spark):
    df = spark.range(30_000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("u"))
    got = numbered(df, ["k"], [F.col("u")], row="rn", size="n")
    assert got.filter("rn <> (u - k) / 1500 + 1 OR n <> 20").count() == 0 and got.count() == 30_000


@pytest.mark.parametrize("huge", [0, 70, 100, 1000])
def test_huge_groups_are_cut_and_others_are_not(spark, skewed, huge, monkeypatch):
    monkeypatch.setattr(grouping, "HUGE", huge)
    monkeypatch.setattr(grouping, "BUCKETS", 5)
    order = [F.col("x").desc_nulls_last(), F.col("u").asc()]
    found = grouping.huge_groups(skewed, ["k"])
    sizes = {r["k"]: r["count"] for r in skewed.groupBy("k").count().collect()}
    assert ({r["k"] for r in found.collect()} if found else set()) == {k for k, n in sizes.items() if n > huge}
    got = numbered(skewed, ["k"], order, row="rn", size="n")
    group = W.partitionBy("k")
    checked = got.withColumn("rn_w", F.row_number().over(group.orderBy(*order))).withColumn("n_w", F.count("*").over(group))
    assert checked.count() == 3000
    assert checked.filter("rn <> rn_w OR n <> n_w").count() == 0


def test_numbered_groups_are_shuffled_once(spark, skewed):
    """Rows are neither stored nor shuffled again by what groups them by the same keys."""
    got = numbered(skewed, ["k"], [F.col("u")], row="rn", size="n").groupBy("k").agg(F.max("rn"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "FileScan" not in plan


def test_numbered_size_only(spark, skewed):
    got = numbered(skewed, ["k"], size="n")
    assert got.filter("k = 'hot' AND n <> 1000").count() == 0
    assert got.count() == 3000
