from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vendora.operators import audits, core, profiling, staging
from vendora.plans import adhoc, kpi, marts
from vendora.registry import QUERIES

D = Decimal
DAY = datetime(2018, 3, 5, 12, 0, 0)


def orders(spark, rows):
    """(order_id, customer_id, status, month)"""
    return spark.createDataFrame(
        [(o, c, s, datetime(2018, m, 5, 12)) for o, c, s, m in rows],
        "order_id string, customer_id string, order_status string, order_purchased_at timestamp_ntz",
    )


def items(spark, rows):
    """(order_id, line, product, seller, price, freight)"""
    return spark.createDataFrame(
        rows,
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "price decimal(10,2), freight_value decimal(10,2)",
    )


def reviews(spark, rows):
    """(review_id, order_id, score, message, created)"""
    return staging.stg_order_reviews(
        spark.createDataFrame(
            [(r, o, s, None, m, t, None) for r, o, s, m, t in rows],
            "review_id string, order_id string, review_score int, review_comment_title string, "
            "review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
        )
    )


@pytest.fixture(scope="module")
def shop(spark):
    o = orders(spark, [("1", "a", "delivered", 3), ("2", "b", "canceled", 3), ("3", "a", "delivered", 4), ("4", "c", "created", 4)])
    i = items(
        spark,
        [
            ("1", 1, "p", "s", D("10"), D("1")),
            ("1", 2, "q", "s", D("20"), None),
            ("1", 3, "p", "t", None, D("2")),
            ("2", 1, "p", "s", D("5"), D("0")),
            ("3", 1, "q", "t", None, None),
            ("9", 1, "p", "s", D("99"), D("0")),
        ],
    )
    return core.fct_orders(i, o), o, i


def test_fct_orders_keeps_matched_lines_and_fills_amounts(shop):
    fact, _, _ = shop
    got = {r["order_item_key"]: (r["order_amount"], r["is_delivered"], r["is_cancelled"]) for r in fact.collect()}
    assert got == {
        "1-1": (D("11.00"), True, False),
        "1-2": (D("20.00"), True, False),
        "1-3": (D("2.00"), True, False),
        "2-1": (D("5.00"), False, True),
        "3-1": (D("0.00"), True, False),
    }


def test_join_loss_sees_both_directions(shop):
    _, o, i = shop
    lost = audits.join_loss(o, i, "order_id").first()
    assert (lost["rows_lost"], lost["keys_lost"], lost["lost_pct"]) == (1, 1, 25.0)
    assert audits.join_loss(i, o, "order_id").first()["rows_lost"] == 1


def test_monthly_gmv(shop):
    fact, _, _ = shop
    march, april = marts.ads_gmv_monthly(fact).collect()
    assert (march["total_orders"], march["delivered_orders"], march["cancelled_orders"], march["total_buyers"]) == (2, 1, 1, 2)
    assert (march["gmv_all"], march["gmv_delivered"], march["gmv_cancelled"]) == (D("38.00"), D("33.00"), D("5.00"))
    assert (march["avg_order_value"], march["cancel_rate_pct"]) == (33.0, 50.0)
    assert (april["gmv_all"], april["avg_order_value"], april["cancel_rate_pct"]) == (D("0.00"), 0.0, 0.0)


def test_month_without_delivery_has_no_order_value(spark):
    fact = core.fct_orders(items(spark, [("1", 1, "p", "s", D("1"), None)]), orders(spark, [("1", "a", "canceled", 1)]))
    assert marts.ads_gmv_monthly(fact).first()["avg_order_value"] is None


def test_duplicated_orders_still_count_once(spark):
    """The order table should be unique; where it is not, distinct counts hold."""
    twice = orders(spark, [("1", "a", "delivered", 1), ("1", "b", "delivered", 1)])
    row = marts.ads_gmv_monthly(core.fct_orders(items(spark, [("1", 1, "p", "s", D("1"), None)]), twice)).first()
    assert (row["total_orders"], row["delivered_orders"], row["total_buyers"]) == (1, 1, 2)


def test_unknown_product_keeps_its_sales(spark, shop):
    fact, _, _ = shop
    products = core.dim_products(
        spark.createDataFrame([("p", "books", 600, 1, 1)],
                              "product_id string, product_category string, product_weight_g int, l int, h int")
    )
    got = {r["product_category"]: r for r in marts.ads_category_sales(fact, products).collect()}
    assert got["books"]["gmv"] == D("13.00") and got[None]["gmv"] == D("20.00")
    assert got["books"]["gmv_share_pct"] == 39.39 and got[None]["orders"] == 2


def test_payment_flags_and_orphans(spark, shop):
    _, o, _ = shop
    payments = spark.createDataFrame(
        [("1", 1, "credit_card", 0, D("1")), ("1", 2, "voucher", 1, D("2")), ("2", 1, "boleto", 2, D("3")),
         ("77", 1, None, None, D("4"))],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(12,2)",
    )
    got = {r["payment_key"]: r for r in core.fct_payments(payments, o).collect()}
    flags = {k: (r["is_installment"], r["is_full_payment"], r["is_credit_card"], r["is_orphan_payment"]) for k, r in got.items()}
    assert flags == {
        "1-1": (False, False, True, False),
        "1-2": (False, True, False, False),
        "2-1": (True, False, False, False),
        "77-1": (False, False, False, True),
    }
    assert {r["payment_type"] for r in marts.ads_payment_analysis(core.fct_payments(payments, o)).collect()} == {
        "credit_card", "voucher", "boleto"}


@pytest.fixture(scope="module")
def reviewed(spark, shop):
    _, o, _ = shop
    rows = [
        ("r1", "1", 5, "good", DAY), ("r2", "1", 1, "  ", None), ("r3", "2", 3, None, DAY), ("r4", "2", 2, "", DAY),
        ("r1", "3", 4, "x", DAY),
    ]
    return core.fct_reviews(reviews(spark, rows), o)


def test_latest_review_puts_undated_last_and_breaks_ties_by_id(reviewed):
    latest = {r["order_id"]: r["review_id"] for r in core.latest_reviews(reviewed).collect()}
    assert latest == {"1": "r1", "2": "r3", "3": "r1"}


def test_review_flags(reviewed):
    got = {r["review_key"]: r for r in reviewed.collect()}
    assert [got[k]["has_comment"] for k in ("r1-1", "r2-1", "r3-2", "r4-2", "r1-3")] == [True, False, False, False, True]
    assert got["r1-3"]["is_shared_review_id"] and not got["r3-2"]["is_shared_review_id"]
    assert got["r1-1"]["is_duplicate_review"] and not got["r1-3"]["is_duplicate_review"]


def test_hot_order_gives_the_same_flags(spark, shop):
    _, o, _ = shop
    rows = [(f"r{i:03}", "1" if i % 3 else str(i), i % 5 + 1, None, None if i % 4 == 0 else datetime(2018, 1, 1 + i % 9))
            for i in range(200)]
    plain = core.fct_reviews(reviews(spark, rows), o).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = core.fct_reviews(reviews(spark, rows), o).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(plain, key=repr) == sorted(split, key=repr)


def test_fanout_counts_every_line_once_per_review(shop, reviewed):
    fact, _, _ = shop
    row = audits.fanout_inflation(fact, reviewed).first()
    naive = fact.join(reviewed.select("order_id", "review_id"), "order_id", "left")
    assert row["joined_rows"] == naive.count() == 9
    assert row["joined_amount"] == naive.agg(F.sum("order_amount")).first()[0]


def test_seller_marts_align_grain(spark, shop, reviewed):
    fact, _, _ = shop
    sellers = core.dim_sellers(
        spark.createDataFrame([("s", "1", "x", "SP"), ("t", "2", "y", "ES"), ("idle", "3", "z", None)],
                              "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    )
    got = {r["seller_id"]: r for r in marts.dws_seller_performance(sellers, fact, reviewed).collect()}
    s, idle = got["s"], got["idle"]
    assert (s["order_count"], s["item_count"], s["product_count"], s["gmv_delivered"]) == (2, 3, 2, D("31.00"))
    # Two lines of order 1 carry its latest score 5, one line of order 2 carries 3.
    assert (s["review_count"], s["avg_review_score"], s["good_review_rate_pct"]) == (3, 4.333, 66.67)
    assert (got["t"]["region"], got["t"]["seller_tier"]) == ("outros", "C_普通卖家")
    assert (idle["order_count"], idle["avg_order_value"], idle["seller_tier"], idle["is_risk_seller"]) == (0, 0.0, "D_无成交", False)
    assert idle["avg_review_score"] is None


def test_seller_totals_with_hot_orders_and_gaps(spark):
    """One order with many products and several lines of one, lines without order or product, reviews without id or score."""
    line = "order_id string, seller_id string, product_id string, order_amount decimal(13,2), order_date date, is_delivered boolean, is_cancelled boolean"
    rows = [("o", "s", f"p{i % 40}", D(1), None, True, False) for i in range(100)]
    rows += [("o", "t", None, D(2), None, False, False), (None, "s", "p1", D(3), None, True, False), ("q", "t", "x", D(4), None, True, False)]
    fact = spark.createDataFrame(rows, line)
    marked = spark.createDataFrame(
        [("o", "r1", 5, True), ("o", "r2", 1, False), ("q", None, None, True), (None, "r3", 1, True)],
        "order_id string, review_id string, review_score int, is_latest_review boolean",
    )
    got = {r["seller_id"]: r for r in marts.seller_totals(fact, marked).collect()}
    s, t = got["s"], got["t"]
    assert (s["order_count"], s["item_count"], s["product_count"], s["gmv_delivered"]) == (1, 101, 40, D("103.00"))
    assert (s["review_count"], s["avg_review_score"], s["good_review_rate_pct"]) == (100, 5.0, 100.0)
    assert (t["order_count"], t["item_count"], t["product_count"], t["review_count"]) == (2, 2, 1, 1)


def test_seller_performance_reads_the_fact_once(spark):
    plan = QUERIES["dws_seller_performance"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_extendedprice") > 0
    scans = [line for line in plan.splitlines() if "Relation [" in line and "l_orderkey" in line]
    assert len(scans) == 1


def test_seller_totals_hash_no_lines_of_an_order(spark):
    """Tasks that hold whole orders hash the (seller, product) groups alone."""
    plan = QUERIES["dws_seller_performance"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    hashed = [line for line in plan.splitlines() if "HashAggregate(keys=[order_id" in line and "seller_id" in line]
    assert not hashed


def test_revenue_and_sellers_of_a_stored_fact_take_one_wide_shuffle(spark, tmp_path):
    """Revenue shuffles its two rows an order once; what counts a seller's products carries no sums."""
    line = "order_id string, customer_id string, seller_id string, product_id string, order_amount decimal(13,2), order_date date, order_month timestamp_ntz, is_delivered boolean, is_cancelled boolean"
    rows = [(f"o{i // 2}", "c", f"s{i % 2}", f"p{i % 3}", D(1), None, None, True, False) for i in range(12)]
    spark.createDataFrame(rows, line).write.parquet(f"{tmp_path}/fact")
    fact = spark.read.schema(line).parquet(f"{tmp_path}/fact")
    plan = marts.ads_gmv_monthly(fact)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_month" in plan and "order_id#" not in "".join(
        part.split(")")[0] for part in plan.split("hashpartitioning(")[1:]
    )
    marked = spark.createDataFrame([("o1", "r", 5, True)], "order_id string, review_id string, review_score int, is_latest_review boolean")
    sellers = marts.seller_totals(fact, marked)
    assert "is_product" in sellers._jdf.queryExecution().optimizedPlan().toString()
    got = {r["seller_id"]: (r["order_count"], r["item_count"], r["product_count"], r["review_count"]) for r in sellers.collect()}
    assert got == {"s0": (6, 6, 3, 1), "s1": (6, 6, 3, 1)}


def test_seller_totals_of_a_stored_fact_bring_ids_alone_together_by_order(spark, tmp_path):
    line = "order_id string, seller_id string, product_id string, order_amount decimal(13,2), order_date date, is_delivered boolean, is_cancelled boolean"
    rows = [("o", "s", f"p{i % 4}", D(1), None, True, False) for i in range(9)]
    rows += [(None, "s", "p1", D(3), None, True, False), ("q", None, "x", D(4), None, True, False), ("q", "t", None, D(5), None, False, True)]
    spark.createDataFrame(rows, line).write.parquet(f"{tmp_path}/fact")
    fact = spark.read.schema(line).parquet(f"{tmp_path}/fact")
    marked = spark.createDataFrame(
        [("o", "r1", 5, True), ("q", None, 2, True), (None, "r3", 1, True)],
        "order_id string, review_id string, review_score int, is_latest_review boolean",
    )
    once, twice = (marts.seller_totals(fact, marked, stored) for stored in (False, True))
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))
    by_order = [p for p in twice._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(order_id")[1:]]
    assert by_order and not any("order_amount" in p.split("Scan")[0] for p in by_order)


def test_sold_lines_are_not_shuffled_before_products_join(spark, tmp_path):
    line = "order_id string, customer_id string, product_id string, order_amount decimal(13,2), is_delivered boolean"
    spark.createDataFrame([("o", "c", "p", D(1), True), ("o", "c", "p", D(2), True)], line).write.parquet(f"{tmp_path}/fact")
    products = spark.createDataFrame([("p", "a", "b", "w")], "product_id string, product_category string, product_category_cn string, weight_tier string")
    sales = marts.ads_category_sales(spark.read.schema(line).parquet(f"{tmp_path}/fact"), products)
    assert "hashpartitioning(order_id" not in sales._jdf.queryExecution().executedPlan().toString()
    assert [(r["orders"], r["buyers"], r["gmv"], r["avg_order_value"]) for r in sales.collect()] == [(1, 1, D("3.00"), 1.5)]


def test_gathered_fact_is_the_fact_and_shuffles_no_derived_columns(spark, shop):
    fact, o, i = shop
    gathered = core.fct_orders(i, o, gathered=True)
    assert sorted(map(repr, fact.collect())) == sorted(map(repr, gathered.collect())) and fact.schema == gathered.schema
    plan = gathered._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and "order_item_key" not in plan.split("RebalancePartitions")[1]


def test_all_months_unscored_are_unknown(spark, shop):
    _, o, _ = shop
    only = core.fct_reviews(reviews(spark, [("r1", "1", None, None, DAY)]), o)
    assert marts.ads_review_analysis(only).first()["health_level"] == "unknown"


def test_reviews_without_a_month_weigh_nothing(spark, shop):
    _, o, _ = shop
    fact = core.fct_reviews(reviews(spark, [("r1", "1", 5, None, DAY), ("r2", "lost", 1, None, DAY)]), o)
    row = kpi.review_block(fact, marts.ads_review_analysis(fact)).first()
    assert (row["review_total"], row["avg_review_score"], row["good_rate"]) == (2, D("3.00"), D("100.00"))


def test_mode_ties_take_the_smallest(spark):
    rows = [("z", 1.0, 1.0, c, s) for c, s in (("b", "SP"), ("a", "RJ"), ("b", "RJ"), ("a", None))]
    geo = core.dim_geography(
        spark.createDataFrame(rows, "zip_code_prefix string, latitude double, longitude double, geo_city string, geo_state string")
    ).first()
    assert (geo["geo_city"], geo["geo_state"], geo["measurement_count"]) == ("a", "RJ", 4)


def test_unmatched_rows_count_null_keys(spark):
    child = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "k string")
    parent = spark.createDataFrame([("2",), ("2",)], "k string")
    assert profiling.unmatched_rows(child, parent, "k", "n").first()["n"] == 3


def test_time_inversion_ignores_unreadable_times(spark):
    raw = spark.createDataFrame(
        [("2018-01-02", "2018-01-01"), ("2018-01-01", "2018-01-02"), ("soon", "2018-01-02"), (None, "2018-01-02")],
        "order_purchase_timestamp string, order_delivered_customer_date string",
    )
    assert profiling.time_inversion(raw).first()["inverted_rows"] == 1


def test_score_decline_needs_consecutive_drops(spark):
    scores = [4.0, 3.9, 3.8, 3.9, 3.7, 3.6, 3.5]
    months = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "order_month int, avg_review_score double")
    warned = [r["order_month"] for r in adhoc.score_decline(months).collect() if r["is_warning"]]
    assert sorted(warned) == [2, 5, 6]


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["ads_gmv_monthly", "ads_category_sales", "dws_seller_performance", "recon_order_payment",
                                  "adhoc_delivery_distance", "scd2_point_in_time_join"])
def test_plans_stay_on_the_jvm_without_cross_products(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["ads_gmv_monthly"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_tax:double>" in plan


def test_staged_tables_answer_plain_sql(spark):
    from vendora.plans import warehouse
    from vendora.registry import _all_raw

    views = warehouse.staging(_all_raw(spark, SF_DIR, with_line_ids=False), F.lit("2026-01-01").cast("timestamp_ntz"))
    warehouse.register(views)
    assert len(views) == 9
    got = spark.sql("SELECT count(*) FROM stg_orders o JOIN stg_customers c USING (customer_id)").first()[0]
    assert got == views["stg_orders"].count()


def test_working_folder_comes_from_the_session(spark):
    from vendora.session import work_path

    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = work_path(spark, "x")
    assert named is None or path.startswith(named.rstrip("/"))
    assert path != work_path(spark, "x")
