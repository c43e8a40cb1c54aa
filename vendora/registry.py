"""Every operator as a named query on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendora.functions import fixed_values as V
from vendora.functions.metrics import gmv, gmv_all, rfm_segment_with_keep
from vendora.functions.rounding import month_of
from vendora.functions.tiles import with_ntiles
from vendora.functions.unions import union_all, union_distinct
from vendora.operators import audits, core, incremental, profiling, quality, scd, staging
from vendora.plans import adhoc, kpi, marts, warehouse
from vendora.session import settle, tune, work_path
from vendora.sources import csv_files, tables
from vendora.sources import driver_tables as raw
from vendora.sources.contracts import CONTRACTS
from vendora.streaming import order_feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed moments: loads and snapshots are dated, never "now".
LOAD_TS = "2026-01-01 00:00:00"
MOVE_TS = "2026-02-01 00:00:00"
RUN_1_BEFORE = "2000-04-01"
REDELIVERED_FROM = "2000-03-01"
SNAPSHOT_1, SNAPSHOT_2, AS_OF = "1995-01-01 00:00:00", "1998-07-01 00:00:00", "1998-06-30 12:00:00"


# What the marts read of the facts, for queries that store a fact on the way.
ORDER_MEASURES = [
    "order_id", "customer_id", "product_id", "seller_id", "order_date", "order_month",
    "order_amount", "is_delivered", "is_cancelled",
]
REVIEW_MEASURES = ["review_id", "order_id", "review_score", "order_month", "has_comment", "is_latest_review"]


def query(fn: Query) -> Query:
    """Register ``fn`` under its own name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def at(moment: str):
    return F.lit(moment).cast("timestamp_ntz")


# --- Inputs shared by the queries --------------------------------------------


def _customers(spark, d, load_ts: str = LOAD_TS) -> DataFrame:
    return staging.stg_customers(raw.customers(spark, d), at(load_ts))


def _orders(spark, d) -> DataFrame:
    return staging.stg_orders(raw.orders(spark, d))


def _items(spark, d, with_line_ids: bool = False) -> DataFrame:
    return staging.stg_order_items(raw.order_items(spark, d, with_line_ids))


def _products(spark, d) -> DataFrame:
    return staging.stg_products(raw.products(spark, d))


def _sellers(spark, d) -> DataFrame:
    return staging.stg_sellers(raw.sellers(spark, d))


def _payments(spark, d) -> DataFrame:
    return staging.stg_order_payments(raw.order_payments(spark, d))


def _reviews(spark, d) -> DataFrame:
    return staging.stg_order_reviews(raw.order_reviews(spark, d))


def _geolocation(spark, d) -> DataFrame:
    return staging.stg_geolocation(raw.geolocation(spark, d))


def _translation(spark, d) -> DataFrame:
    return staging.stg_category_translation(raw.category_translation(spark, d))


def _dim_customers(spark, d) -> DataFrame:
    return core.dim_customers(_customers(spark, d))


def _dim_sellers(spark, d) -> DataFrame:
    return core.dim_sellers(_sellers(spark, d))


def _dim_products(spark, d) -> DataFrame:
    return core.dim_products(_products(spark, d))


def _dim_geography(spark, d) -> DataFrame:
    return core.dim_geography(_geolocation(spark, d))


def _fct_orders(spark, d, with_line_ids: bool = False) -> DataFrame:
    """The order fact; only queries that show line keys ask for unique ones."""
    return core.fct_orders(_items(spark, d, with_line_ids), _orders(spark, d))


def _fct_payments(spark, d) -> DataFrame:
    return core.fct_payments(_payments(spark, d), _orders(spark, d))


def _fct_reviews(spark, d) -> DataFrame:
    return core.fct_reviews(_reviews(spark, d), _orders(spark, d))


def _gmv_monthly(spark, d) -> DataFrame:
    return marts.ads_gmv_monthly(_fct_orders(spark, d))


def _category_sales(spark, d) -> DataFrame:
    return marts.ads_category_sales(_fct_orders(spark, d), _dim_products(spark, d))


def _rfm(spark, d) -> DataFrame:
    return marts.dws_customer_rfm(_fct_orders(spark, d))


def _review_analysis(spark, d) -> DataFrame:
    return marts.ads_review_analysis(_fct_reviews(spark, d))


def _seller_performance(spark, d) -> DataFrame:
    return marts.dws_seller_performance(_dim_sellers(spark, d), _fct_orders(spark, d), _fct_reviews(spark, d))


def _all_raw(spark, d, with_line_ids: bool = True) -> dict[str, DataFrame]:
    loaded = {name: getattr(raw, name)(spark, d) for name in CONTRACTS if name != "order_items"}
    return {**loaded, "order_items": raw.order_items(spark, d, with_line_ids)}


# --- Sources, sinks, materialisation -----------------------------------------


@query
def src_csv_roundtrip(spark, d):
    path = work_path(spark, "csv")
    csv_files.export_csv(raw.customers(spark, d), f"{path}/public_customers_dataset.csv")
    return staging.stg_customers(csv_files.load_raw(spark, path, "customers"), at(LOAD_TS))


@query
def src_all_csv_roundtrip(spark, d):
    """All nine raw tables written as CSV, read by contract and staged: rows, and rows
    that then differ from the staged original.  Review texts get a line break."""
    path = work_path(spark, "csv")
    inputs = _all_raw(spark, d, with_line_ids=False)
    broken = F.concat(F.col("review_comment_message"), F.lit('\n"so, '), F.col("order_id"), F.lit('"'))
    inputs["order_reviews"] = inputs["order_reviews"].withColumn("review_comment_message", broken)
    counts = []
    for name, df in inputs.items():
        csv_files.export_csv(df, f"{path}/{CONTRACTS[name].file.replace('*', 'public')}")
        stage = staging.STAGING[name]
        moment = (at(LOAD_TS),) if name == "customers" else ()
        before, after = stage(df, *moment), stage(csv_files.load_raw(spark, path, name), *moment)
        both = before.withColumn("_n", F.lit(1)).unionByName(after.withColumn("_n", F.lit(-1)))
        # Copies are added up, so a row that comes back once less or more shows.
        changed = both.groupBy(*before.columns).agg(F.sum("_n").alias("_n"))
        counts.append(
            changed.agg(F.coalesce(F.sum(F.abs("_n")), F.lit(0)).alias("changed_rows")).select(
                F.lit(name).alias("table_name"), "changed_rows"
            )
        )
    rows = csv_files.load_audit(inputs).select("table_name", "row_count")
    return rows.join(union_all(counts), "table_name")


@query
def src_align_columns(spark, d):
    contract = CONTRACTS["products"]
    earlier = raw.products(spark, d).withColumnsRenamed({new: old for old, new in contract.old_names.items()})
    return staging.stg_products(csv_files.align_columns(earlier, contract.old_names))


@query
def src_optional_empty(spark, d):
    """Orders against payments whose optional file was not delivered."""
    missing = csv_files.load_raw(spark, work_path(spark, "no-files"), "order_payments")
    paid = staging.stg_order_payments(missing).groupBy("order_id").agg(F.count("*").alias("payments"))
    return (
        _orders(spark, d)
        .join(paid, "order_id", "left")
        .groupBy("order_status")
        .agg(F.count("*").alias("orders"), F.coalesce(F.sum("payments"), F.lit(0)).alias("payments"))
    )


@query
def src_optional_present(spark, d):
    """Orders against payments whose optional file was delivered, and delivered again."""
    path = work_path(spark, "files")
    payments = raw.order_payments(spark, d)
    by_slip = F.coalesce(F.col("payment_type") == "boleto", F.lit(False))
    for name, part in {"first": by_slip, "second": ~by_slip}.items():
        csv_files.export_csv(payments.filter(part), f"{path}/{name}_order_payments_dataset.csv")
    found = csv_files.load_raw(spark, path, "order_payments")
    paid = staging.stg_order_payments(found).groupBy("order_id").agg(F.count("*").alias("payments"))
    return (
        _orders(spark, d)
        .join(paid, "order_id", "left")
        .groupBy("order_status")
        .agg(F.count("*").alias("orders"), F.coalesce(F.sum("payments"), F.lit(0)).alias("payments"))
    )


@query
def src_load_audit(spark, d):
    return csv_files.load_audit(_all_raw(spark, d, with_line_ids=False))


@query
def mat_table_roundtrip(spark, d):
    return tables.write_table(_fct_payments(spark, d), work_path(spark, "fct_payments"), "order_month")


@query
def sink_csv_roundtrip(spark, d):
    mart = _gmv_monthly(spark, d)
    path = work_path(spark, "gmv_csv")
    csv_files.export_csv(mart, path)
    return csv_files.read_export(spark, path, mart.schema)


# --- Staging -----------------------------------------------------------------


@query
def stg_customers(spark, d):
    return _customers(spark, d)


@query
def stg_orders(spark, d):
    return _orders(spark, d)


@query
def stg_order_items(spark, d):
    return _items(spark, d, with_line_ids=True)


@query
def stg_products(spark, d):
    return _products(spark, d)


@query
def stg_sellers(spark, d):
    return _sellers(spark, d)


@query
def stg_order_payments(spark, d):
    return _payments(spark, d)


@query
def stg_order_reviews(spark, d):
    return _reviews(spark, d)


@query
def stg_geolocation(spark, d):
    return _geolocation(spark, d)


@query
def stg_category_translation(spark, d):
    """The translation file, written with the categories that the products carry, read and staged."""
    path = work_path(spark, "translation")
    csv_files.export_csv(raw.category_translation(spark, d), f"{path}/product_category_name_translation.csv")
    return staging.STAGING["category_translation"](csv_files.load_raw(spark, path, "category_translation"))


# --- Dimensions and facts ----------------------------------------------------


@query
def dim_customers(spark, d):
    return _dim_customers(spark, d)


@query
def dim_sellers(spark, d):
    return _dim_sellers(spark, d)


@query
def dim_sellers_conformed(spark, d):
    return core.dim_sellers(_sellers(spark, d), conformed=True)


@query
def dim_products(spark, d):
    return _dim_products(spark, d)


@query
def dim_products_unknown(spark, d):
    return core.dim_products(_products(spark, d), name_unknown=True)


@query
def dim_products_translated(spark, d):
    return core.dim_products_translated(_dim_products(spark, d), _translation(spark, d))


@query
def dim_geography(spark, d):
    return _dim_geography(spark, d)


@query
def fct_orders(spark, d):
    return _fct_orders(spark, d, with_line_ids=True)


@query
def fct_payments(spark, d):
    return _fct_payments(spark, d)


@query
def fct_reviews(spark, d):
    return _fct_reviews(spark, d)


@query
def fct_reviews_latest(spark, d):
    return core.latest_reviews(_fct_reviews(spark, d))


# --- Marts -------------------------------------------------------------------


@query
def ads_gmv_monthly(spark, d):
    return _gmv_monthly(spark, d)


@query
def ads_category_sales(spark, d):
    return _category_sales(spark, d)


@query
def ads_region_overview(spark, d):
    return marts.ads_region_overview(_fct_orders(spark, d), _dim_customers(spark, d))


@query
def ads_payment_analysis(spark, d):
    return marts.ads_payment_analysis(_fct_payments(spark, d))


@query
def ads_review_analysis(spark, d):
    return _review_analysis(spark, d)


@query
def dws_customer_rfm(spark, d):
    return _rfm(spark, d)


@query
def dws_customer_rfm_with_keep(spark, d):
    return marts.dws_customer_rfm(_fct_orders(spark, d), rfm_segment_with_keep)


@query
def dws_seller_performance(spark, d):
    return _seller_performance(spark, d)


@query
def ads_kpi_summary(spark, d):
    """The catalog from stored marts; they, and what they read, are stored first and nothing else."""
    inputs = _all_raw(spark, d, with_line_ids=False)
    built = warehouse.build(spark, inputs, work_path(spark, "warehouse"), at(LOAD_TS), ["ads_kpi_summary"])
    return built["ads_kpi_summary"]


@query
def kpi_review_block(spark, d):
    reviews = settle(_fct_reviews(spark, d).select(*REVIEW_MEASURES), "fct_reviews")
    return kpi.review_block(reviews, marts.ads_review_analysis(reviews))


@query
def metric_gmv(spark, d):
    return (
        _fct_orders(spark, d)
        .groupBy("order_status")
        .agg(
            gmv("order_amount").cast(marts.TOTAL).alias("gmv"),
            gmv_all("order_amount").cast(marts.TOTAL).alias("gmv_all"),
        )
    )


@query
def ntile_distributed(spark, d):
    """Quartiles of all orders by line total, one order per row."""
    totals = _fct_orders(spark, d).groupBy("order_id").agg(F.sum("order_amount").cast(marts.TOTAL).alias("amount"))
    return with_ntiles(settle(totals, "order_totals"), "order_id", {"amount_tile": "amount"}, 10)


# --- Incremental loading -----------------------------------------------------
# Run 1 holds the lines before RUN_1_BEFORE.  Where lines come late, those
# without freight were not delivered in run 1.  Where lines change, run 2
# raises the price of lines of approved orders by one.


def _run_1(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("order_date") < F.lit(RUN_1_BEFORE).cast("date"))


def _on_time(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("freight_value") > 0)


def _corrected(fact: DataFrame) -> DataFrame:
    raised = F.when(F.col("order_status") == "approved", F.lit(1)).otherwise(F.lit(0)).cast("decimal(10,2)")
    return fact.withColumns(
        {
            "price": (F.col("price") + raised).cast("decimal(10,2)"),
            "order_amount": (F.col("order_amount") + raised).cast("decimal(13,2)"),
        }
    )


def _misdated(fact: DataFrame) -> DataFrame:
    wrong = F.col("order_status") == "approved"
    return fact.withColumns(
        {
            "order_date": F.when(wrong, F.add_months("order_date", -1)).otherwise(F.col("order_date")),
            "order_month": F.when(
                wrong, F.add_months("order_month", -1).cast("timestamp_ntz")
            ).otherwise(F.col("order_month")),
        }
    )


def _started(spark, d, rows, indexed=False) -> tuple[DataFrame, str]:
    """The stored fact of run 2 and the path of the table that run 1 loaded."""
    fact = settle(_fct_orders(spark, d, with_line_ids=True), "fct_orders")
    path = work_path(spark, "target")
    incremental.full_refresh(rows(fact), path, indexed)
    return fact, path


@query
def inc_full_refresh(spark, d):
    fact, path = _started(spark, d, _run_1)
    return incremental.full_refresh(fact, path)


@query
def inc_append(spark, d):
    fact, path = _started(spark, d, _run_1)
    return incremental.append_new(fact, path)


@query
def inc_lookback_dedup(spark, d):
    fact, path = _started(spark, d, lambda f: _on_time(_run_1(f)))
    delivered = _corrected(fact)
    return incremental.append_with_lookback(delivered.unionByName(delivered), path)


@query
def inc_merge(spark, d):
    """Late, changed and new lines are delivered and merged by key.  Lines of run 1
    whose approved orders were stored a month too early move to their month."""
    fact, path = _started(spark, d, lambda f: _misdated(_on_time(_run_1(f))), indexed=True)
    new = F.col("order_date") >= F.lit(RUN_1_BEFORE).cast("date")
    late_or_changed = (F.col("freight_value") <= 0) | (F.col("order_status") == "approved")
    return incremental.merge(_corrected(fact).filter(new | late_or_changed), path)


@query
def inc_delete_insert(spark, d):
    fact, path = _started(spark, d, _run_1)
    delivered = _corrected(fact).filter(F.col("order_month") >= at(REDELIVERED_FROM))
    return incremental.replace_months(delivered, path)


@query
def inc_missed_rows(spark, d):
    fact, path = _started(spark, d, lambda f: _on_time(_run_1(f)))
    rebuilt = _corrected(fact)
    return incremental.missed_rows(incremental.append_new(rebuilt, path), rebuilt)


@query
def stream_inc_fact(spark, d):
    """Lines of run 1 arrive as files, then those of run 2 with the last days again and
    lines that are years late; a restart with a new checkpoint delivers all once more.
    ``late_lines`` counts what came behind the mark."""
    fact = settle(_fct_orders(spark, d, with_line_ids=True), "fct_orders")
    feed, path, checkpoint = (work_path(spark, p) for p in ("feed", "target", "stream"))
    since = F.date_sub(F.lit(RUN_1_BEFORE).cast("date"), 5)
    late = F.col("freight_value") <= 0
    for delivery in (_on_time(_run_1(fact)), fact.filter((F.col("order_date") >= since) | late)):
        delivery.write.mode("append").parquet(feed)
        order_feed.merge_into(order_feed.line_stream(spark, feed, fact.schema), path, checkpoint)
    order_feed.merge_into(order_feed.line_stream(spark, feed, fact.schema), path, work_path(spark, "stream"))
    months = order_feed.monthly_gmv(tables.read_table(spark, path, fact.schema))
    late = order_feed.late_lines(spark, path, fact.schema)
    late = late.groupBy(month_of("order_date").alias("order_month")).agg(F.count("*").alias("late_lines"))
    return months.join(late, "order_month", "left").fillna(0, ["late_lines"])


# --- Slowly changing dimensions ----------------------------------------------
# Between two snapshots the customers whose id ends in 0 move to the next state.


def _moved(customers: DataFrame, moved_at: str) -> DataFrame:
    mover = F.col("customer_id").endswith("0")
    codes = [F.lit(x) for i, s in enumerate(raw.STATES) for x in (s, raw.STATES[(i + 1) % len(raw.STATES)])]
    return customers.withColumns(
        {
            "customer_state": F.when(mover, F.create_map(*codes)[F.col("customer_state")]).otherwise(
                F.col("customer_state")
            ),
            "updated_at": F.when(mover, at(moved_at)).otherwise(F.col("updated_at")),
        }
    )


def _history(spark, d, first: str, second: str) -> DataFrame:
    """Three stored snapshots, the last one of an unchanged source."""
    before = _customers(spark, d, first)
    root = work_path(spark, "history")
    for source in (before, _moved(before, second), _moved(before, second)):
        scd.snapshot(source, root, "customer_id", F.col("updated_at"), scd.timestamp_rule("customer_id", "updated_at"))
    return scd.read_history(spark, root, before.schema)


@query
def scd2_timestamp(spark, d):
    return _history(spark, d, LOAD_TS, MOVE_TS)


@query
def scd2_check(spark, d):
    before = _customers(spark, d).drop("updated_at")
    after = _moved(_customers(spark, d), MOVE_TS).drop("updated_at")
    root = work_path(spark, "history")
    rule = scd.check_rule("customer_id", ["customer_city", "customer_state"], at(MOVE_TS))
    for source in (before, after, after):
        scd.snapshot(source, root, "customer_id", at(LOAD_TS), rule)
    return scd.read_history(spark, root, before.schema)


@query
def scd2_current(spark, d):
    return scd.current(_history(spark, d, LOAD_TS, MOVE_TS))


@query
def scd2_as_of_date(spark, d):
    return scd.as_of(_history(spark, d, SNAPSHOT_1, SNAPSHOT_2), at(AS_OF))


@query
def scd2_point_in_time_join(spark, d):
    history = _history(spark, d, SNAPSHOT_1, SNAPSHOT_2)
    lines = _fct_orders(spark, d, with_line_ids=True).select("order_item_key", "customer_id", "order_date", "order_amount")
    return scd.point_in_time(lines, history, "customer_id", "order_date", ["customer_state"])


@query
def scd1_overwrite(spark, d):
    before = _customers(spark, d)
    return scd.overwrite(before, _moved(before, MOVE_TS).filter(F.col("updated_at") == at(MOVE_TS)), "customer_id")


@query
def scd3_previous(spark, d):
    before = _customers(spark, d)
    return scd.keep_previous(before, _moved(before, MOVE_TS), "customer_id", "customer_state")


@query
def scd0_insert_only(spark, d):
    """Known customers keep their first values; unknown ones are added."""
    before = _customers(spark, d)
    known = before.filter(~F.col("customer_id").endswith("5"))
    return scd.insert_only(known, _moved(before, MOVE_TS), "customer_id")


# --- Data quality ------------------------------------------------------------


@query
def dq_unique(spark, d):
    """Line numbers of the driver table repeat within an order."""
    lines = raw.read(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"))
    return quality.duplicates(lines, "line_key")


@query
def dq_not_null(spark, d):
    return quality.nulls(_fct_payments(spark, d), "customer_id")


@query
def dq_accepted_values(spark, d):
    return quality.unaccepted(_payments(spark, d), "payment_type", ["credit_card", "boleto"])


@query
def dq_relationships(spark, d):
    return quality.orphans(_payments(spark, d), "order_id", _orders(spark, d), "order_id")


@query
def dq_value_range(spark, d):
    return quality.out_of_range(_payments(spark, d), "payment_value", low=1, high=100)


@query
def dq_not_empty_string(spark, d):
    return quality.empty_strings(_reviews(spark, d), "review_comment_message")


@query
def dq_gmv_consistency(spark, d):
    return quality.gmv_inconsistent(_gmv_monthly(spark, d))


@query
def dq_positive_gmv(spark, d):
    return quality.gmv_negative(_gmv_monthly(spark, d))


@query
def dq_rfm_completeness(spark, d):
    return quality.rfm_incomplete(_rfm(spark, d))


# The business rules once more on marts that are wrong: every third month by number, and customers
# with the best recency.


def _wrong_months(spark, d) -> DataFrame:
    wrong = F.month("order_month") % 3 == 0
    months = _gmv_monthly(spark, d)
    return months.withColumn(
        "gmv_delivered",
        F.when(wrong & (F.month("order_month") % 2 == 0), -F.col("gmv_all"))
        .when(wrong, F.col("gmv_all") * 2)
        .otherwise(F.col("gmv_delivered"))
        .cast("decimal(38,2)"),
    )


@query
def dq_gmv_consistency_broken(spark, d):
    return quality.gmv_inconsistent(_wrong_months(spark, d))


@query
def dq_positive_gmv_broken(spark, d):
    return quality.gmv_negative(_wrong_months(spark, d))


@query
def dq_rfm_completeness_broken(spark, d):
    r = F.col("r_score")
    gone = F.when(r == 4, F.lit(None)).when(r == 3, F.lit("")).otherwise(F.col("rfm_segment"))
    return quality.rfm_incomplete(_rfm(spark, d).withColumn("rfm_segment", gone))


@query
def union_distinct_places(spark, d):
    """Every place that a buyer or a seller has, once."""
    buyers = _customers(spark, d).select(F.col("customer_city").alias("city"), F.col("customer_state").alias("state"))
    sellers = _sellers(spark, d).select(F.col("seller_city").alias("city"), F.col("seller_state").alias("state"))
    return union_distinct([buyers, sellers])


@query
def dq_warn_orders_without_items(spark, d):
    """Stays visible as a warning: orders whose amount no mart can see."""
    rules = [r for r in quality.RULES if r.severity == quality.WARN]
    lost = quality.suite_report({"stg_orders": _orders(spark, d), "stg_order_items": _items(spark, d)}, rules)
    return lost.select(F.lit("orders_without_items").alias("rule"), "severity", "failures", "status")


@query
def dq_contract(spark, d):
    """Raw tables under their earlier column names against the contract."""
    drifts = []
    for name, df in _all_raw(spark, d, with_line_ids=False).items():
        contract = CONTRACTS[name]
        earlier = df.withColumnsRenamed({new: old for old, new in contract.old_names.items()})
        drifts.append(quality.contract_drift(earlier, name, contract.columns))
    return union_all(drifts)


@query
def warehouse_build(spark, d):
    """Rows of every table of a release: built, checked, published, read."""
    root = work_path(spark, "warehouse")
    inputs = _all_raw(spark, d)
    warehouse.release(spark, inputs, root, load_ts=at(LOAD_TS))
    rows = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in warehouse.released(spark, root).items()
    ]
    return union_all(rows)


@query
def dq_suite_report(spark, d):
    """All declared rules on a freshly built warehouse."""
    built = warehouse.build(spark, _all_raw(spark, d), work_path(spark, "warehouse"), at(LOAD_TS))
    return quality.suite_report(built, quality.RULES)


@query
def dq_gate(spark, d):
    """Write versions of the payment fact, check each, publish it if no error."""
    root = work_path(spark, "published")
    version = f"{root}/fct_payments/1"
    written = tables.write_table(_fct_payments(spark, d), version, "order_month")
    rules = [r for r in quality.RULES if r.table == "fct_payments"]
    report = settle(quality.suite_report({"fct_payments": written}, rules), "report")
    if quality.may_publish(report):
        tables.publish(spark, root, version)
    # A second version loses the type of vouchers.  It is checked and held back.
    spoiled = tables.write_table(_spoiled(_fct_payments(spark, d)), f"{root}/fct_payments/2", "order_month")
    if quality.may_publish(quality.suite_report({"fct_payments": spoiled}, rules)):
        tables.publish(spark, root, f"{root}/fct_payments/2")
    public = tables.published(spark, root, written.schema)
    return public.groupBy("payment_type").agg(
        F.count("*").alias("payment_count"), F.sum("payment_value").cast(marts.TOTAL).alias("paid")
    )


def _spoiled(payments: DataFrame) -> DataFrame:
    return payments.withColumn("payment_type", F.when(F.col("payment_type") != "voucher", F.col("payment_type")))


@query
def dq_gate_blocked(spark, d):
    """Why the gate holds back a version without the type of vouchers."""
    rules = [r for r in quality.RULES if r.table == "fct_payments"]
    return quality.suite_report({"fct_payments": settle(_spoiled(_fct_payments(spark, d)), "fct_payments")}, rules)


# --- Audits ------------------------------------------------------------------


@query
def audit_fanout_inflation(spark, d):
    return audits.fanout_inflation(_fct_orders(spark, d), _reviews(spark, d))


@query
def audit_join_loss(spark, d):
    return audits.join_loss(_orders(spark, d), _items(spark, d), "order_id")


@query
def audit_total_reconcile(spark, d):
    fact = settle(_fct_orders(spark, d).select(*ORDER_MEASURES), "fct_orders")
    delivered = fact.filter("is_delivered")
    return audits.total_reconcile(
        delivered,
        "order_amount",
        {
            "ads_gmv_monthly": (marts.ads_gmv_monthly(fact), "gmv_delivered"),
            "ads_category_sales": (marts.ads_category_sales(fact, _dim_products(spark, d)), "gmv"),
            "ads_region_overview": (marts.ads_region_overview(fact, _dim_customers(spark, d)), "gmv"),
            "dws_seller_performance": (marts.seller_sales(fact), "gmv_delivered"),
        },
    )


@query
def audit_key_multiplicity(spark, d):
    return audits.key_multiplicity(_reviews(spark, d), "review_id")


@query
def audit_order_count_two_ways(spark, d):
    return audits.order_count_two_ways(_fct_orders(spark, d), _orders(spark, d))


@query
def recon_order_payment(spark, d):
    return audits.payment_reconciliation(_fct_orders(spark, d), _payments(spark, d))


# --- Profiling ---------------------------------------------------------------


@query
def probe_table_sizes(spark, d):
    loaded = _all_raw(spark, d, with_line_ids=False)
    return profiling.table_sizes({n: loaded[n] for n in ("orders", "order_items", "customers", "products")})


@query
def probe_missing_category(spark, d):
    return profiling.missing_category(raw.products(spark, d))


@query
def probe_status_distribution(spark, d):
    return profiling.status_distribution(raw.orders(spark, d))


@query
def probe_orders_without_items(spark, d):
    items = raw.order_items(spark, d, with_line_ids=False)
    return profiling.unmatched_rows(raw.orders(spark, d), items, "order_id", "orders_without_items")


@query
def probe_orphan_products(spark, d):
    items = raw.order_items(spark, d, with_line_ids=False)
    return profiling.unmatched_rows(items, raw.products(spark, d), "product_id", "orphan_products")


@query
def probe_orphan_customers(spark, d):
    return profiling.unmatched_rows(raw.orders(spark, d), raw.customers(spark, d), "customer_id", "orphan_customers")


@query
def probe_time_inversion(spark, d):
    return profiling.time_inversion(raw.deliveries(spark, d))


@query
def probe_price_anomaly(spark, d):
    return profiling.price_anomaly(raw.order_items(spark, d, with_line_ids=False))


@query
def probe_blank_location(spark, d):
    return profiling.blank_location(raw.customers(spark, d))


@query
def probe_time_span(spark, d):
    return profiling.time_span(raw.orders(spark, d))


# --- Documented analyses -----------------------------------------------------


@query
def adhoc_customers_over_n(spark, d):
    return adhoc.customers_over_n(_orders(spark, d), 2)


@query
def adhoc_orders_per_state(spark, d):
    return adhoc.orders_per_state(_orders(spark, d), _customers(spark, d))


@query
def adhoc_item_totals(spark, d):
    return adhoc.item_totals(_items(spark, d))


@query
def adhoc_rfm_distribution(spark, d):
    return adhoc.rfm_distribution(_rfm(spark, d))


@query
def adhoc_gmv_trend(spark, d):
    return adhoc.gmv_trend(_gmv_monthly(spark, d))


@query
def adhoc_category_rank(spark, d):
    return adhoc.category_rank(_category_sales(spark, d))


@query
def adhoc_topk_latest_orders(spark, d):
    return adhoc.latest_orders(_orders(spark, d), 10)


@query
def adhoc_topk_cancelled_orders(spark, d):
    return adhoc.latest_orders(_orders(spark, d), 10, V.CANCELLED)


@query
def adhoc_monthly_running_gmv(spark, d):
    return adhoc.monthly_running_gmv(_gmv_monthly(spark, d))


@query
def adhoc_seller_rank(spark, d):
    return adhoc.seller_rank(settle(marts.seller_sales(_fct_orders(spark, d)), "seller_sales"))


@query
def adhoc_region_flow(spark, d):
    shops = core.dim_sellers(_sellers(spark, d), conformed=True)
    return adhoc.region_flow(_fct_orders(spark, d), _dim_customers(spark, d), shops)


@query
def adhoc_cross_state_share(spark, d):
    return adhoc.cross_state_share(_fct_orders(spark, d), _dim_customers(spark, d), _dim_sellers(spark, d))


@query
def adhoc_delivery_distance(spark, d):
    return adhoc.delivery_distance(
        _fct_orders(spark, d), _dim_customers(spark, d), _dim_sellers(spark, d), _dim_geography(spark, d)
    )


@query
def adhoc_shared_reviews(spark, d):
    return adhoc.shared_reviews(_fct_reviews(spark, d))


@query
def adhoc_score_decline(spark, d):
    return adhoc.score_decline(_review_analysis(spark, d))


@query
def pay_mix(spark, d):
    return adhoc.payment_mix(_payments(spark, d))


@query
def pay_installment_hist(spark, d):
    return adhoc.installment_histogram(_payments(spark, d))
