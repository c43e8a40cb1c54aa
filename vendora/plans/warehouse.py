"""All tables from nine raw inputs, each a function of the ones before it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession

from vendora.operators import core
from vendora.operators.quality import RULES, Rule, may_publish, suite_report
from vendora.operators.staging import STAGING, stg_customers
from vendora.plans import kpi, marts
from vendora.session import settle
from vendora.sources.tables import newest_version, publish, write_table

STORED = [
    "dim_customers", "dim_sellers", "dim_products", "dim_geography", "fct_orders", "fct_payments", "fct_reviews",
    "ads_gmv_monthly", "ads_category_sales", "ads_region_overview", "ads_payment_analysis", "ads_review_analysis",
    "dws_customer_rfm", "dws_seller_performance", "ads_kpi_summary",
]
# What each of them reads of the others, in the order of its arguments.
READS = {
    "ads_gmv_monthly": ["fct_orders"],
    "ads_category_sales": ["fct_orders", "dim_products"],
    "ads_region_overview": ["fct_orders", "dim_customers"],
    "ads_payment_analysis": ["fct_payments"],
    "ads_review_analysis": ["fct_reviews"],
    "dws_customer_rfm": ["fct_orders"],
    "dws_seller_performance": ["dim_sellers", "fct_orders", "fct_reviews"],
    "ads_kpi_summary": [
        "ads_gmv_monthly", "dws_customer_rfm", "fct_reviews", "ads_review_analysis", "dws_seller_performance",
        "fct_payments",
    ],
}
# Tables written at a time.
WRITERS = 8
PARTITIONED = {"fct_orders": "order_month", "fct_payments": "order_month", "fct_reviews": "order_month"}
# Rows that come gathered by month.
GATHERED = {"fct_orders"}


def staging(raw: dict[str, DataFrame], load_ts: Column | None = None) -> dict[str, DataFrame]:
    """Staging stays lazy: typed views on the raw tables."""
    views = {f"stg_{name}": STAGING[name](df) for name, df in raw.items() if name != "customers"}
    views["stg_customers"] = stg_customers(raw["customers"], load_ts)
    return views


def register(tables: dict[str, DataFrame]) -> None:
    """Offer the tables to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def with_inputs(wanted: Iterable[str]) -> set[str]:
    """The wanted tables and every stored table that they read, at any remove."""
    found: set[str] = set()
    left = list(wanted)
    while left:
        name = left.pop()
        if name not in STORED:
            raise ValueError(f"no stored table {name}")
        if name not in found:
            found.add(name)
            left += READS.get(name, [])
    return found


def build(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    load_ts: Column | None = None,
    wanted: Iterable[str] = STORED,
) -> dict:
    """Rebuild the wanted tables below ``root``, and what they read; later tables read the stored ones.

    A few tables are written at the same time, each as soon as those are stored that it reads."""
    t = staging(raw, load_ts)
    # Every table stands behind what it reads; the longest ways come first.
    plans: dict[str, Callable[[], DataFrame]] = {
        "fct_orders": lambda: core.fct_orders(t["stg_order_items"], t["stg_orders"], gathered=True),
        "fct_reviews": lambda: core.fct_reviews(t["stg_order_reviews"], t["stg_orders"]),
        "dim_sellers": lambda: core.dim_sellers(t["stg_sellers"]),
        "fct_payments": lambda: core.fct_payments(t["stg_order_payments"], t["stg_orders"]),
        "dim_customers": lambda: core.dim_customers(t["stg_customers"]),
        "dim_products": lambda: core.dim_products(t["stg_products"]),
        "dim_geography": lambda: core.dim_geography(t["stg_geolocation"]),
        "dws_customer_rfm": lambda: marts.dws_customer_rfm(t["fct_orders"]),
        "dws_seller_performance": lambda: marts.dws_seller_performance(
            t["dim_sellers"], t["fct_orders"], t["fct_reviews"], stored=True
        ),
        "ads_gmv_monthly": lambda: marts.ads_gmv_monthly(t["fct_orders"]),
        "ads_review_analysis": lambda: marts.ads_review_analysis(t["fct_reviews"]),
        "ads_category_sales": lambda: marts.ads_category_sales(t["fct_orders"], t["dim_products"]),
        "ads_region_overview": lambda: marts.ads_region_overview(t["fct_orders"], t["dim_customers"]),
        "ads_payment_analysis": lambda: marts.ads_payment_analysis(t["fct_payments"]),
        "ads_kpi_summary": lambda: kpi.ads_kpi_summary(*[t[name] for name in READS["ads_kpi_summary"]]),
    }
    stored: dict[str, Future] = {}

    def write(name: str) -> DataFrame:
        t.update({read: stored[read].result() for read in READS.get(name, [])})
        return write_table(plans[name](), f"{root}/{name}", PARTITIONED.get(name), name in GATHERED)

    built = with_inputs(wanted)
    with ThreadPoolExecutor(WRITERS) as pool:
        for name in plans:
            if name in built:
                stored[name] = pool.submit(write, name)
    return t | {name: one.result() for name, one in stored.items()}


def release(
    spark: SparkSession, raw: dict[str, DataFrame], root: str, rules: Iterable[Rule] = RULES, load_ts: Column | None = None
) -> tuple[DataFrame, bool]:
    """Build a new version of all tables, check it, and publish it if no rule of severity
    error failed.  Returns the report and whether it was published; until then, and
    if it is not, readers see the version before."""
    version = f"{root}/version-{newest_version(spark, root)[0] + 1}"
    report = settle(suite_report(build(spark, raw, version, load_ts), rules), "report")
    passed = may_publish(report)
    if passed:
        publish(spark, root, version)
    return report, passed


def released(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored tables of the published version; none before the first one."""
    _, version = newest_version(spark, root)
    return {} if version is None else {name: spark.read.parquet(f"{version}/{name}") for name in STORED}
