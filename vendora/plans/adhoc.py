"""Analyses that the documentation describes and no mart stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendora.functions.metrics import haversine_km
from vendora.functions.rounding import percent
from vendora.functions.tiles import with_rank_desc


def customers_over_n(orders: DataFrame, n: int) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.count("*").alias("order_cnt")).filter(F.col("order_cnt") > n)


def orders_per_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders are folded to customers before the join."""
    per_customer = orders.groupBy("customer_id").agg(F.count("*").alias("n"))
    return (
        per_customer.join(customers.select("customer_id", "customer_state"), "customer_id", "left")
        .groupBy("customer_state")
        .agg(F.sum("n").alias("order_cnt"))
        .orderBy(F.desc("order_cnt"))
    )


def item_totals(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count("*").alias("line_count"),
        F.sum("price").cast("decimal(38,2)").alias("price_total"),
        (F.sum("price").cast("double") / F.nullif(F.count("price"), F.lit(0))).alias("price_avg"),
        F.max("price").alias("price_max"),
    )


def rfm_distribution(rfm: DataFrame, m_scores: list[int] | None = None) -> DataFrame:
    chosen = rfm if m_scores is None else rfm.filter(F.col("m_score").isin(m_scores))
    return chosen.groupBy("rfm_segment", "m_score").agg(F.count("*").alias("customers"))


def gmv_trend(monthly: DataFrame) -> DataFrame:
    return monthly.select("order_month", "gmv_delivered", "gmv_all").orderBy("order_month")


def category_rank(category_sales: DataFrame) -> DataFrame:
    return (
        category_sales.groupBy("product_category_cn")
        .agg(F.sum("gmv").cast("decimal(38,2)").alias("gmv"))
        .orderBy(F.desc("gmv"))
    )


def latest_orders(orders: DataFrame, n: int, status: str | None = None) -> DataFrame:
    """The ``n`` newest orders; the order id settles equal times."""
    chosen = orders if status is None else orders.filter(F.col("order_status") == status)
    return chosen.orderBy(F.col("order_purchased_at").desc_nulls_last(), "order_id").limit(n)


def monthly_running_gmv(monthly: DataFrame) -> DataFrame:
    """Running total over the monthly mart: one row per calendar month."""
    upto = W.orderBy("order_month").rowsBetween(W.unboundedPreceding, W.currentRow)
    return monthly.select(
        "order_month",
        "gmv_delivered",
        F.sum("gmv_delivered").over(upto).cast("decimal(38,2)").alias("running_gmv"),
    )


def seller_rank(sellers: DataFrame) -> DataFrame:
    ranked = with_rank_desc(sellers.select("seller_id", "gmv_delivered"), "gmv_delivered", "gmv_rank")
    return ranked.select("seller_id", "gmv_delivered", F.col("gmv_rank").cast("long").alias("gmv_rank"))


def _by_parties(fct_orders: DataFrame) -> DataFrame:
    """Lines folded to (customer, seller) pairs that did trade, with line counts."""
    return fct_orders.groupBy("customer_id", "seller_id").agg(F.count("*").alias("lines"))


def region_flow(fct_orders: DataFrame, dim_customers: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    buyers = dim_customers.select("customer_id", F.col("region").alias("customer_region"))
    shops = dim_sellers.select("seller_id", F.col("region").alias("seller_region"))
    return (
        _by_parties(fct_orders)
        .join(buyers, "customer_id")
        .join(shops, "seller_id")
        .groupBy("customer_region", "seller_region")
        .agg(F.sum("lines").alias("line_count"))
    )


def cross_state_share(fct_orders: DataFrame, dim_customers: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    """Share of lines whose seller sits in another state, by customer state.

    Lines of an unknown customer are a group of their own; a line with an
    unknown party counts as a line and not as a crossing."""
    pairs = (
        _by_parties(fct_orders)
        .join(dim_customers.select("customer_id", "customer_state"), "customer_id", "left")
        .join(dim_sellers.select("seller_id", "seller_state"), "seller_id", "left")
    )
    crossing = F.when(F.col("customer_state") != F.col("seller_state"), F.col("lines")).otherwise(F.lit(0))
    counted = pairs.groupBy("customer_state").agg(
        F.sum("lines").alias("line_count"), F.sum(crossing).alias("cross_state_lines")
    )
    return counted.withColumn("cross_state_pct", percent(F.col("cross_state_lines"), F.col("line_count")))


def delivery_distance(
    fct_orders: DataFrame, dim_customers: DataFrame, dim_sellers: DataFrame, dim_geography: DataFrame
) -> DataFrame:
    """Mean seller-to-buyer distance by seller state, over zip centroids.

    Lines are folded to pairs of zip codes, so each distance is worked out once
    and weighted by its lines.  Lines without both centroids, or without a known
    buyer or seller, are counted apart; those without a seller have no state."""
    def centroid(prefix: str) -> DataFrame:
        return dim_geography.select(
            F.col("zip_code_prefix").alias(f"{prefix}_zip"),
            F.col("latitude_avg").alias(f"{prefix}_lat"),
            F.col("longitude_avg").alias(f"{prefix}_lng"),
        )

    buyers = dim_customers.select("customer_id", F.col("customer_zip_code").alias("to_zip"))
    shops = dim_sellers.select("seller_id", "seller_state", F.col("seller_zip_code_prefix").alias("from_zip"))
    routes = (
        _by_parties(fct_orders)
        .join(buyers, "customer_id", "left")
        .join(shops, "seller_id", "left")
        .groupBy("seller_state", "from_zip", "to_zip")
        .agg(F.sum("lines").alias("lines"))
        .join(centroid("from"), "from_zip", "left")
        .join(centroid("to"), "to_zip", "left")
        .withColumn("km", haversine_km(F.col("from_lat"), F.col("from_lng"), F.col("to_lat"), F.col("to_lng")))
    )
    located = F.when(F.col("km").isNotNull(), F.col("lines")).otherwise(F.lit(0))
    return (
        routes.groupBy("seller_state")
        .agg(
            F.sum("lines").alias("line_count"),
            F.sum(located).alias("located_lines"),
            F.sum(F.col("km") * F.col("lines")).alias("km"),
        )
        .select(
            "seller_state",
            "line_count",
            "located_lines",
            F.round(F.col("km") / F.nullif("located_lines", F.lit(0)), 3).alias("avg_km"),
        )
    )


def shared_reviews(fct_reviews: DataFrame) -> DataFrame:
    return fct_reviews.filter("is_shared_review_id").agg(
        F.count("*").alias("shared_rows"), F.count_distinct("review_id").alias("shared_ids")
    )


def score_decline(review_analysis: DataFrame, drops: int = 2) -> DataFrame:
    """Months whose mean score fell ``drops`` times in a row.

    The window runs over the monthly mart: one row per calendar month."""
    by_month = W.orderBy("order_month")
    fell = F.coalesce(F.col("avg_review_score") < F.lag("avg_review_score").over(by_month), F.lit(False))
    marked = review_analysis.select("order_month", "avg_review_score", fell.alias("fell"))
    recent = by_month.rowsBetween(-(drops - 1), 0)
    return marked.withColumn(
        "is_warning", (F.sum(F.col("fell").cast("int")).over(recent) == drops)
    )


def payment_mix(payments: DataFrame) -> DataFrame:
    """Orders by how many payment types they combine."""
    types = payments.groupBy("order_id").agg(F.count_distinct("payment_type").alias("payment_types"))
    counted = types.groupBy("payment_types").agg(F.count("*").alias("order_count"))
    # One row per number of types.
    total = F.sum("order_count").over(W.partitionBy())
    return counted.withColumn("order_share_pct", percent(F.col("order_count"), total))


def installment_histogram(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_installments").agg(
        F.count("*").alias("payment_count"), F.sum("payment_value").cast("decimal(38,2)").alias("paid")
    )
