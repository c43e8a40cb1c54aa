"""Dimensions and facts.  Business flags are computed here and nowhere else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendora.functions import fixed_values as V
from vendora.functions.grouping import numbered
from vendora.functions.metrics import is_core_state, is_true, label_of, region_of, weight_tier
from vendora.functions.rounding import month_of
from vendora.session import settle

# Orders grow with the facts that join them, so they are never broadcast.  The
# merge join also leaves the rows partitioned by order, which groupings by order
# downstream use without another shuffle.
GROWS = "merge"


def dim_customers(customers: DataFrame) -> DataFrame:
    state = F.col("customer_state")
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "customer_zip_code",
        region_of(state, V.CUSTOMER_REGIONS, V.CUSTOMER_REGION_OTHER).alias("region"),
        is_core_state(state).alias("is_core_market"),
    )


def dim_sellers(sellers: DataFrame, conformed: bool = False) -> DataFrame:
    """Seller regions carry their own labels and know fewer states;
    ``conformed`` uses the customers' regions so that both can be compared."""
    state = F.col("seller_state")
    regions = (
        (V.CUSTOMER_REGIONS, V.CUSTOMER_REGION_OTHER) if conformed else (V.SELLER_REGIONS, V.SELLER_REGION_OTHER)
    )
    return sellers.select(
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
        region_of(state, *regions).alias("region"),
        is_core_state(state).alias("is_core_market"),
    )


def dim_products(products: DataFrame, name_unknown: bool = False) -> DataFrame:
    """``name_unknown`` gives products without a category a label of their own."""
    category = F.col("product_category")
    label = label_of(category, V.CATEGORY_LABELS, V.CATEGORY_OTHER)
    if name_unknown:
        label = F.when(category.isNull(), V.UNKNOWN_CATEGORY_LABEL).otherwise(label)
        category = F.coalesce(category, F.lit(V.UNKNOWN_CATEGORY))
    return products.select(
        "product_id",
        category.alias("product_category"),
        label.alias("product_category_cn"),
        "product_weight_g",
        weight_tier(F.col("product_weight_g")).alias("weight_tier"),
    )


def dim_products_translated(dim: DataFrame, translation: DataFrame) -> DataFrame:
    return dim.join(
        translation, dim["product_category"] == translation["category_name_pt"], "left"
    ).select(*dim.columns, F.col("category_name_en").alias("product_category_en"))


def dim_geography(geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix.  Equally frequent names resolve to the smallest."""
    zips = geolocation.groupBy("zip_code_prefix").agg(
        F.round(F.avg("latitude"), 6).alias("latitude_avg"),
        F.round(F.avg("longitude"), 6).alias("longitude_avg"),
        F.count("*").alias("measurement_count"),
        F.round(F.stddev_samp("latitude"), 6).alias("latitude_stddev"),
    )
    for name in ("geo_city", "geo_state"):
        usual = _most_frequent(geolocation, name).withColumnRenamed("zip_code_prefix", "_zip")
        zips = zips.join(usual, F.col("zip_code_prefix").eqNullSafe(F.col("_zip")), "left").drop("_zip")
    return zips.select(
        "zip_code_prefix", "latitude_avg", "longitude_avg", "geo_city", "geo_state", "measurement_count", "latitude_stddev"
    )


def _most_frequent(geolocation: DataFrame, name: str) -> DataFrame:
    """Names are counted per zip first, so no zip's names meet in one buffer."""
    counts = geolocation.filter(F.col(name).isNotNull()).groupBy("zip_code_prefix", name).agg(F.count("*").alias("n"))
    return counts.groupBy("zip_code_prefix").agg(F.min_by(name, F.struct(-F.col("n"), F.col(name))).alias(name))


def fct_orders(items: DataFrame, orders: DataFrame, gathered: bool = False) -> DataFrame:
    """One row per order line.  Lines without an order and orders without
    lines drop out; :func:`vendora.operators.audits.join_loss` counts them.

    ``gathered`` puts the lines of a month together and in order, ready for ``write_table``; columns that follow
    from others are added behind that shuffle."""
    purchased = F.col("order_purchased_at")
    zero = F.lit(0).cast("decimal(10,2)")
    lines = items.join(orders.hint(GROWS), "order_id").select(
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_status",
        F.to_date(purchased).alias("order_date"),
        month_of(purchased).alias("order_month"),
        "price",
        "freight_value",
    )
    if gathered:
        lines = lines.hint("rebalance", "order_month").sortWithinPartitions("order_month", "order_id")
    return lines.select(
        F.concat("order_id", F.lit("-"), F.col("order_item_id").cast("string")).alias("order_item_key"),
        "order_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_status",
        "order_date",
        "order_month",
        "price",
        "freight_value",
        (F.coalesce("price", zero) + F.coalesce("freight_value", zero)).cast("decimal(13,2)").alias("order_amount"),
        is_true(F.col("order_status") == V.DELIVERED).alias("is_delivered"),
        is_true(F.col("order_status") == V.CANCELLED).alias("is_cancelled"),
    )


def fct_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment; payments without an order stay and are flagged."""
    known = orders.select(F.col("order_id").alias("known_order_id"), "customer_id", "order_purchased_at")
    purchased = F.col("order_purchased_at")
    installments = F.col("payment_installments")
    return payments.join(known.hint(GROWS), F.col("order_id") == F.col("known_order_id"), "left").select(
        F.concat("order_id", F.lit("-"), F.col("payment_sequential").cast("string")).alias("payment_key"),
        "order_id",
        "customer_id",
        "payment_type",
        "payment_installments",
        F.to_date(purchased).alias("order_date"),
        month_of(purchased).alias("order_month"),
        "payment_value",
        is_true(installments > 1).alias("is_installment"),
        is_true(installments == 1).alias("is_full_payment"),
        is_true(F.col("payment_type") == V.CREDIT_CARD).alias("is_credit_card"),
        F.col("known_order_id").isNull().alias("is_orphan_payment"),
    )


def fct_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per review and order, with flags instead of deletions."""
    latest_first = [F.col("review_created_at").desc_nulls_last(), F.col("review_id").asc_nulls_last()]
    # Read three times: by both counts of huge groups and by the rows.
    reviews = settle(reviews, "reviews")
    ranked = numbered(reviews, ["review_id"], size="shared_id_count")
    # Grouped by order last: the join with the orders then needs no shuffle of its own.
    ranked = numbered(ranked, ["order_id"], latest_first, row="rn", size="order_review_count", counted=reviews)
    bought = orders.select("order_id", "customer_id", "order_purchased_at")
    purchased = F.col("order_purchased_at")
    return ranked.join(bought.hint(GROWS), "order_id", "left").select(
        "review_key",
        "review_id",
        "order_id",
        "customer_id",
        "review_score",
        "review_created_at",
        "review_answered_at",
        "rn",
        "order_review_count",
        F.to_date(purchased).alias("order_date"),
        month_of(purchased).alias("order_month"),
        is_true(F.trim("review_comment_message") != "").alias("has_comment"),
        F.col("review_answered_at").isNotNull().alias("has_answer"),
        (F.col("order_review_count") > 1).alias("is_duplicate_review"),
        (F.col("shared_id_count") > 1).alias("is_shared_review_id"),
        (F.col("rn") == 1).alias("is_latest_review"),
    )


def latest_reviews(fct: DataFrame) -> DataFrame:
    return fct.filter("is_latest_review")
