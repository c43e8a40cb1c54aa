"""Marts on facts and dimensions.

Joins to dimensions carry no broadcast hint: Spark broadcasts a dimension when
its measured size allows and otherwise shuffles, splitting skewed keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendora.functions import fixed_values as V
from vendora.functions.grouping import numbered
from vendora.functions.metrics import amount_where, count_where, first_level, gmv, gmv_all, rfm_segment
from vendora.functions.rounding import cents, half_up, money_mean, percent
from vendora.functions.tiles import with_ntiles
from vendora.session import settle

TOTAL = "decimal(38,2)"


def ads_gmv_monthly(fct_orders: DataFrame) -> DataFrame:
    """Monthly revenue.

    Each line stands for its order and for its buyer, and one grouping by (month, who) settles
    all distinct counts.  An order's lines lie together, in the fact's own join as in its stored files, so tasks
    fold them to orders before the one shuffle of two narrow rows per order; four distinct counts over the lines
    would make Spark copy every line five times."""
    flags, sums = ["is_delivered", "is_cancelled"], ["amount", "delivered", "cancelled"]
    kind = fct_orders.schema["order_amount"].dataType
    amount, zero = F.col("order_amount"), F.lit(0)
    order = F.struct(
        F.lit(True).alias("is_order"),
        F.col("order_id").alias("id"),
        *flags,
        amount.alias("amount"),
        F.when(F.col("is_delivered"), amount).otherwise(zero).cast(kind).alias("delivered"),
        F.when(F.col("is_cancelled"), amount).otherwise(zero).cast(kind).alias("cancelled"),
    )
    buyer = F.struct(
        F.lit(False).alias("is_order"),
        F.col("customer_id").alias("id"),
        *[F.lit(False).alias(flag) for flag in flags],
        *[F.lit(None).cast(kind).alias(name) for name in sums],
    )
    by_id = (
        fct_orders.select("order_month", F.explode(F.array(order, buyer)).alias("who"))
        .select("order_month", "who.*")
        .groupBy("order_month", "is_order", "id")
        .agg(*[F.max(flag).alias(flag) for flag in flags], *[F.sum(amount).alias(amount) for amount in sums])
    )
    is_order = F.col("is_order")
    monthly = by_id.groupBy("order_month").agg(
        F.count(F.when(is_order, F.col("id"))).alias("total_orders"),
        F.count(F.when(is_order & F.col("is_delivered"), F.col("id"))).alias("delivered_orders"),
        F.count(F.when(is_order & F.col("is_cancelled"), F.col("id"))).alias("cancelled_orders"),
        F.count(F.when(~is_order, F.col("id"))).alias("total_buyers"),
        F.sum("amount").cast(TOTAL).alias("gmv_all"),
        F.sum("delivered").cast(TOTAL).alias("gmv_delivered"),
        F.sum("cancelled").cast(TOTAL).alias("gmv_cancelled"),
    )
    delivered_orders = F.nullif("delivered_orders", F.lit(0))
    return monthly.select(
        "*",
        (F.col("gmv_delivered").cast("double") / delivered_orders).alias("avg_order_value"),
        percent(F.col("cancelled_orders"), F.col("total_orders")).alias("cancel_rate_pct"),
    ).orderBy(F.asc_nulls_last("order_month"))


def _delivered_by_order(fct_orders: DataFrame) -> DataFrame:
    """Delivered lines folded to orders before a dimension is joined; after the fact's own join this takes no shuffle."""
    return (
        fct_orders.filter("is_delivered")
        .groupBy("order_id", "customer_id")
        .agg(F.sum("order_amount").cast(TOTAL).alias("amount"), F.count("*").alias("lines"))
    )


def _delivered_sales(joined: DataFrame, by: list[str]) -> DataFrame:
    """Orders, buyers, revenue and mean line amount of delivered lines."""
    return (
        joined.groupBy(*by)
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("customer_id").alias("buyers"),
            F.sum("amount").cast(TOTAL).alias("gmv"),
            F.sum("lines").alias("lines"),
        )
        .withColumn("avg_order_value", money_mean(F.col("gmv"), F.col("lines")))
        .drop("lines")
    )


def ads_category_sales(fct_orders: DataFrame, dim_products: DataFrame) -> DataFrame:
    by = ["product_category", "product_category_cn", "weight_tier"]
    # Lines are not folded first: few of an order are of one product.
    sold = fct_orders.filter("is_delivered").select(
        "order_id", "customer_id", "product_id", F.col("order_amount").alias("amount"), F.lit(1).cast("long").alias("lines")
    )
    sales = _delivered_sales(sold.join(dim_products.select("product_id", *by), "product_id", "left"), by)
    # The window sees one row per category and tier, never the lines.
    total = F.sum("gmv").over(W.partitionBy())
    return sales.withColumn("gmv_share_pct", percent(cents(F.col("gmv")), cents(total))).orderBy(F.desc("gmv"))


def ads_region_overview(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    by = ["region", "customer_state", "is_core_market"]
    sold = _delivered_by_order(fct_orders)
    sales = _delivered_sales(sold.join(dim_customers.select("customer_id", *by), "customer_id", "left"), by)
    return sales.orderBy(F.desc("gmv"))


def ads_payment_analysis(fct_payments: DataFrame) -> DataFrame:
    summary = (
        fct_payments.filter(~F.col("is_orphan_payment"))
        .groupBy("payment_type")
        .agg(
            F.count("*").alias("payment_count"),
            F.count_distinct("order_id").alias("order_count"),
            F.sum("payment_value").cast(TOTAL).alias("total_amount"),
            F.count("payment_value").alias("valued"),
            F.sum("payment_installments").alias("installments"),
            F.count("payment_installments").alias("with_installments"),
            count_where(F.col("is_installment")).alias("installment_payments"),
        )
    )
    # One row per payment type from here on.
    everything = W.partitionBy()
    amount, count = F.col("total_amount"), F.col("payment_count")
    return summary.select(
        "payment_type",
        "payment_count",
        "order_count",
        "total_amount",
        money_mean(amount, F.col("valued")).alias("avg_amount"),
        half_up(F.col("installments"), F.col("with_installments"), 2).alias("avg_installments"),
        percent(F.col("installment_payments"), count).alias("installment_rate_pct"),
        percent(cents(amount), cents(F.sum(amount).over(everything))).alias("amount_share_pct"),
        percent(count, F.sum(count).over(everything)).alias("count_share_pct"),
    ).orderBy(F.desc("total_amount"))


def ads_review_analysis(fct_reviews: DataFrame) -> DataFrame:
    score = F.col("review_score")
    monthly = (
        fct_reviews.filter(F.col("is_latest_review") & F.col("order_month").isNotNull())
        .groupBy("order_month")
        .agg(
            F.count("*").alias("review_count"),
            F.count_distinct("order_id").alias("reviewed_order_count"),
            half_up(F.sum(score), F.count(score), 3).alias("avg_review_score"),
            count_where(score <= V.BAD_UP_TO).alias("bad"),
            count_where(score == V.NEUTRAL).alias("neutral"),
            count_where(score >= V.GOOD_FROM).alias("good"),
            count_where(F.col("has_comment")).alias("commented"),
        )
    )
    # One row per month from here on.
    unscored = F.max("avg_review_score").over(W.partitionBy()).isNull()
    reviews = F.col("review_count")
    level = first_level(F.col("avg_review_score"), V.HEALTH_LEVELS, V.HEALTH_LOWEST)
    return monthly.select(
        "order_month",
        "review_count",
        "reviewed_order_count",
        "avg_review_score",
        percent(F.col("bad"), reviews).alias("bad_rate_pct"),
        percent(F.col("neutral"), reviews).alias("neutral_rate_pct"),
        percent(F.col("good"), reviews).alias("good_rate_pct"),
        percent(F.col("commented"), reviews).alias("comment_rate_pct"),
        percent(F.col("good") - F.col("bad"), reviews).alias("nps_simplified"),
        F.when(unscored, V.HEALTH_UNKNOWN).otherwise(level).alias("health_level"),
    ).orderBy("order_month")


def customer_value(fct_orders: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value of each customer with a delivery.

    Folded to (order, customer) first, orders are simply counted."""
    per_order = (
        fct_orders.filter("is_delivered")
        .groupBy("order_id", "customer_id")
        .agg(F.max("order_date").alias("ordered_on"), F.sum("order_amount").alias("amount"))
    )
    return per_order.groupBy("customer_id").agg(
        F.max("ordered_on").alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        F.sum("amount").cast(TOTAL).alias("monetary"),
    )


def dws_customer_rfm(
    fct_orders: DataFrame, segment: Callable[[Column, Column, Column], Column] = rfm_segment
) -> DataFrame:
    scored = with_ntiles(
        settle(customer_value(fct_orders), "customer_value"),
        "customer_id",
        {"r_score": "last_order_date", "f_score": "frequency", "m_score": "monetary"},
        V.TILES,
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumn("rfm_total", r + f + m).withColumn("rfm_segment", segment(r, f, m))


def order_sellers(fct_orders: DataFrame) -> DataFrame:
    """What each seller sold in each order."""
    return fct_orders.groupBy("order_id", "seller_id").agg(
        F.count("*").alias("lines"),
        gmv("order_amount").cast(TOTAL).alias("delivered"),
        gmv_all("order_amount").cast(TOTAL).alias("amount"),
        count_where(F.col("is_delivered")).alias("delivered_lines"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )


def seller_sales(fct_orders: DataFrame) -> DataFrame:
    """Sales of each seller.  Folded to (order, seller) first, orders are simply counted;
    only the products need a distinct count, on two columns."""
    sales = order_sellers(fct_orders).groupBy("seller_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("lines").alias("item_count"),
        F.sum("delivered").cast(TOTAL).alias("gmv_delivered"),
        F.sum("amount").cast(TOTAL).alias("gmv_all"),
        money_mean(F.sum("delivered").cast(TOTAL), F.sum("delivered_lines")).alias("avg_order_value"),
        F.min("first_date").alias("first_sale_date"),
        F.max("last_date").alias("last_sale_date"),
    )
    products = (
        fct_orders.select("seller_id", "product_id").distinct()
        .groupBy("seller_id")
        .agg(F.count("product_id").alias("product_count"))
    )
    return sales.join(products, "seller_id", "left")


# What needs the lines of an order together: flagged first lines, and the reviews of the order for each line.
ORDER_SUMS = ["orders", "reviews", "score_sum", "scored", "good", "bad"]


def _with_order_sums(lines: DataFrame, fct_reviews: DataFrame) -> DataFrame:
    """Reviews are folded to orders, so their join with the lines multiplies nothing; one line of each (order, seller) is
    flagged, so orders are counted by a sum.  The join comes first: lines that were not together by order are then, and
    the numbering shuffles nothing, whether the reviews are small or not."""
    pair = ["order_id", "seller_id"]
    score = F.col("review_score")
    reviews = (
        fct_reviews.filter("is_latest_review")
        .groupBy("order_id")
        .agg(
            F.count("review_id").alias("reviews"),
            F.sum(score).alias("score_sum"),
            F.count(score).alias("scored"),
            count_where(score >= V.GOOD_FROM).alias("good"),
            count_where(score <= V.BAD_UP_TO).alias("bad"),
        )
    )
    joined = lines.join(reviews.hint("merge"), "order_id", "left")
    numbered_lines = numbered(joined, pair, [F.col("product_id")], row="nth_line", counted=lines.select(*pair))
    is_order = (F.col("nth_line") == 1) & F.col("order_id").isNotNull()
    return numbered_lines.withColumn("orders", is_order.cast("long"))


def seller_totals(fct_orders: DataFrame, fct_reviews: DataFrame, stored: bool = False) -> DataFrame:
    """Sales, products and latest reviews of each seller, from one reading of the fact's measures.

    A line stands for its seller, with all sums, and for its (seller, product), with none, so what is shuffled is two
    ids of each product and one wide row of each seller a task.  The last two folds count products and sellers; all
    before are grouped by order, as the facts leave their joins, and are sorted and not hashed: a task holds one table
    of groups and not one for each fold.

    A ``stored`` fact is not grouped by order and cheap to read: it is read twice, so that three ids of a line are
    brought together by order and its measures are not."""
    amount = F.col("order_amount")
    wide = fct_orders if stored else _with_order_sums(fct_orders, fct_reviews)
    order_sums = [] if stored else ORDER_SUMS
    sums = {
        "delivered": F.when(F.col("is_delivered"), amount).otherwise(F.lit(0)),
        "amount": amount,
        "lines": F.lit(1).cast("long"),
        "delivered_lines": F.when(F.col("is_delivered"), F.lit(1)).otherwise(F.lit(0)).cast("long"),
        **{c: F.col(c) for c in order_sums},
    }
    lines = wide.select("seller_id", "product_id", "order_date", *[value.alias(c) for c, value in sums.items()])
    kinds = {f.name: f.dataType for f in lines.schema.fields}
    measures = ["order_date", *sums]
    seller = F.struct(
        F.lit(False).alias("is_product"), F.lit(None).cast(kinds["product_id"]).alias("product_id"), *measures
    )
    product = F.struct(
        F.lit(True).alias("is_product"), "product_id", *[F.lit(None).cast(kinds[c]).alias(c) for c in measures]
    )
    per_product = (
        lines.select("seller_id", F.explode(F.array(seller, product)).alias("of"))
        .select("seller_id", "of.*")
        .groupBy("seller_id", "is_product", "product_id")
        .agg(
            *[F.sum(c).cast(TOTAL).alias(c) for c in ("delivered", "amount")],
            *[F.sum(c).alias(c) for c in sums if c not in ("delivered", "amount")],
            F.min("order_date").alias("first_date"),
            F.max("order_date").alias("last_date"),
        )
    )
    delivered = F.sum("delivered").cast(TOTAL)
    totals = per_product.groupBy("seller_id").agg(
        F.sum("lines").alias("item_count"),
        F.count("product_id").alias("product_count"),
        delivered.alias("gmv_delivered"),
        F.sum("amount").cast(TOTAL).alias("gmv_all"),
        money_mean(delivered, F.sum("delivered_lines")).alias("avg_order_value"),
        F.min("first_date").alias("first_sale_date"),
        F.max("last_date").alias("last_sale_date"),
        *[F.sum(c).alias(c) for c in order_sums],
    )
    if stored:
        ids = fct_orders.select("order_id", "seller_id", "product_id")
        of_orders = _with_order_sums(ids, fct_reviews).groupBy(F.col("seller_id").alias("_seller"))
        totals = totals.join(
            of_orders.agg(*[F.sum(c).alias(c) for c in ORDER_SUMS]), F.col("seller_id").eqNullSafe(F.col("_seller")), "left"
        )
    return totals.select(
        "seller_id",
        F.col("orders").alias("order_count"),
        "item_count",
        "product_count",
        "gmv_delivered",
        "gmv_all",
        "avg_order_value",
        "first_sale_date",
        "last_sale_date",
        F.col("reviews").alias("review_count"),
        half_up(F.col("score_sum"), F.col("scored"), 3).alias("avg_review_score"),
        percent(F.col("good"), F.col("reviews")).alias("good_review_rate_pct"),
        percent(F.col("bad"), F.col("reviews")).alias("bad_review_rate_pct"),
    )


def dws_seller_performance(
    dim_sellers: DataFrame, fct_orders: DataFrame, fct_reviews: DataFrame, stored: bool = False
) -> DataFrame:
    """Every seller, with sales and reviews at seller grain; ``stored`` as in :func:`seller_totals`."""
    joined = dim_sellers.join(seller_totals(fct_orders, fct_reviews, stored), "seller_id", "left")
    zero_money = F.lit(0).cast(TOTAL)
    delivered = F.coalesce("gmv_delivered", zero_money)
    idle_or_active = F.when(delivered > 0, V.SELLER_TIER_ACTIVE).otherwise(V.SELLER_TIER_IDLE)
    at_risk = (delivered > 0) & F.coalesce(F.col("avg_review_score") < V.RISK_SCORE_BELOW, F.lit(False))
    return joined.select(
        "seller_id",
        "seller_city",
        "seller_state",
        "region",
        "is_core_market",
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        F.coalesce("product_count", F.lit(0)).alias("product_count"),
        delivered.alias("gmv_delivered"),
        F.coalesce("gmv_all", zero_money).alias("gmv_all"),
        F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        "first_sale_date",
        "last_sale_date",
        F.coalesce("review_count", F.lit(0)).alias("review_count"),
        "avg_review_score",
        "good_review_rate_pct",
        "bad_review_rate_pct",
        first_level(delivered, V.SELLER_TIERS, idle_or_active).alias("seller_tier"),
        at_risk.alias("is_risk_seller"),
    )
