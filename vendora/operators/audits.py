"""Checks that a join or an aggregation kept what it should keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendora.functions.rounding import cents, half_up, percent
from vendora.functions.unions import union_all

TOTAL = "decimal(38,2)"


def join_loss(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows and keys of ``left`` that an inner join on ``key`` would lose.

    Each side is folded to its keys first, so a key repeated many times on
    either side costs one row."""
    keys = left.groupBy(key).agg(F.count("*").alias("rows"))
    known = right.select(F.col(key).alias("known_key")).distinct()
    marked = keys.join(known, F.col(key) == F.col("known_key"), "left")
    lost = F.col("known_key").isNull()
    counted = marked.agg(
        F.sum("rows").alias("rows_total"),
        F.coalesce(F.sum(F.when(lost, F.col("rows"))), F.lit(0)).alias("rows_lost"),
        F.count(key).alias("keys_total"),
        F.count(F.when(lost, F.col(key))).alias("keys_lost"),
    )
    return counted.withColumn("lost_pct", percent(F.col("rows_lost"), F.col("rows_total")))


def fanout_inflation(fct_orders: DataFrame, fct_reviews: DataFrame) -> DataFrame:
    """What joining lines straight to reviews would do to the total.

    The joined size and sum follow from per-order counts; the multiplied rows
    are never produced."""
    lines = fct_orders.groupBy("order_id").agg(
        F.count("*").alias("lines"), F.sum("order_amount").alias("amount")
    )
    reviews = fct_reviews.groupBy("order_id").agg(F.count("*").alias("reviews"))
    copies = F.greatest(F.coalesce("reviews", F.lit(1)), F.lit(1))
    totals = lines.join(reviews, "order_id", "left").agg(
        F.sum("lines").alias("fact_rows"),
        F.sum(F.col("lines") * copies).alias("joined_rows"),
        F.sum("amount").cast(TOTAL).alias("fact_amount"),
        F.sum(F.col("amount") * copies).cast(TOTAL).alias("joined_amount"),
    )
    factor = half_up(cents(F.col("joined_amount")), cents(F.col("fact_amount")), 4)
    return totals.withColumn("inflation_factor", factor)


def total_reconcile(fact: DataFrame, fact_amount: str, marts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Does each mart's total equal the fact's?  One row per mart."""
    fact_total = fact.agg(F.sum(fact_amount).cast(TOTAL).alias("t"))
    rows = [
        mart.agg(F.sum(amount).cast(TOTAL).alias("mart_total")).select(
            F.lit(name).alias("mart"), "mart_total", fact_total.scalar().alias("fact_total")
        )
        for name, (mart, amount) in marts.items()
    ]
    return union_all(rows).withColumn("diff", (F.col("mart_total") - F.col("fact_total")).cast(TOTAL)).withColumn(
        "matches", F.col("diff") == 0
    )


def key_multiplicity(df: DataFrame, key: str) -> DataFrame:
    """How many key values occur once, twice, ... ."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("copies"))
        .groupBy("copies")
        .agg(F.count("*").alias("key_values"), F.sum("copies").alias("rows"))
    )


def order_count_two_ways(fct_orders: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders by the fact (with lines) and by the order table."""
    in_fact = fct_orders.select("order_id").distinct().agg(F.count("*").alias("n"))
    return orders.agg(F.count("*").alias("order_table_orders")).select(
        "order_table_orders",
        in_fact.scalar().alias("fact_orders"),
        (F.col("order_table_orders") - in_fact.scalar()).alias("difference"),
    )


def payment_reconciliation(fct_orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Receivable against received money per order, summed by kind of difference."""
    due = fct_orders.groupBy("order_id").agg(F.sum("order_amount").alias("due"))
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    zero = F.lit(0).cast(TOTAL)
    both = due.join(paid, "order_id", "full").withColumn(
        "bucket",
        F.when(F.col("paid").isNull(), "unpaid")
        .when(F.col("due").isNull(), "paid_without_lines")
        .when(F.col("paid") == F.col("due"), "equal")
        .when(F.col("paid") < F.col("due"), "underpaid")
        .otherwise("overpaid"),
    )
    return both.groupBy("bucket").agg(
        F.count("*").alias("orders"),
        F.coalesce(F.sum("due"), zero).cast(TOTAL).alias("receivable"),
        F.coalesce(F.sum("paid"), zero).cast(TOTAL).alias("received"),
    )
