"""First-look counts on raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendora.functions.metrics import count_where
from vendora.functions.unions import union_all


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    rows = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return union_all(rows)


def missing_category(products: DataFrame) -> DataFrame:
    return products.filter(F.col("product_category_name").isNull()).agg(F.count("*").alias("missing_category"))


def status_distribution(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"))


def unmatched_rows(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Child rows whose key no parent row has; a NULL key matches none.

    The child is folded to one row per key before the join."""
    keys = child.groupBy(key).agg(F.count("*").alias("rows"))
    unmatched = keys.join(parent.select(key).distinct(), key, "left_anti")
    return unmatched.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(name))


def time_inversion(orders: DataFrame) -> DataFrame:
    """Delivered before purchased; text that is no timestamp counts as unknown."""
    delivered = F.col("order_delivered_customer_date").try_cast("timestamp_ntz")
    purchased = F.col("order_purchase_timestamp").try_cast("timestamp_ntz")
    return orders.filter(delivered < purchased).agg(F.count("*").alias("inverted_rows"))


def price_anomaly(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count("*").alias("total_rows"),
        count_where(F.col("price").isNull()).alias("null_price"),
        count_where(F.col("price") <= 0).alias("non_positive_price"),
    )


def blank_location(customers: DataFrame) -> DataFrame:
    city, state = F.col("customer_city"), F.col("customer_state")
    return customers.agg(
        count_where(city.isNull() | (city == "")).alias("blank_city"),
        count_where(state.isNull() | (state == "")).alias("blank_state"),
    )


def time_span(orders: DataFrame) -> DataFrame:
    day = F.col("order_purchase_timestamp").try_cast("date")
    return orders.agg(F.min(day).alias("first_order_date"), F.max(day).alias("last_order_date"))
