"""The nine raw inputs, projected from the driver's parquet tables.

Each function returns one raw table under its contract column names.  Only
whole-number arithmetic is used, so every engine gets the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendora.functions.grouping import numbered
from vendora.functions.metrics import label_of

# --- Fixed values: how driver codes map to marketplace codes -----------------
STATES = [
    "SP", "RJ", "MG", "ES", "PR", "SC", "RS", "BA", "PE", "CE", "RN", "DF", "GO",
    "MT", "MS", "AM", "PA", "MA", "PB", "PI", "SE", "AL", "TO", "RO", "AC",
]
STATUS_BY_FLAG = {"F": "delivered", "P": "canceled"}
STATUS_BY_PRIORITY = {"1": "shipped", "2": "invoiced", "3": "processing", "4": "created", "5": "approved"}
CATEGORY_BY_TYPE = {
    "ECONOMY": "electronics",
    "LARGE": "furniture_decor",
    "MEDIUM": "books",
    "PROMO": "toys",
    "SMALL": "health_beauty",
    "STANDARD": "outros_pt",
}
PAYMENT_BY_EVENT = {
    "purchase": "credit_card",
    "click": "boleto",
    "view": "voucher",
    "signup": "debit_card",
    "error": "not_defined",
}
REVIEW_EVENTS = ["view", "click", "signup"]
TRANSLATIONS = [
    ("electronics", "electronics"),
    ("furniture_decor", "furniture decor"),
    ("books", "books"),
    ("toys", "toys"),
    ("health_beauty", "health beauty"),
    ("outros_pt", "others"),
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _state(index: Column) -> Column:
    return F.array(*[F.lit(s) for s in STATES])[index]


def _hundredths(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("long")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = read(spark, sf_dir, "customer").join(
        read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return people.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(_div(F.col("c_custkey"), 10).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.upper("n_name"), F.lit(" ")).alias("customer_city"),
        F.lower(_state(F.col("c_nationkey"))).alias("customer_state"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_status = label_of(F.substring("o_orderpriority", 1, 1), STATUS_BY_PRIORITY, "unavailable")
    closed_status = F.create_map(*[F.lit(x) for pair in STATUS_BY_FLAG.items() for x in pair])[F.col("o_orderstatus")]
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.coalesce(closed_status, open_status).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def order_items(spark: SparkSession, sf_dir: str, with_line_ids: bool = True) -> DataFrame:
    """Order lines.  Line numbers repeat in the driver table, so unique line
    ids are given out per order; callers that do not show them pass
    ``with_line_ids=False`` and keep the line number as delivered."""
    lines = read(spark, sf_dir, "lineitem")
    order_id = F.col("l_orderkey").cast("string").alias("order_id")
    if with_line_ids:
        order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")]
        # Numbered by the id that orders are joined by, so that join needs no shuffle of its own.
        used = lines.select(order_id, "l_tax", *order)
        lines = numbered(used, ["order_id"], order, row="line_id")
    else:
        lines = lines.withColumns({"order_id": order_id, "line_id": F.col("l_linenumber")})
    price = _div(_hundredths("l_extendedprice"), 500)
    freight = _div(price * _hundredths("l_tax"), 100)
    cent = F.lit("0.01").cast("decimal(2,2)")
    return lines.select(
        "order_id",
        F.col("line_id").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        (price.cast("decimal(15,0)") * cent).alias("price"),
        (freight.cast("decimal(15,0)") * cent).alias("freight_value"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = F.create_map(*[F.lit(x) for pair in CATEGORY_BY_TYPE.items() for x in pair])[F.col("p_type")]
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_size") != 50, category).alias("product_category_name"),
        F.when(F.col("p_partkey") % 97 != 0, F.col("p_size") * 100).alias("product_weight_g"),
        (F.col("p_size") + 10).alias("product_length_cm"),
        (F.col("p_size") + 5).alias("product_height_cm"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = read(spark, sf_dir, "supplier").join(
        read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return shops.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        _state(F.col("s_nationkey")).alias("seller_state"),
    )


def _event_number() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _event_order() -> Column:
    return (_div(F.col("event_id"), 2) * 4).cast("string")


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.create_map(*[F.lit(x) for pair in PAYMENT_BY_EVENT.items() for x in pair])[F.col("event_type")]
    return read(spark, sf_dir, "events").select(
        _event_order().alias("order_id"),
        (F.col("event_id") % 2 + 1).cast("int").alias("payment_sequential"),
        kind.alias("payment_type"),
        (_event_number() % 12 + 1).alias("payment_installments"),
        F.col("value").cast("decimal(12,2)").alias("payment_value"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _event_number()
    shared = F.when(F.col("event_id") % 50 == 0, F.col("event_id") + 2).otherwise(F.col("event_id"))
    return (
        read(spark, sf_dir, "events")
        .filter(F.col("event_type").isin(REVIEW_EVENTS))
        .select(
            shared.cast("string").alias("review_id"),
            _event_order().alias("order_id"),
            (k % 5 + 1).alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.when(k % 3 == 1, "  ").when(k % 3 == 2, F.col("event_type")).alias("review_comment_message"),
            F.col("ts").alias("review_creation_date"),
            F.when(k % 7 != 0, F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("review_answer_timestamp"),
        )
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.lpad(F.col("user_id").cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
        (_event_number() * 0.25 - 33).alias("geolocation_lat"),
        ((F.col("event_id") % 100) * 0.25 - 73).alias("geolocation_lng"),
        F.concat(F.lit(" "), F.upper("event_type")).alias("geolocation_city"),
        F.lower(_state((F.col("user_id") % 25).cast("int"))).alias("geolocation_state"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories that products carry, with their English names."""
    english = F.create_map(*[F.lit(x) for pair in TRANSLATIONS for x in pair])
    carried = products(spark, sf_dir).filter("product_category_name IS NOT NULL").select("product_category_name").distinct()
    return carried.withColumn("product_category_name_english", english[F.col("product_category_name")])


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: when it was ordered and when it left, as text."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    bought = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("string").alias("order_purchase_timestamp"),
        F.col("l_shipdate").cast("string").alias("order_delivered_customer_date"),
    )
