"""Data-quality rules: a rule describes offending rows, no row is a pass."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendora.functions import fixed_values as V
from vendora.functions.unions import union_all

ERROR = "error"
WARN = "warn"
INFO = "info"


@dataclass(frozen=True)
class Rule:
    """One declared rule.  ``kind`` is one of unique, not_null, accepted_values,
    relationships, value_range, not_empty_string or the name of a business rule."""

    table: str
    column: str
    kind: str
    severity: str = ERROR
    values: tuple = ()
    parent: str = ""
    parent_key: str = ""
    low: object = None
    high: object = None


# --- Business rules: the offending rows of one table -------------------------


def gmv_inconsistent(monthly: DataFrame) -> DataFrame:
    return monthly.filter(_BUSINESS["gmv_consistency"]).select(
        "order_month",
        "gmv_all",
        "gmv_delivered",
        "gmv_cancelled",
        (F.col("gmv_all") - F.col("gmv_delivered")).cast("decimal(38,2)").alias("diff"),
    )


def gmv_negative(monthly: DataFrame) -> DataFrame:
    return monthly.filter(_BUSINESS["positive_gmv"]).select("order_month", "gmv_delivered")


def rfm_incomplete(rfm: DataFrame) -> DataFrame:
    return rfm.filter(_BUSINESS["rfm_completeness"]).select("customer_id", "rfm_segment")


_BUSINESS = {
    "gmv_consistency": "gmv_delivered > gmv_all",
    "positive_gmv": "gmv_delivered < 0",
    "rfm_completeness": "rfm_segment IS NULL OR rfm_segment = ''",
}


# --- Offending rows ----------------------------------------------------------


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Distinct values outside the list, with their number of rows; NULL passes."""
    return (
        df.filter(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys no parent has, with their number of rows; NULL passes."""
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("from_field"))
        .agg(F.count("*").alias("n_records"))
    )
    return keys.join(parent.select(F.col(parent_key).alias("from_field")).distinct(), "from_field", "left_anti")


def out_of_range(df: DataFrame, column: str, low: object = None, high: object = None) -> DataFrame:
    return df.filter(_out_of_range(column, low, high))


def empty_strings(df: DataFrame, column: str) -> DataFrame:
    return df.filter(_empty_string(column))


def _out_of_range(column: str, low: object, high: object) -> Column:
    """Bounds are optional and inclusive; NULL passes."""
    below = F.lit(False) if low is None else F.coalesce(F.col(column) < F.lit(low), F.lit(False))
    above = F.lit(False) if high is None else F.coalesce(F.col(column) > F.lit(high), F.lit(False))
    return below | above


def _empty_string(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(column) == "")


DRIFT = "array<struct<column_name:string,drift:string>>"


def contract_drift(df: DataFrame, table: str, declared: Iterable[str]) -> DataFrame:
    """Declared columns the table lacks and columns nobody declared, with the
    number of rows that this concerns."""
    declared = list(declared)
    found = [(c, "missing") for c in declared if c not in df.columns]
    found += [(c, "undeclared") for c in df.columns if c not in declared]
    rows = F.array(*[F.struct(F.lit(c), F.lit(drift)) for c, drift in found]).cast(DRIFT)
    return (
        df.agg(F.count("*").alias("rows_concerned"))
        .select(F.lit(table).alias("table_name"), F.explode(rows).alias("d"), "rows_concerned")
        .select("table_name", "d.*", "rows_concerned")
    )


# --- The suite ---------------------------------------------------------------


def suite_report(tables: dict[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """One row per rule with its number of failures.

    Every table is read once.  A row gives an entry for each rule of single rows that it breaks,
    for each value outside a list, and for each key column that a rule is about; the keys
    of a child and of its parent are entries of one domain.  One grouping of all entries by
    (domain, key), which combines before it shuffles, then serves unique and foreign-key rules alike."""
    rules = list(rules)
    domains: dict[tuple, int] = {}
    children: dict[int, int] = {}
    entries: dict[str, list[Column]] = {}
    listed = []

    def entry(table: str, domain: int, key: Column, slot: int, when: Column) -> None:
        made = F.struct(F.lit(domain).alias("domain"), key.cast("string").alias("key"), F.lit(slot).alias("slot"))
        entries.setdefault(table, []).append(F.when(when, made))

    def keys(table: str, column: str) -> int:
        """The domain of a column's own keys, which are entries once, whatever the number of rules."""
        known = (table, column) in domains
        domain = domains.setdefault((table, column), len(domains))
        if not known:
            entry(table, domain, F.col(column), OWN, F.col(column).isNotNull())
        return domain

    for r in rules:
        column, slot = F.col(r.column), OWN
        if r.kind == "unique":
            domain = keys(r.table, r.column)
        elif r.kind == "relationships":
            domain = keys(r.parent, r.parent_key)
            slot = children.get(domain, 0)
            children[domain] = slot + 1
            entry(r.table, domain, column, slot, column.isNotNull())
        else:
            domain = domains.setdefault((len(listed),), len(domains))
            listed_values = r.kind == "accepted_values"
            offends = ~column.isin(list(r.values)) if listed_values else _offends(r)
            if r.kind == "not_null" and not tables[r.table].schema[r.column].nullable:
                # What makes such a column, as a numbering of all lines, need not run for the rule.
                offends = F.lit(False)
            entry(r.table, domain, column if listed_values else F.lit(""), OWN, offends)
        measure = {"unique": "twice", "relationships": f"orphans_{slot}", "accepted_values": "keys"}.get(r.kind, "rows")
        listed.append((len(listed), domain, measure, r.table, r.column, r.kind, r.severity))

    spark = next(iter(tables.values())).sparkSession
    named = spark.createDataFrame(
        listed,
        "rule_no int, domain int, measure string, table_name string, column_name string, rule string, severity string",
    )
    slots = range(max(children.values(), default=0))
    all_entries = union_all([_entries(tables[table], made) for table, made in entries.items()])
    by_key = all_entries.groupBy("domain", "key").agg(
        F.count_if(F.col("slot") == OWN).alias("own"), *[F.count_if(F.col("slot") == i).alias(f"n_{i}") for i in slots]
    )
    measures = {
        "twice": F.count_if(F.col("own") > 1),
        "keys": F.count("*"),
        "rows": F.sum("own"),
        **{f"orphans_{i}": F.sum(F.when(F.col("own") == 0, F.col(f"n_{i}"))) for i in slots},
    }
    by_domain = by_key.groupBy("domain").agg(*[m.alias(name) for name, m in measures.items()])
    found = F.coalesce(*[F.when(F.col("measure") == name, F.col(name)) for name in measures], F.lit(0))
    lenient = F.col("severity").isin(WARN, INFO)
    # One row for each domain, so no more than there are rules and their parents.
    return named.join(F.broadcast(by_domain), "domain", "left").select(
        "table_name",
        "column_name",
        "rule",
        "severity",
        found.cast("long").alias("failures"),
        F.when(found == 0, "pass").when(lenient, F.col("severity")).otherwise("fail").alias("status"),
    )


OWN = -1


def _entries(df: DataFrame, made: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*made)).alias("e")).filter("e IS NOT NULL").select("e.*")


def _offends(rule: Rule) -> Column:
    if rule.kind == "not_null":
        return F.col(rule.column).isNull()
    if rule.kind == "value_range":
        return _out_of_range(rule.column, rule.low, rule.high)
    if rule.kind == "not_empty_string":
        return _empty_string(rule.column)
    return F.expr(_BUSINESS[rule.kind])


def may_publish(report: DataFrame) -> bool:
    """False if a rule of severity error failed; warnings and notes do not block."""
    return report.filter(F.col("status") == "fail").limit(1).count() == 0


# --- Fixed values: the declared rules ----------------------------------------


def _rules(table: str, *specs: tuple) -> list[Rule]:
    return [Rule(table, column, kind, **extra) for column, kind, extra in specs]


def _unique(column: str) -> tuple:
    return column, "unique", {}


def _not_null(column: str) -> tuple:
    return column, "not_null", {}


def _accepted(column: str, values: Iterable) -> tuple:
    return column, "accepted_values", {"values": tuple(values)}


def _refers(column: str, parent: str, parent_key: str) -> tuple:
    return column, "relationships", {"parent": parent, "parent_key": parent_key}


def _between(column: str, low: object, high: object) -> tuple:
    return column, "value_range", {"low": low, "high": high}


def _as(severity: str, spec: tuple) -> tuple:
    column, kind, extra = spec
    return column, kind, {**extra, "severity": severity}


RULES: list[Rule] = [
    *_rules("stg_customers", _unique("customer_id"), _not_null("customer_id")),
    *_rules(
        "stg_orders",
        _unique("order_id"),
        _not_null("order_id"),
        _not_null("customer_id"),
        _refers("customer_id", "stg_customers", "customer_id"),
        _not_null("order_status"),
        _accepted("order_status", V.ORDER_STATUSES),
        _as(WARN, _refers("order_id", "stg_order_items", "order_id")),
    ),
    *_rules(
        "stg_order_items",
        _not_null("order_id"),
        _refers("order_id", "stg_orders", "order_id"),
        _not_null("order_item_id"),
        _not_null("product_id"),
        _refers("product_id", "stg_products", "product_id"),
    ),
    *_rules("stg_products", _unique("product_id"), _not_null("product_id"), _as(INFO, _not_null("product_category"))),
    *_rules("stg_order_payments", _not_null("payment_type")),
    *_rules(
        "stg_order_reviews",
        _unique("review_key"),
        _not_null("review_key"),
        _not_null("review_id"),
        _not_null("review_score"),
        _accepted("review_score", V.SCORES),
    ),
    *_rules("stg_sellers", _unique("seller_id"), _not_null("seller_id")),
    *_rules(
        "stg_category_translation",
        _unique("category_name_pt"),
        _not_null("category_name_pt"),
        _not_null("category_name_en"),
    ),
    *_rules(
        "fct_orders",
        _unique("order_item_key"),
        _not_null("order_item_key"),
        _not_null("order_id"),
        _refers("customer_id", "dim_customers", "customer_id"),
        _refers("product_id", "dim_products", "product_id"),
        _not_null("order_amount"),
        _between("order_amount", *V.ORDER_AMOUNT_RANGE),
        _not_null("is_delivered"),
        _accepted("is_delivered", [True, False]),
    ),
    *_rules(
        "dim_customers",
        _unique("customer_id"),
        _not_null("customer_id"),
        _accepted("region", [*V.CUSTOMER_REGIONS, V.CUSTOMER_REGION_OTHER]),
    ),
    *_rules("dim_products", _unique("product_id"), _not_null("product_id")),
    *_rules(
        "dim_sellers",
        _unique("seller_id"),
        _not_null("seller_id"),
        _accepted("region", [*V.SELLER_REGIONS, V.SELLER_REGION_OTHER]),
    ),
    *_rules("dim_geography", _unique("zip_code_prefix"), _not_null("zip_code_prefix")),
    *_rules(
        "fct_payments",
        _unique("payment_key"),
        _not_null("payment_key"),
        _not_null("payment_type"),
        _not_null("payment_value"),
        _accepted("is_orphan_payment", [True, False]),
    ),
    *_rules(
        "fct_reviews",
        _unique("review_key"),
        _not_null("review_key"),
        _not_null("review_id"),
        _accepted("review_score", V.SCORES),
        _not_null("is_latest_review"),
        _accepted("is_latest_review", [True, False]),
    ),
    *_rules(
        "dws_customer_rfm",
        _unique("customer_id"),
        _not_null("customer_id"),
        _accepted("r_score", range(1, V.TILES + 1)),
        _between("rfm_total", 3, 12),
        ("rfm_segment", "rfm_completeness", {}),
    ),
    *_rules(
        "ads_gmv_monthly",
        _not_null("order_month"),
        _between("cancel_rate_pct", 0, 100),
        ("gmv_delivered", "gmv_consistency", {}),
        ("gmv_delivered", "positive_gmv", {}),
    ),
    *_rules(
        "dws_seller_performance",
        _unique("seller_id"),
        _not_null("seller_id"),
        _accepted("seller_tier", [*[t for _, t in V.SELLER_TIERS], V.SELLER_TIER_ACTIVE, V.SELLER_TIER_IDLE]),
    ),
    *_rules("ads_payment_analysis", _unique("payment_type"), _not_null("payment_type"), _not_null("total_amount")),
    *_rules(
        "ads_review_analysis",
        _unique("order_month"),
        _not_null("order_month"),
        _accepted("health_level", [*[h for _, h in V.HEALTH_LEVELS], V.HEALTH_LOWEST, V.HEALTH_UNKNOWN]),
    ),
    *_rules(
        "ads_kpi_summary",
        _unique("metric_id"),
        _not_null("metric_id"),
        _not_null("metric_name_cn"),
        _not_null("metric_name_en"),
        _not_null("metric_domain"),
        _accepted("metric_domain", V.KPI_DOMAINS),
        _not_null("metric_value"),
        _not_null("metric_definition"),
    ),
]
