"""The same results in plain SQL, one statement per query.

Each statement is a select on a few named subqueries; :func:`_statement` puts
those that it uses, directly or not, in a WITH clause in front of it.
"""

from __future__ import annotations

import re

from vendora.functions import fixed_values as V
from vendora.operators.quality import RULES, Rule
from vendora.plans.warehouse import STORED
from vendora.sources.contracts import CONTRACTS
from vendora.sources.driver_tables import (
    CATEGORY_BY_TYPE,
    PAYMENT_BY_EVENT,
    REVIEW_EVENTS,
    STATES,
    STATUS_BY_PRIORITY,
    TRANSLATIONS,
)

MONEY = "DECIMAL(38,2)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(pairs) -> str:
    return ", ".join("(" + ", ".join(_text(x) for x in pair) + ")" for pair in pairs)


def _list(values) -> str:
    return ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values)


def half_up(a: str, b: str, digits: int) -> str:
    whole = f"(2 * abs(CAST({a} AS HUGEINT)) * {10**digits} + abs({b})) // (2 * abs({b}))"
    return f"CASE WHEN ({b}) <> 0 THEN sign({a}) * CAST({whole} AS DOUBLE) / CAST({10**digits} AS DOUBLE) END"


def percent(a: str, b: str) -> str:
    return half_up(f"(100 * CAST({a} AS HUGEINT))", b, 2)


def mean_money(total: str, n: str) -> str:
    return f"({half_up(_cents(total), n, 0)}) / CAST(100 AS DOUBLE)"


def _cents(total: str) -> str:
    """A two-decimal sum as whole cents, by way of its text form."""
    return f"CAST(replace(CAST(CAST({total} AS {MONEY}) AS VARCHAR), '.', '') AS HUGEINT)"


def _region(regions: dict, other: str, state: str) -> str:
    branches = " ".join(f"WHEN {state} IN ({_list(codes)}) THEN {_text(name)}" for name, codes in regions.items())
    return f"CASE {branches} ELSE {_text(other)} END"


STATE_LIST = "[" + _list(STATES) + "]"
CUSTOMER_REGION = _region(V.CUSTOMER_REGIONS, V.CUSTOMER_REGION_OTHER, "customer_state")
SELLER_REGION = _region(V.SELLER_REGIONS, V.SELLER_REGION_OTHER, "seller_state")
CONFORMED_REGION = _region(V.CUSTOMER_REGIONS, V.CUSTOMER_REGION_OTHER, "seller_state")
CORE = f"IN ({_list(V.CORE_STATES)})"
SEGMENT = f"""CASE
  WHEN least(r_score, f_score, m_score) >= 3 THEN '{V.SEGMENT_HIGH_VALUE}'
  WHEN r_score = 1 AND m_score >= 3 THEN '{V.SEGMENT_WIN_BACK}'
  WHEN r_score >= 3 AND m_score = 1 THEN '{V.SEGMENT_NEW}'
  WHEN r_score = 1 AND f_score = 1 THEN '{V.SEGMENT_LOST}'
  ELSE '{V.SEGMENT_GENERAL}' END"""
SEGMENT_WITH_KEEP = f"""CASE
  WHEN least(r_score, f_score, m_score) >= 3 THEN '{V.SEGMENT_HIGH_VALUE}'
  WHEN least(r_score, m_score) >= 3 THEN '{V.SEGMENT_KEEP}'
  WHEN r_score <= 2 AND m_score >= 3 THEN '{V.SEGMENT_WIN_BACK}'
  WHEN r_score >= 3 AND f_score <= 2 THEN '{V.SEGMENT_NEW}'
  ELSE '{V.SEGMENT_GENERAL}' END"""

# --- Named subqueries --------------------------------------------------------

SUBQUERIES = {
    "stg_customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
               lpad(CAST(c_custkey // 10 AS VARCHAR), 5, '0') AS customer_zip_code,
               lower(n_name) AS customer_city, ({STATE_LIST})[c_nationkey + 1] AS customer_state,
               TIMESTAMP '2026-01-01 00:00:00' AS updated_at
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "priority_status": f"""
        SELECT * FROM (VALUES {_values(STATUS_BY_PRIORITY.items())}) v(digit, status)""",
    "stg_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'canceled' ELSE status END AS order_status,
               o_orderdate AS order_purchased_at
        FROM orders LEFT JOIN priority_status ON digit = o_orderpriority[1]""",
    "line_numbers": """
        SELECT *, row_number() OVER (PARTITION BY l_orderkey
                    ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS line_id,
               CAST(round(l_extendedprice * 100) AS BIGINT) // 500 AS price_cents,
               CAST(round(l_tax * 100) AS BIGINT) AS tax_pct
        FROM lineitem""",
    "stg_order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(line_id AS INTEGER) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               CAST(price_cents * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS price,
               CAST((price_cents * tax_pct // 100) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS freight_value
        FROM line_numbers""",
    "type_category": f"""
        SELECT * FROM (VALUES {_values(CATEGORY_BY_TYPE.items())}) v(kind, category)""",
    "stg_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_size <> 50 THEN category END AS product_category,
               CASE WHEN p_partkey % 97 <> 0 THEN p_size * 100 END AS product_weight_g,
               p_size + 10 AS product_length_cm, p_size + 5 AS product_height_cm
        FROM part LEFT JOIN type_category ON kind = p_type""",
    "stg_sellers": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               lower(n_name) AS seller_city, ({STATE_LIST})[s_nationkey + 1] AS seller_state
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "numbered_events": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST((event_id // 2) * 4 AS VARCHAR) AS for_order
        FROM events""",
    "event_payment": f"""
        SELECT * FROM (VALUES {_values(PAYMENT_BY_EVENT.items())}) v(happened, paid_by)""",
    "stg_order_payments": """
        SELECT for_order AS order_id, CAST(event_id % 2 + 1 AS INTEGER) AS payment_sequential,
               paid_by AS payment_type, k % 12 + 1 AS payment_installments,
               CAST("value" AS DECIMAL(12,2)) AS payment_value
        FROM numbered_events LEFT JOIN event_payment ON happened = event_type""",
    "stg_order_reviews": f"""
        SELECT concat(review_id, '-', order_id) AS review_key, * FROM (
          SELECT CAST(event_id + CASE event_id % 50 WHEN 0 THEN 2 ELSE 0 END AS VARCHAR) AS review_id,
                 for_order AS order_id, k % 5 + 1 AS review_score, CAST(NULL AS VARCHAR) AS review_comment_title,
                 CASE k % 3 WHEN 1 THEN '  ' WHEN 2 THEN event_type END AS review_comment_message,
                 ts AS review_created_at, CASE WHEN k % 7 <> 0 THEN ts + INTERVAL 1 DAY END AS review_answered_at
          FROM numbered_events WHERE event_type IN ({_list(REVIEW_EVENTS)}))""",
    "stg_geolocation": f"""
        SELECT lpad(CAST(user_id AS VARCHAR), 5, '0') AS zip_code_prefix,
               CAST(-33 + k * 0.25 AS DOUBLE) AS latitude,
               CAST(-73 + (event_id % 100) * 0.25 AS DOUBLE) AS longitude,
               event_type AS geo_city, ({STATE_LIST})[user_id % 25 + 1] AS geo_state
        FROM numbered_events""",
    "translations": f"""
        SELECT * FROM (VALUES {_values(TRANSLATIONS)}) v(category_name_pt, category_name_en)
        WHERE category_name_pt IN (SELECT product_category FROM stg_products)""",
    "dim_customers": f"""
        SELECT customer_id, customer_unique_id, customer_city, customer_state, customer_zip_code,
               {CUSTOMER_REGION} AS region, customer_state {CORE} AS is_core_market
        FROM stg_customers""",
    "dim_sellers": f"""
        SELECT *, {SELLER_REGION} AS region, seller_state {CORE} AS is_core_market FROM stg_sellers""",
    "dim_sellers_conformed": f"""
        SELECT *, {CONFORMED_REGION} AS region, seller_state {CORE} AS is_core_market FROM stg_sellers""",
    "category_labels": f"""
        SELECT * FROM (VALUES {_values(V.CATEGORY_LABELS.items())}) v(code, label)""",
    "dim_products": f"""
        SELECT product_id, product_category, coalesce(label, '{V.CATEGORY_OTHER}') AS product_category_cn,
               product_weight_g,
               CASE WHEN product_weight_g IS NULL OR product_weight_g <= 0 THEN 'unknown'
                    WHEN product_weight_g < {V.MEDIUM_FROM_G} THEN 'light'
                    WHEN product_weight_g < {V.HEAVY_FROM_G} THEN 'medium' ELSE 'heavy' END AS weight_tier
        FROM stg_products LEFT JOIN category_labels ON code = product_category""",
    "city_counts": "SELECT zip_code_prefix, geo_city, count(*) AS n FROM stg_geolocation GROUP BY ALL",
    "state_counts": "SELECT zip_code_prefix, geo_state, count(*) AS n FROM stg_geolocation GROUP BY ALL",
    "top_city": """
        SELECT * FROM city_counts
        QUALIFY row_number() OVER (PARTITION BY zip_code_prefix ORDER BY n DESC, geo_city) = 1""",
    "top_state": """
        SELECT * FROM state_counts
        QUALIFY row_number() OVER (PARTITION BY zip_code_prefix ORDER BY n DESC, geo_state) = 1""",
    "zip_measures": """
        SELECT zip_code_prefix, round(avg(latitude), 6) AS latitude_avg, round(avg(longitude), 6) AS longitude_avg,
               count(*) AS measurement_count, round(stddev_samp(latitude), 6) AS latitude_stddev
        FROM stg_geolocation GROUP BY ALL""",
    "dim_geography": """
        SELECT m.zip_code_prefix, latitude_avg, longitude_avg, geo_city, geo_state, measurement_count, latitude_stddev
        FROM zip_measures m JOIN top_city USING (zip_code_prefix) JOIN top_state USING (zip_code_prefix)""",
    "fct_orders": """
        SELECT concat(i.order_id, '-', i.order_item_id) AS order_item_key, i.order_id, o.customer_id, i.product_id,
               i.seller_id, o.order_status, CAST(o.order_purchased_at AS DATE) AS order_date,
               date_trunc('month', o.order_purchased_at) AS order_month, i.price, i.freight_value,
               CAST(ifnull(i.price, 0) + ifnull(i.freight_value, 0) AS DECIMAL(13,2)) AS order_amount,
               o.order_status = 'delivered' AS is_delivered, o.order_status = 'canceled' AS is_cancelled
        FROM stg_orders o, stg_order_items i WHERE i.order_id = o.order_id""",
    "fct_payments": """
        SELECT concat(p.order_id, '-', p.payment_sequential) AS payment_key, p.order_id, o.customer_id,
               p.payment_type, p.payment_installments, CAST(o.order_purchased_at AS DATE) AS order_date,
               date_trunc('month', o.order_purchased_at) AS order_month, p.payment_value,
               ifnull(p.payment_installments > 1, false) AS is_installment,
               ifnull(p.payment_installments = 1, false) AS is_full_payment,
               ifnull(p.payment_type = 'credit_card', false) AS is_credit_card,
               o.order_id IS NULL AS is_orphan_payment
        FROM stg_order_payments p LEFT JOIN stg_orders o USING (order_id)""",
    "ranked_reviews": """
        SELECT *, CAST(row_number() OVER (PARTITION BY order_id
                        ORDER BY review_created_at DESC NULLS LAST, review_id) AS INTEGER) AS rn,
               count(*) OVER (PARTITION BY order_id) AS order_review_count,
               count(*) OVER (PARTITION BY review_id) AS same_id
        FROM stg_order_reviews""",
    "fct_reviews": """
        SELECT review_key, review_id, r.order_id, customer_id, review_score, review_created_at, review_answered_at,
               rn, order_review_count, CAST(order_purchased_at AS DATE) AS order_date,
               date_trunc('month', order_purchased_at) AS order_month,
               ifnull(trim(review_comment_message) <> '', false) AS has_comment,
               review_answered_at IS NOT NULL AS has_answer, order_review_count > 1 AS is_duplicate_review,
               same_id > 1 AS is_shared_review_id, rn = 1 AS is_latest_review
        FROM ranked_reviews r LEFT JOIN stg_orders o USING (order_id)""",
    "ads_gmv_monthly": f"""
        SELECT order_month, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT order_id) FILTER (WHERE is_delivered) AS delivered_orders,
               count(DISTINCT order_id) FILTER (WHERE is_cancelled) AS cancelled_orders,
               count(DISTINCT customer_id) AS total_buyers,
               CAST(sum(order_amount) AS {MONEY}) AS gmv_all,
               CAST(ifnull(sum(order_amount) FILTER (WHERE is_delivered), 0) AS {MONEY}) AS gmv_delivered,
               CAST(ifnull(sum(order_amount) FILTER (WHERE is_cancelled), 0) AS {MONEY}) AS gmv_cancelled,
               CAST(sum(order_amount) FILTER (WHERE is_delivered) AS DOUBLE)
                 / count(DISTINCT order_id) FILTER (WHERE is_delivered) AS avg_order_value,
               {percent("count(DISTINCT order_id) FILTER (WHERE is_cancelled)", "count(DISTINCT order_id)")}
                 AS cancel_rate_pct
        FROM fct_orders GROUP BY order_month""",
    "ads_category_sales": f"""
        SELECT *, {percent(_cents("gmv"), _cents("sum(gmv) OVER ()"))} AS gmv_share_pct FROM (
          SELECT product_category, product_category_cn, weight_tier, count(DISTINCT order_id) AS orders,
                 count(DISTINCT customer_id) AS buyers, CAST(sum(order_amount) AS {MONEY}) AS gmv,
                 {mean_money("sum(order_amount)", "count(*)")} AS avg_order_value
          FROM fct_orders LEFT JOIN dim_products USING (product_id) WHERE is_delivered
          GROUP BY product_category, product_category_cn, weight_tier)""",
    "ads_region_overview": f"""
        SELECT region, customer_state, is_core_market, count(DISTINCT order_id) AS orders,
               count(DISTINCT customer_id) AS buyers, CAST(sum(order_amount) AS {MONEY}) AS gmv,
               {mean_money("sum(order_amount)", "count(*)")} AS avg_order_value
        FROM fct_orders LEFT JOIN dim_customers USING (customer_id) WHERE is_delivered
        GROUP BY region, customer_state, is_core_market""",
    "ads_payment_analysis": f"""
        SELECT *, {percent(_cents("total_amount"), _cents("sum(total_amount) OVER ()"))} AS amount_share_pct,
               {percent("payment_count", "sum(payment_count) OVER ()")} AS count_share_pct
        FROM (
          SELECT payment_type, count(*) AS payment_count, count(DISTINCT order_id) AS order_count,
                 CAST(sum(payment_value) AS {MONEY}) AS total_amount,
                 {mean_money("sum(payment_value)", "count(payment_value)")} AS avg_amount,
                 {half_up("sum(payment_installments)", "count(payment_installments)", 2)} AS avg_installments,
                 {percent("count(*) FILTER (WHERE is_installment)", "count(*)")} AS installment_rate_pct
          FROM fct_payments WHERE NOT is_orphan_payment GROUP BY payment_type)""",
    "monthly_scores": f"""
        SELECT order_month, count(*) AS review_count, count(DISTINCT order_id) AS reviewed_order_count,
               {half_up("sum(review_score)", "count(review_score)", 3)} AS avg_review_score,
               count(*) FILTER (WHERE review_score <= {V.BAD_UP_TO}) AS bad,
               count(*) FILTER (WHERE review_score = {V.NEUTRAL}) AS neutral,
               count(*) FILTER (WHERE review_score >= {V.GOOD_FROM}) AS good,
               count(*) FILTER (WHERE has_comment) AS commented
        FROM fct_reviews WHERE is_latest_review AND order_month IS NOT NULL GROUP BY order_month""",
    "ads_review_analysis": f"""
        SELECT order_month, review_count, reviewed_order_count, avg_review_score,
               {percent("bad", "review_count")} AS bad_rate_pct,
               {percent("neutral", "review_count")} AS neutral_rate_pct,
               {percent("good", "review_count")} AS good_rate_pct,
               {percent("commented", "review_count")} AS comment_rate_pct,
               {percent("(good - bad)", "review_count")} AS nps_simplified,
               CASE WHEN count(avg_review_score) OVER () = 0 THEN 'unknown'
                    WHEN avg_review_score >= 4.2 THEN 'excellent' WHEN avg_review_score >= 3.8 THEN 'good'
                    WHEN avg_review_score >= 3.5 THEN 'warning' ELSE 'critical' END AS health_level
        FROM monthly_scores""",
    "customer_scores": f"""
        SELECT *, CAST(ntile(4) OVER (ORDER BY last_order_date, customer_id) AS INTEGER) AS r_score,
               CAST(ntile(4) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
               CAST(ntile(4) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score
        FROM (SELECT customer_id, max(order_date) AS last_order_date, count(DISTINCT order_id) AS frequency,
                     CAST(sum(order_amount) AS {MONEY}) AS monetary
              FROM fct_orders WHERE is_delivered GROUP BY customer_id)""",
    "dws_customer_rfm": f"""
        SELECT *, r_score + f_score + m_score AS rfm_total, {SEGMENT} AS rfm_segment FROM customer_scores""",
    "sales_by_seller": f"""
        SELECT seller_id, count(DISTINCT order_id) AS order_count, count(*) AS item_count,
               count(DISTINCT product_id) AS product_count,
               CAST(ifnull(sum(order_amount) FILTER (WHERE is_delivered), 0) AS {MONEY}) AS gmv_delivered,
               CAST(sum(order_amount) AS {MONEY}) AS gmv_all,
               {mean_money("ifnull(sum(order_amount) FILTER (WHERE is_delivered), 0)",
                           "count(*) FILTER (WHERE is_delivered)")} AS avg_order_value,
               min(order_date) AS first_sale_date, max(order_date) AS last_sale_date
        FROM fct_orders GROUP BY seller_id""",
    "reviews_by_seller": f"""
        SELECT seller_id, count(review_id) AS review_count,
               {half_up("sum(review_score)", "count(review_score)", 3)} AS avg_review_score,
               {percent("count(*) FILTER (WHERE review_score >= 4)", "count(review_id)")} AS good_review_rate_pct,
               {percent("count(*) FILTER (WHERE review_score <= 2)", "count(review_id)")} AS bad_review_rate_pct
        FROM fct_orders JOIN fct_reviews USING (order_id) WHERE is_latest_review GROUP BY seller_id""",
    "dws_seller_performance": f"""
        SELECT seller_id, seller_city, seller_state, region, is_core_market,
               ifnull(order_count, 0) AS order_count, ifnull(item_count, 0) AS item_count,
               ifnull(product_count, 0) AS product_count,
               CAST(ifnull(gmv_delivered, 0) AS {MONEY}) AS gmv_delivered,
               CAST(ifnull(gmv_all, 0) AS {MONEY}) AS gmv_all,
               ifnull(avg_order_value, CAST(0 AS DOUBLE)) AS avg_order_value,
               first_sale_date, last_sale_date, ifnull(review_count, 0) AS review_count,
               avg_review_score, good_review_rate_pct, bad_review_rate_pct,
               CASE WHEN gmv_delivered >= 100000 THEN 'A_核心卖家' WHEN gmv_delivered >= 20000 THEN 'B_重点卖家'
                    WHEN gmv_delivered > 0 THEN 'C_普通卖家' ELSE 'D_无成交' END AS seller_tier,
               ifnull(gmv_delivered > 0 AND avg_review_score < {V.RISK_SCORE_BELOW}, false) AS is_risk_seller
        FROM dim_sellers LEFT JOIN sales_by_seller USING (seller_id) LEFT JOIN reviews_by_seller USING (seller_id)""",
    "kpi_revenue": f"""
        SELECT sum(gmv_delivered) AS gmv_delivered, sum(gmv_all) AS gmv_all,
               sum(gmv_all) - sum(gmv_delivered) AS gmv_gap, sum(total_orders) AS total_orders,
               CAST(round(avg(avg_order_value), 2) AS DECIMAL(18,2)) AS avg_order_value,
               {half_up("sum(CAST(round(cancel_rate_pct * 100) AS BIGINT))", "count(cancel_rate_pct)", 0)} AS rate,
               count(*) AS month_count
        FROM ads_gmv_monthly""",
    "kpi_customers": f"""
        SELECT count(*) AS customer_total, count(*) FILTER (WHERE frequency > 1) AS repeat_customer,
               {half_up("10000 * count(*) FILTER (WHERE frequency > 1)", "count(*)", 0)} AS rate
        FROM dws_customer_rfm""",
    "kpi_reviews": f"""
        SELECT count(*) AS review_total,
               {half_up("1000 * sum(review_score)", "count(review_score)", 0)} AS score_thousandths,
               {half_up("sum(CAST(round(good_rate_pct * 100) AS BIGINT))", "count(good_rate_pct)", 0)} AS good,
               {half_up("sum(CAST(round(bad_rate_pct * 100) AS BIGINT))", "count(bad_rate_pct)", 0)} AS bad
        FROM fct_reviews LEFT JOIN ads_review_analysis USING (order_month) WHERE is_latest_review""",
    "kpi_sellers": """
        SELECT count(*) AS seller_total, count(*) FILTER (WHERE gmv_delivered > 0) AS active_seller
        FROM dws_seller_performance""",
    "kpi_paid": "SELECT sum(payment_value) AS paid_amount FROM fct_payments WHERE NOT is_orphan_payment",
    "kpi_values": f"""
        SELECT 'KPI001' AS id, CAST(gmv_delivered AS DECIMAL(18,2)) AS metric_value FROM kpi_revenue
        UNION ALL SELECT 'KPI002', gmv_all FROM kpi_revenue
        UNION ALL SELECT 'KPI003', gmv_gap FROM kpi_revenue
        UNION ALL SELECT 'KPI004', total_orders FROM kpi_revenue
        UNION ALL SELECT 'KPI005', avg_order_value FROM kpi_revenue
        UNION ALL SELECT 'KPI006', CAST(rate AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) FROM kpi_revenue
        UNION ALL SELECT 'KPI007', customer_total FROM kpi_customers
        UNION ALL SELECT 'KPI008', repeat_customer FROM kpi_customers
        UNION ALL SELECT 'KPI009', CAST(rate AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) FROM kpi_customers
        UNION ALL SELECT 'KPI010', (CAST(score_thousandths AS BIGINT) + 5) // 10 * CAST(0.01 AS DECIMAL(3,2))
                  FROM kpi_reviews
        UNION ALL SELECT 'KPI011', CAST(good AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) FROM kpi_reviews
        UNION ALL SELECT 'KPI012', CAST(bad AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) FROM kpi_reviews
        UNION ALL SELECT 'KPI013', seller_total FROM kpi_sellers
        UNION ALL SELECT 'KPI014', active_seller FROM kpi_sellers
        UNION ALL SELECT 'KPI015', paid_amount FROM kpi_paid
        UNION ALL SELECT 'KPI016', month_count FROM kpi_revenue""",
    "kpi_texts": f"""
        SELECT * FROM (VALUES {_values(V.KPI_TEXTS)})
          v(metric_id, metric_name_cn, metric_name_en, metric_domain, metric_unit, metric_definition,
            data_source, metric_owner)""",
    "ads_kpi_summary": f"""
        SELECT t.*, CAST(metric_value AS DECIMAL(18,2)) AS metric_value, '{V.KPI_PERIOD}' AS calc_period,
               '{V.KPI_FREQUENCY}' AS update_freq
        FROM kpi_texts t JOIN kpi_values ON id = metric_id""",
    "corrected": """
        SELECT * REPLACE (
            CAST(price + CASE order_status WHEN 'approved' THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS price,
            CAST(order_amount + CASE order_status WHEN 'approved' THEN 1 ELSE 0 END AS DECIMAL(13,2)) AS order_amount)
        FROM fct_orders""",
    "run_1": "SELECT * FROM fct_orders WHERE order_date < DATE '2000-04-01'",
    "run_1_on_time": "SELECT * FROM run_1 WHERE freight_value > 0",
    "appended_on_time": """
        SELECT * FROM run_1_on_time UNION ALL
        SELECT * FROM corrected WHERE order_date > (SELECT max(order_date) FROM run_1_on_time)""",
    "next_state": f"""
        SELECT * FROM (VALUES {_values(zip(STATES, STATES[1:] + STATES[:1]))}) v(from_state, to_state)""",
    "movers": """
        SELECT * REPLACE (to_state AS customer_state) FROM stg_customers JOIN next_state
          ON from_state = customer_state WHERE suffix(customer_id, '0')""",
}


def _history(first: str, second: str, updated_at: bool = True) -> str:
    """Two snapshots as versions: movers have a closed and an open one."""
    columns = "customer_id, customer_unique_id, customer_city, customer_state, customer_zip_code"
    first, second = f"TIMESTAMP '{first}'", f"TIMESTAMP '{second}'"

    def versions(since: str, until: str, rows: str) -> str:
        stamp = f", {since} AS updated_at" if updated_at else ""
        return (
            f"SELECT {columns}{stamp}, {since} AS dbt_valid_from, CAST({until} AS TIMESTAMP) AS dbt_valid_to FROM {rows}"
        )

    return " UNION ALL ".join(
        [
            versions(first, second, "stg_customers WHERE customer_id LIKE '%0'"),
            versions(first, "NULL", "stg_customers WHERE customer_id NOT LIKE '%0'"),
            versions(second, "NULL", "movers"),
        ]
    )


SUBQUERIES["history"] = _history("2026-01-01 00:00:00", "2026-02-01 00:00:00")
SUBQUERIES["past_history"] = _history("1995-01-01 00:00:00", "1998-07-01 00:00:00")


def _rule_failures(rule: Rule) -> str:
    col, source = rule.column, rule.table
    if rule.kind == "unique":
        return f"SELECT count(*) FROM (SELECT {col} FROM {source} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"
    if rule.kind == "not_null":
        return f"SELECT count(*) FROM {source} WHERE {col} IS NULL"
    if rule.kind == "accepted_values":
        return f"SELECT count(DISTINCT {col}) FROM {source} WHERE {col} NOT IN ({_list(rule.values)})"
    if rule.kind == "relationships":
        return (
            f"SELECT count(*) FROM {source} c WHERE {col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {rule.parent} p WHERE p.{rule.parent_key} = c.{col})"
        )
    if rule.kind == "value_range":
        return f"SELECT count(*) FROM {source} WHERE {col} NOT BETWEEN {rule.low} AND {rule.high}"
    offends = {
        "gmv_consistency": "gmv_delivered > gmv_all",
        "positive_gmv": "gmv_delivered < 0",
        "rfm_completeness": "coalesce(rfm_segment, '') = ''",
    }[rule.kind]
    return f"SELECT count(*) FROM {source} WHERE {offends}"


def _suite(rules: list[Rule], spoiled: str | None = None) -> str:
    """``spoiled`` stands in for the payment fact."""
    selects = []
    for rule in rules:
        found = re.sub(r"\bstg_category_translation\b", "translations", _rule_failures(rule))
        if spoiled:
            found = re.sub(r"\bfct_payments\b", f"({spoiled}) x", found)
        selects.append(
            f"SELECT '{rule.table}' AS table_name, '{rule.column}' AS column_name, '{rule.kind}' AS rule, "
            f"'{rule.severity}' AS severity, ({found}) AS failures"
        )
    return (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity IN ('warn', 'info') THEN severity ELSE 'fail' END AS status FROM ("
        + " UNION ALL ".join(selects)
        + ")"
    )


def _contract() -> str:
    sizes = {"customers": "customer", "products": "part"}
    rows = []
    for name, contract in CONTRACTS.items():
        for old, new in contract.old_names.items():
            for column, drift in ((new, "missing"), (old, "undeclared")):
                rows.append(
                    f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{drift}' AS drift, "
                    f"(SELECT count(*) FROM {sizes[name]}) AS rows_concerned"
                )
    return " UNION ALL ".join(rows)


AUDITED = {
    "customers": "stg_customers",
    "orders": "stg_orders",
    "order_items": "stg_order_items",
    "products": "stg_products",
    "sellers": "stg_sellers",
    "order_payments": "stg_order_payments",
    "order_reviews": "stg_order_reviews",
    "geolocation": "stg_geolocation",
    "category_translation": "translations",
}
EARTH_DIAMETER = 2 * V.EARTH_RADIUS_KM

SELECTS = {
    "src_csv_roundtrip": "SELECT * FROM stg_customers",
    "src_all_csv_roundtrip": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, 0::BIGINT AS changed_rows FROM {source}"
        for name, source in AUDITED.items()
    ),
    "src_align_columns": "SELECT * FROM stg_products",
    "src_optional_empty": "SELECT order_status, count(*) AS orders, 0::BIGINT AS payments FROM stg_orders GROUP BY ALL",
    "src_optional_present": """
        SELECT order_status, count(DISTINCT o.order_id) AS orders, count(p.order_id) AS payments
        FROM stg_orders o LEFT JOIN stg_order_payments p USING (order_id) GROUP BY order_status""",
    "src_load_audit": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, '{','.join(CONTRACTS[name].columns)}' AS column_names "
        f"FROM {source}"
        for name, source in AUDITED.items()
    ),
    "mat_table_roundtrip": "SELECT * FROM fct_payments",
    "sink_csv_roundtrip": "SELECT * FROM ads_gmv_monthly",
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_order_items": "SELECT * FROM stg_order_items",
    "stg_products": "SELECT * FROM stg_products",
    "stg_sellers": "SELECT * FROM stg_sellers",
    "stg_order_payments": "SELECT * FROM stg_order_payments",
    "stg_order_reviews": "SELECT * FROM stg_order_reviews",
    "stg_geolocation": "SELECT * FROM stg_geolocation",
    "stg_category_translation": "SELECT * FROM translations",
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_sellers": "SELECT * FROM dim_sellers",
    "dim_sellers_conformed": "SELECT * FROM dim_sellers_conformed",
    "dim_products": "SELECT * FROM dim_products",
    "dim_products_unknown": f"""
        SELECT * REPLACE (ifnull(product_category, '{V.UNKNOWN_CATEGORY}') AS product_category,
                          CASE WHEN product_category IS NULL THEN '{V.UNKNOWN_CATEGORY_LABEL}'
                               ELSE product_category_cn END AS product_category_cn)
        FROM dim_products""",
    "dim_products_translated": """
        SELECT p.*, category_name_en AS product_category_en
        FROM dim_products p LEFT JOIN translations ON category_name_pt = product_category""",
    "dim_geography": "SELECT * FROM dim_geography",
    "fct_orders": "SELECT * FROM fct_orders",
    "fct_payments": "SELECT * FROM fct_payments",
    "fct_reviews": "SELECT * FROM fct_reviews",
    "fct_reviews_latest": "SELECT * FROM fct_reviews WHERE is_latest_review",
    "ads_gmv_monthly": "SELECT * FROM ads_gmv_monthly",
    "ads_category_sales": "SELECT * FROM ads_category_sales",
    "ads_region_overview": "SELECT * FROM ads_region_overview",
    "ads_payment_analysis": "SELECT * FROM ads_payment_analysis",
    "ads_review_analysis": "SELECT * FROM ads_review_analysis",
    "dws_customer_rfm": "SELECT * FROM dws_customer_rfm",
    "dws_customer_rfm_with_keep": f"""
        SELECT *, r_score + f_score + m_score AS rfm_total, {SEGMENT_WITH_KEEP} AS rfm_segment FROM customer_scores""",
    "dws_seller_performance": "SELECT * FROM dws_seller_performance",
    "ads_kpi_summary": "SELECT * FROM ads_kpi_summary",
    "kpi_review_block": """
        SELECT review_total,
               CAST((CAST(score_thousandths AS BIGINT) + 5) // 10 * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))
                 AS avg_review_score,
               CAST(CAST(good AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS good_rate,
               CAST(CAST(bad AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS bad_rate
        FROM kpi_reviews""",
    "metric_gmv": f"""
        SELECT order_status, CAST(sum(CASE WHEN order_status = 'delivered' THEN order_amount ELSE 0 END) AS {MONEY}) AS gmv,
               CAST(sum(order_amount) AS {MONEY}) AS gmv_all
        FROM fct_orders GROUP BY order_status""",
    "ntile_distributed": f"""
        SELECT order_id, amount, CAST(ntile(10) OVER (ORDER BY amount, order_id) AS INTEGER) AS amount_tile
        FROM (SELECT order_id, CAST(sum(order_amount) AS {MONEY}) AS amount FROM fct_orders GROUP BY order_id)""",
    "inc_full_refresh": "SELECT * FROM fct_orders",
    "inc_append": """
        SELECT * FROM run_1 UNION ALL
        SELECT * FROM fct_orders WHERE order_date > (SELECT max(order_date) FROM run_1)""",
    "inc_lookback_dedup": """
        SELECT * FROM run_1_on_time UNION ALL
        SELECT * FROM corrected
        WHERE order_date > (SELECT max(order_date) FROM run_1_on_time) - INTERVAL 7 DAY
          AND order_item_key NOT IN (SELECT order_item_key FROM run_1_on_time)""",
    "inc_merge": "SELECT * FROM corrected",
    "inc_delete_insert": """
        SELECT * FROM run_1 WHERE order_month < DATE '2000-03-01' UNION ALL
        SELECT * FROM corrected WHERE order_month >= DATE '2000-03-01'""",
    "inc_missed_rows": f"""
        SELECT c.order_month, count(*) FILTER (WHERE t.order_item_key IS NULL) AS missing_rows,
               count(*) FILTER (WHERE t.order_amount <> c.order_amount) AS stale_rows,
               CAST(ifnull(sum(c.order_amount) FILTER (WHERE t.order_item_key IS NULL), 0) AS {MONEY}) AS missing_amount
        FROM corrected c LEFT JOIN appended_on_time t USING (order_item_key)
        GROUP BY c.order_month HAVING missing_rows + stale_rows > 0""",
    "stream_inc_fact": f"""
        SELECT order_month, count(*) AS line_count,
               CAST(ifnull(sum(order_amount) FILTER (WHERE is_delivered), 0) AS {MONEY}) AS gmv_delivered,
               count(*) FILTER (WHERE freight_value <= 0 AND order_date <= (
                 SELECT max(order_date) FROM fct_orders WHERE order_date < DATE '2000-04-01' AND freight_value > 0
               ) - INTERVAL 7 DAY) AS late_lines
        FROM fct_orders GROUP BY order_month""",
    "scd2_timestamp": "SELECT * FROM history",
    "scd2_check": _history("2026-01-01 00:00:00", "2026-02-01 00:00:00", updated_at=False),
    "scd2_current": "SELECT * FROM history WHERE dbt_valid_to IS NULL",
    "scd2_as_of_date": """
        SELECT * FROM past_history
        WHERE TIMESTAMP '1998-06-30 12:00:00' >= dbt_valid_from
          AND TIMESTAMP '1998-06-30 12:00:00' < ifnull(dbt_valid_to, TIMESTAMP '9999-01-01 00:00:00')""",
    "scd2_point_in_time_join": """
        SELECT order_item_key, f.customer_id, order_date, order_amount,
               CASE WHEN order_date < DATE '1998-07-01' THEN s.customer_state
                    ELSE ifnull(m.customer_state, s.customer_state) END AS customer_state
        FROM fct_orders f LEFT JOIN stg_customers s USING (customer_id) LEFT JOIN movers m USING (customer_id)""",
    "scd1_overwrite": """
        SELECT customer_id, s.customer_unique_id, s.customer_zip_code, s.customer_city,
               ifnull(m.customer_state, s.customer_state) AS customer_state,
               CASE WHEN m.customer_id IS NULL THEN s.updated_at ELSE TIMESTAMP '2026-02-01 00:00:00' END AS updated_at
        FROM stg_customers s LEFT JOIN movers m USING (customer_id)""",
    "scd3_previous": """
        SELECT customer_id, s.customer_unique_id, s.customer_zip_code, s.customer_city,
               ifnull(m.customer_state, s.customer_state) AS customer_state,
               CASE WHEN m.customer_id IS NULL THEN s.updated_at ELSE TIMESTAMP '2026-02-01 00:00:00' END AS updated_at,
               CASE WHEN m.customer_id IS NOT NULL THEN s.customer_state END AS prev_customer_state
        FROM stg_customers s LEFT JOIN movers m USING (customer_id)""",
    "scd0_insert_only": "SELECT * FROM stg_customers",
    "dq_unique": """
        SELECT concat(l_orderkey, '-', l_linenumber) AS line_key, count(*) AS n_records
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_not_null": "SELECT * FROM fct_payments WHERE customer_id IS NULL",
    "dq_accepted_values": """
        SELECT payment_type AS value_field, count(*) AS n_records FROM stg_order_payments
        WHERE payment_type NOT IN ('credit_card', 'boleto') GROUP BY payment_type""",
    "dq_relationships": """
        SELECT order_id AS from_field, count(*) AS n_records FROM stg_order_payments p
        WHERE NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = p.order_id) GROUP BY order_id""",
    "dq_value_range": "SELECT * FROM stg_order_payments WHERE payment_value NOT BETWEEN 1 AND 100",
    "dq_not_empty_string": "SELECT * FROM stg_order_reviews WHERE coalesce(trim(review_comment_message), '') = ''",
    "dq_gmv_consistency": f"""
        SELECT order_month, gmv_all, gmv_delivered, gmv_cancelled, CAST(gmv_all - gmv_delivered AS {MONEY}) AS diff
        FROM ads_gmv_monthly WHERE gmv_all < gmv_delivered""",
    "dq_positive_gmv": "SELECT order_month, gmv_delivered FROM ads_gmv_monthly WHERE 0 > gmv_delivered",
    "dq_rfm_completeness": "SELECT customer_id, rfm_segment FROM dws_customer_rfm WHERE coalesce(rfm_segment, '') = ''",
    "dq_gmv_consistency_broken": f"""
        SELECT order_month, gmv_all, CAST(2 * gmv_all AS {MONEY}) AS gmv_delivered, gmv_cancelled,
               CAST(-gmv_all AS {MONEY}) AS diff
        FROM ads_gmv_monthly WHERE month(order_month) IN (3, 9) AND gmv_all > 0""",
    "dq_positive_gmv_broken": f"""
        SELECT order_month, CAST(-gmv_all AS {MONEY}) AS gmv_delivered
        FROM ads_gmv_monthly WHERE month(order_month) IN (6, 12) AND gmv_all > 0""",
    "dq_rfm_completeness_broken": """
        SELECT customer_id, CASE WHEN r_score = 3 THEN '' END AS rfm_segment FROM dws_customer_rfm WHERE r_score >= 3""",
    "union_distinct_places": """
        SELECT customer_city AS city, customer_state AS state FROM stg_customers
        UNION SELECT seller_city, seller_state FROM stg_sellers""",
    "dq_warn_orders_without_items": """
        SELECT 'orders_without_items' AS rule, 'warn' AS severity, count(*) AS failures,
               CASE WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END AS status
        FROM stg_orders WHERE order_id NOT IN (SELECT order_id FROM stg_order_items)""",
    "dq_contract": _contract(),
    "warehouse_build": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STORED),
    "dq_suite_report": _suite(RULES),
    "dq_gate_blocked": _suite(
        [r for r in RULES if r.table == "fct_payments"],
        "SELECT * REPLACE (CASE WHEN payment_type <> 'voucher' THEN payment_type END AS payment_type) FROM fct_payments",
    ),
    "dq_gate": f"""
        SELECT payment_type, count(*) AS payment_count, CAST(sum(payment_value) AS {MONEY}) AS paid
        FROM fct_payments GROUP BY payment_type""",
    "audit_fanout_inflation": f"""
        SELECT fact_rows, joined_rows, fact_amount, joined_amount,
               {half_up(_cents("joined_amount"), _cents("fact_amount"), 4)} AS inflation_factor
        FROM (SELECT count(*) AS joined_rows, CAST(sum(order_amount) AS {MONEY}) AS joined_amount
              FROM fct_orders LEFT JOIN stg_order_reviews USING (order_id)),
             (SELECT count(*) AS fact_rows, CAST(sum(order_amount) AS {MONEY}) AS fact_amount FROM fct_orders)""",
    "audit_join_loss": f"""
        SELECT rows_total, rows_lost, keys_total, keys_lost, {percent("rows_lost", "rows_total")} AS lost_pct
        FROM (SELECT count(*) AS rows_total, count(*) FILTER (WHERE i.order_id IS NULL) AS rows_lost,
                     count(DISTINCT o.order_id) AS keys_total,
                     count(DISTINCT o.order_id) FILTER (WHERE i.order_id IS NULL) AS keys_lost
              FROM stg_orders o LEFT JOIN (SELECT DISTINCT order_id FROM stg_order_items) i USING (order_id))""",
    "audit_total_reconcile": f"""
        SELECT mart, mart_total, fact_total, CAST(mart_total - fact_total AS {MONEY}) AS diff,
               mart_total = fact_total AS matches
        FROM (SELECT 'ads_gmv_monthly' AS mart, CAST(sum(gmv_delivered) AS {MONEY}) AS mart_total FROM ads_gmv_monthly
              UNION ALL SELECT 'ads_category_sales', sum(gmv) FROM ads_category_sales
              UNION ALL SELECT 'ads_region_overview', sum(gmv) FROM ads_region_overview
              UNION ALL SELECT 'dws_seller_performance', sum(gmv_delivered) FROM dws_seller_performance),
             (SELECT CAST(sum(order_amount) AS {MONEY}) AS fact_total FROM fct_orders WHERE is_delivered)""",
    "audit_key_multiplicity": """
        SELECT copies, count(*) AS key_values, CAST(sum(copies) AS BIGINT) AS "rows"
        FROM (SELECT review_id, count(*) AS copies FROM stg_order_reviews GROUP BY review_id) GROUP BY copies""",
    "audit_order_count_two_ways": """
        SELECT order_table_orders, fact_orders, order_table_orders - fact_orders AS difference
        FROM (SELECT count(*) AS order_table_orders FROM stg_orders),
             (SELECT count(DISTINCT order_id) AS fact_orders FROM fct_orders)""",
    "recon_order_payment": f"""
        SELECT CASE WHEN paid IS NULL THEN 'unpaid' WHEN due IS NULL THEN 'paid_without_lines'
                    WHEN paid = due THEN 'equal' WHEN paid < due THEN 'underpaid' ELSE 'overpaid' END AS bucket,
               count(*) AS orders, CAST(ifnull(sum(due), 0) AS {MONEY}) AS receivable,
               CAST(ifnull(sum(paid), 0) AS {MONEY}) AS received
        FROM (SELECT order_id, sum(order_amount) AS due FROM fct_orders GROUP BY order_id)
        FULL JOIN (SELECT order_id, sum(payment_value) AS paid FROM stg_order_payments GROUP BY order_id)
          USING (order_id)
        GROUP BY bucket""",
    "probe_table_sizes": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {AUDITED[name]}"
        for name in ("orders", "order_items", "customers", "products")
    ),
    "probe_missing_category": """
        SELECT count(*) - count(product_category) AS missing_category FROM stg_products""",
    "probe_status_distribution": "SELECT order_status, count(*) AS cnt FROM stg_orders GROUP BY order_status",
    "probe_orders_without_items": """
        SELECT count(*) AS orders_without_items FROM stg_orders
        WHERE order_id NOT IN (SELECT order_id FROM stg_order_items)""",
    "probe_orphan_products": """
        SELECT count(*) AS orphan_products FROM stg_order_items
        WHERE product_id NOT IN (SELECT product_id FROM stg_products)""",
    "probe_orphan_customers": """
        SELECT count(*) AS orphan_customers FROM stg_orders
        WHERE customer_id NOT IN (SELECT customer_id FROM stg_customers)""",
    "probe_time_inversion": """
        SELECT count(*) AS inverted_rows FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        WHERE l_shipdate < o_orderdate""",
    "probe_price_anomaly": """
        SELECT count(*) AS total_rows, count(*) FILTER (WHERE price IS NULL) AS null_price,
               count(*) FILTER (WHERE price <= 0) AS non_positive_price
        FROM stg_order_items""",
    "probe_blank_location": """
        SELECT count(*) FILTER (WHERE coalesce(customer_city, '') = '') AS blank_city,
               count(*) FILTER (WHERE coalesce(customer_state, '') = '') AS blank_state
        FROM stg_customers""",
    "probe_time_span": """
        SELECT CAST(min(order_purchased_at) AS DATE) AS first_order_date,
               CAST(max(order_purchased_at) AS DATE) AS last_order_date
        FROM stg_orders""",
    "adhoc_customers_over_n": """
        SELECT customer_id, count(*) AS order_cnt FROM stg_orders GROUP BY customer_id HAVING count(*) > 2""",
    "adhoc_orders_per_state": """
        SELECT customer_state, count(*) AS order_cnt FROM stg_orders LEFT JOIN stg_customers USING (customer_id)
        GROUP BY customer_state""",
    "adhoc_item_totals": f"""
        SELECT count(*) AS line_count, CAST(sum(price) AS {MONEY}) AS price_total,
               CAST(sum(price) AS DOUBLE) / count(price) AS price_avg, max(price) AS price_max
        FROM stg_order_items""",
    "adhoc_rfm_distribution": """
        SELECT rfm_segment, m_score, count(*) AS customers FROM dws_customer_rfm GROUP BY rfm_segment, m_score""",
    "adhoc_gmv_trend": "SELECT order_month, gmv_delivered, gmv_all FROM ads_gmv_monthly",
    "adhoc_category_rank": f"""
        SELECT product_category_cn, CAST(sum(gmv) AS {MONEY}) AS gmv FROM ads_category_sales GROUP BY ALL""",
    "adhoc_topk_latest_orders": "SELECT * FROM stg_orders ORDER BY order_purchased_at DESC, order_id LIMIT 10",
    "adhoc_topk_cancelled_orders": """
        SELECT * FROM stg_orders WHERE order_status = 'canceled' ORDER BY order_purchased_at DESC, order_id LIMIT 10""",
    "adhoc_monthly_running_gmv": f"""
        SELECT order_month, gmv_delivered,
               CAST(sum(gmv_delivered) OVER (ORDER BY order_month) AS {MONEY}) AS running_gmv
        FROM ads_gmv_monthly""",
    "adhoc_seller_rank": """
        SELECT seller_id, gmv_delivered, rank() OVER (ORDER BY gmv_delivered DESC) AS gmv_rank FROM sales_by_seller""",
    "adhoc_region_flow": """
        SELECT c.region AS customer_region, s.region AS seller_region, count(*) AS line_count
        FROM fct_orders JOIN dim_customers c USING (customer_id) JOIN dim_sellers_conformed s USING (seller_id)
        GROUP BY c.region, s.region""",
    "adhoc_cross_state_share": f"""
        SELECT customer_state, line_count, cross_state_lines,
               {percent("cross_state_lines", "line_count")} AS cross_state_pct
        FROM (SELECT customer_state, count(*) AS line_count,
                     count(*) FILTER (WHERE customer_state <> seller_state) AS cross_state_lines
              FROM fct_orders LEFT JOIN dim_customers USING (customer_id) LEFT JOIN dim_sellers USING (seller_id)
              GROUP BY customer_state)""",
    "adhoc_delivery_distance": f"""
        SELECT seller_state, count(*) AS line_count, count(km) AS located_lines, round(avg(km), 3) AS avg_km
        FROM (SELECT seller_state,
                {EARTH_DIAMETER} * asin(sqrt(least(1.0,
                  pow(sin(radians(t.latitude_avg - f.latitude_avg) / 2), 2)
                  + cos(radians(f.latitude_avg)) * cos(radians(t.latitude_avg))
                    * pow(sin(radians(t.longitude_avg - f.longitude_avg) / 2), 2)))) AS km
              FROM fct_orders LEFT JOIN dim_customers USING (customer_id) LEFT JOIN dim_sellers USING (seller_id)
              LEFT JOIN dim_geography f ON f.zip_code_prefix = seller_zip_code_prefix
              LEFT JOIN dim_geography t ON t.zip_code_prefix = customer_zip_code)
        GROUP BY seller_state""",
    "adhoc_shared_reviews": """
        SELECT count(*) AS shared_rows, count(DISTINCT review_id) AS shared_ids
        FROM fct_reviews WHERE is_shared_review_id""",
    "adhoc_score_decline": """
        SELECT order_month, avg_review_score, fell,
               fell AND ifnull(lag(fell) OVER (ORDER BY order_month), false) AS is_warning
        FROM (SELECT order_month, avg_review_score,
                     ifnull(avg_review_score < lag(avg_review_score) OVER (ORDER BY order_month), false) AS fell
              FROM ads_review_analysis)""",
    "pay_mix": f"""
        SELECT payment_types, order_count, {percent("order_count", "sum(order_count) OVER ()")} AS order_share_pct
        FROM (SELECT payment_types, count(*) AS order_count
              FROM (SELECT order_id, count(DISTINCT payment_type) AS payment_types
                    FROM stg_order_payments GROUP BY order_id)
              GROUP BY payment_types)""",
    "pay_installment_hist": f"""
        SELECT payment_installments, count(*) AS payment_count, CAST(sum(payment_value) AS {MONEY}) AS paid
        FROM stg_order_payments GROUP BY payment_installments""",
}


def _used(sql: str) -> set[str]:
    """Names of the subqueries that ``sql`` mentions, directly or not."""
    found = {name for name in SUBQUERIES if re.search(rf"\b{name}\b", sql)}
    for name in list(found):
        found |= _used(SUBQUERIES[name]) - found if SUBQUERIES[name] != sql else set()
    return found


def _statement(select: str) -> str:
    used = _used(select)
    parts = [f"{name} AS ({body})" for name, body in SUBQUERIES.items() if name in used]
    return (f"WITH {', '.join(parts)} " if parts else "") + select


ORACLE = {name: _statement(select) for name, select in SELECTS.items()}
