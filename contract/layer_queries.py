"""Silver builders and gold queries, each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from abonados.plans import checks as K
from abonados.plans import gold, silver
from contract import documents as docs
from contract import oracle_parts as O
from contract.registry import query

T = O.text_of


def as_of():
    return F.lit(docs.AS_OF)


# --- silver ----------------------------------------------------------------------

query(
    "b1_customers", K.BRONZE,
    oracle=O.with_parts(f"""
    SELECT customer_id, first_name, last_name, email, phone_number, age, country_original, country, city,
      latitude::DOUBLE AS latitude, longitude::DOUBLE AS longitude, operator, plan_type,
      monthly_data_gb::DOUBLE AS monthly_data_gb, monthly_bill_usd::DOUBLE AS monthly_bill_usd, device_brand, device_model,
      {T('registration_date')} AS registration_date, {T('last_payment_date')} AS last_payment_date, customer_status,
      credit_limit::DOUBLE AS credit_limit, credit_score, data_usage_current_month::DOUBLE AS data_usage_current_month,
      record_uuid, {T('loaded_at')} AS _loaded_at FROM cust""", "cust"),
)(silver.customers)

query(
    "b2_payments", K.BRONZE,
    oracle=O.with_parts(f"""
    SELECT payment_id, customer_id, {T('payment_date')} AS payment_date, payment_amount::DOUBLE AS payment_amount,
      payment_status, {T('loaded_at')} AS _loaded_at FROM pay""", "pay"),
)(silver.payments)

query(
    "b3_customer_services", K.BRONZE, K.DIM_SERVICES,
    oracle=O.with_parts(f"""
    SELECT customer_id, service_id, status, {T('contracted_date')} AS contracted_date, {T('loaded_at')} AS last_updated FROM svc""", "svc"),
)(lambda bronze, dim: silver.customer_services(bronze, dim, as_of()))

# --- gold ------------------------------------------------------------------------

query(
    "g0_customer_analytics", K.CUSTOMERS, K.PAYMENTS, K.SERVICES,
    oracle=O.with_parts(f"""
    SELECT customer_id, plan_type, operator, country, city, device_brand, device_model,
      monthly_bill_usd::DOUBLE AS monthly_bill_usd, monthly_data_gb::DOUBLE AS monthly_data_gb, credit_score, credit_score_range,
      age, age_bucket, {T('registration_date')} AS registration_date, customer_status, {T('loaded_at')} AS _loaded_at,
      total_revenue::DOUBLE AS total_revenue, avg10::DOUBLE / 1e10 AS avg_payment_amount, payments_count,
      {T('first_payment_date')} AS first_payment_date, {T('last_payment_date')} AS last_payment_date,
      has_payment_issues, has_pending_payments, services AS total_services_count, services AS active_services_count,
      months_of_service, arpu_estimated, arpu_real FROM ca""", "ca"),
)(lambda c, p, s: gold.customer_analytics(c, p, s, as_of()))


def _grouped(keys: str, extra: str = "", where: str = "") -> str:
    return O.with_parts(f"SELECT {keys}, count(*) AS customers {extra} FROM ca {where} GROUP BY {keys}", "ca")


_MONTH = T("date_trunc('month', registration_date)")
_ARPU = O.mean2("sum(arpu10)", "count(arpu10)")
_KNOWN = "WHERE device_brand <> 'Unknown'"

_ON_ANALYTICS = {
    "g1_acquisition_trends_operator": O.with_parts(
        f"SELECT {_MONTH} AS month, operator, count(*) AS new_customers FROM ca GROUP BY 1, 2", "ca"),
    "g2_age_dist_country_operator": _grouped("country, operator, age_bucket"),
    "g3_age_distribution_by_plan": _grouped("plan_type, age_bucket"),
    "g4_arpu_by_plan_type": O.with_parts(
        f"SELECT plan_type, {_ARPU} AS arpu FROM ca WHERE arpu10 IS NOT NULL GROUP BY plan_type", "ca"),
    "g5_credit_score_distribution": _grouped("credit_score_range", f", {_ARPU} AS avg_arpu"),
    "g7_customer_status_distribution": O.with_parts(
        f"""SELECT customer_status, customers, {O.percent('customers', 'total')} AS pct_total
        FROM (SELECT customer_status, count(*) AS customers, (SELECT count(*) FROM ca) AS total FROM ca GROUP BY 1)""", "ca"),
    "g8_customers_by_geo": _grouped("country, city"),
    "g9_customers_by_operator": _grouped("operator", f", {_ARPU} AS avg_arpu"),
    "g10_customers_pending_payments": O.with_parts(
        """SELECT customer_id, plan_type, operator, country, city, total_revenue::DOUBLE AS total_revenue, arpu_estimated
        FROM ca WHERE has_pending_payments""", "ca"),
    "g11_device_brand_by_country_operator": _grouped("country, operator, device_brand", where=_KNOWN),
    "g12_device_brand_by_plan_type": _grouped("plan_type, device_brand", where=_KNOWN),
    "g13_device_brand_popularity": _grouped("device_brand", where=_KNOWN),
    "g14_new_customers_over_time": O.with_parts(
        f"SELECT {_MONTH} AS month, count(*) AS new_customers FROM ca GROUP BY 1", "ca"),
    "g15_payment_issues_pct": O.with_parts(
        f"SELECT {O.percent('issues', 'total')} AS pct_payment_issues FROM (SELECT count(*) FILTER (WHERE has_payment_issues) AS issues, count(*) AS total FROM ca)", "ca"),
    "g16_revenue_by_geo": O.with_parts(
        f"""SELECT country, city, sum(total_revenue)::DOUBLE AS total_revenue, count(*) AS customers, {_ARPU} AS avg_arpu
        FROM ca GROUP BY country, city""", "ca"),
    "g17_revenue_stats_plan_operator": O.with_parts(
        f"""SELECT plan_type, operator, {_ARPU} AS mean_revenue, round(quantile_cont(arpu_estimated, 0.5), 6) AS median_revenue,
          (SELECT arpu_estimated FROM ca m WHERE m.plan_type = ca.plan_type AND m.operator = ca.operator AND m.arpu10 IS NOT NULL
           GROUP BY arpu_estimated ORDER BY count(*) DESC, arpu_estimated LIMIT 1) AS mode_revenue, count(*) AS customers
        FROM ca WHERE arpu10 IS NOT NULL GROUP BY plan_type, operator""", "ca"),
}
for _name, _oracle in _ON_ANALYTICS.items():
    _function = getattr(gold, _name.split("_", 1)[1])
    if _name.startswith("g17"):
        _function = lambda ca: gold.revenue_stats_plan_operator(ca).withColumn(
            "median_revenue", F.round("median_revenue", 6))
    query(_name, K.ANALYTICS, oracle=_oracle)(_function)

query(
    "g6_credit_score_vs_payment_behavior", K.PAYMENTS, K.ANALYTICS,
    oracle=O.with_parts(f"""
    SELECT credit_score_range, total AS total_payments, {O.percent('completed', 'total')} AS pct_completed,
      {O.percent('failed', 'total')} AS pct_failed, {O.percent('pending', 'total')} AS pct_pending, {O.percent('late', 'total')} AS pct_late
    FROM (SELECT credit_score_range, count(*) AS total, count(*) FILTER (WHERE payment_status = 'COMPLETED') AS completed,
      count(*) FILTER (WHERE payment_status = 'FAILED') AS failed, count(*) FILTER (WHERE payment_status = 'PENDING') AS pending,
      count(*) FILTER (WHERE payment_status = 'LATE') AS late
      FROM pay JOIN ca USING (customer_id) GROUP BY credit_score_range)""", "ca"),
)(gold.credit_score_vs_payment_behavior)


def _combos(join: str) -> str:
    return f"""(SELECT customer_id, string_agg(service_code, ',' ORDER BY service_code) AS service_combo, count(DISTINCT s.service_id) AS services_count,
      any_value(total_revenue) AS total_revenue, any_value(arpu10) AS arpu10
      FROM svc s {join} JOIN ca USING (customer_id) GROUP BY customer_id)"""


_COMBO_ARPU = O.mean2("sum(coalesce(arpu10, 0))", "count(*)")
query(
    "g18_service_combinations_popularity", K.SERVICES, K.DIM_SERVICES, K.ANALYTICS,
    oracle=O.with_parts(f"""
    SELECT service_combo, services_count, customers, total_revenue, avg_arpu, {O.percent('customers', 'everyone')} AS pct_customers
    FROM (SELECT *, sum(customers) OVER () AS everyone FROM (
      SELECT service_combo, services_count, count(*) AS customers, sum(coalesce(total_revenue, 0))::DOUBLE AS total_revenue, {_COMBO_ARPU} AS avg_arpu
      FROM {_combos('')} GROUP BY service_combo, services_count))""", "ca"),
)(gold.service_combinations_popularity)
query(
    "g19_service_combo_revenue", K.SERVICES, K.DIM_SERVICES, K.ANALYTICS,
    oracle=O.with_parts(f"""
    SELECT service_combo, services_count, sum(coalesce(total_revenue, 0))::DOUBLE AS total_revenue, {_COMBO_ARPU} AS avg_arpu, count(*) AS customers
    FROM {_combos('LEFT')} GROUP BY service_combo, services_count""", "ca"),
)(gold.service_combo_revenue)
query(
    "g20_services_popularity", K.SERVICES, K.DIM_SERVICES, K.ANALYTICS,
    oracle=O.with_parts(f"""
    SELECT service_code, customers, {O.percent('customers', 'everyone')} AS penetration_pct
    FROM (SELECT service_code, count(DISTINCT customer_id) AS customers, (SELECT count(DISTINCT customer_id) FROM ca) AS everyone FROM svc GROUP BY 1)""", "ca"),
)(gold.services_popularity)
