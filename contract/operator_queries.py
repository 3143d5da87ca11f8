"""Filters, joins, aggregates, windows, sorts and checks, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abonados.functions import documents as D
from abonados.functions import parsing as P
from abonados.operators import audit, quality, statistics
from abonados.operators.latest import keep_latest
from abonados.plans import checks as K
from abonados.plans import gold, silver
from contract import documents as docs
from contract import oracle_parts as O
from contract.registry import query

T = O.text_of
count = lambda name: F.count("*").alias(name)


def doc():
    return F.col("data")


# --- filters ------------------------------------------------------------------------

query(
    "v1_payment_documents", K.BRONZE,
    oracle=O.with_parts("SELECT row_id FROM pay_docs", "pay"),
)(lambda b: b.filter(
    D.is_array(D.field(doc(), "payment_history")) & D.is_usable(doc(), "customer_id")
    & P.has_timestamp_shape(D.field_text(doc(), "registration_date"))
    & P.given_customer_id(doc()).isNotNull()).select(F.col("_row_id").alias("row_id")))
query(
    "v2_documents_with_services", K.BRONZE,
    oracle=O.with_parts("SELECT row_id FROM ids WHERE listed NOT IN ('', '[]')", "raw"),
)(lambda b: b.filter(~D.field_text(doc(), "contracted_services").isin("", "[]")).select(F.col("_row_id").alias("row_id")))
query(
    "v3_newest_with_valid_date", K.BRONZE,
    oracle=O.with_parts("SELECT customer_id, row_id FROM cust", "cust"),
)(lambda b: keep_latest(
    silver.cleaned_customers(b), ["customer_id"], [F.col("_loaded_at").desc(), F.col("_row_id").desc()])
    .filter(F.col("registration_date").isNotNull()).select("customer_id", F.col("_row_id").alias("row_id")))
query(
    "v4_valid_payments", K.PAYMENTS,
    oracle=O.with_parts("SELECT customer_id, count(*) AS payments, min(payment_amount)::DOUBLE AS least FROM pay GROUP BY 1", "pay"),
)(lambda p: p.filter((F.col("payment_amount") > 0) & F.col("payment_date").isNotNull())
  .groupBy("customer_id").agg(count("payments"), F.min("payment_amount").alias("least")))
query(
    "v5_non_empty_tokens", K.BRONZE,
    oracle=O.with_parts("SELECT row_id, count(*) AS tokens FROM svc_tok WHERE trim(token) <> '' GROUP BY 1", "svc"),
)(lambda b: b.filter(~D.field_text(doc(), "contracted_services").isin("", "[]"))
  .select(F.col("_row_id").alias("row_id"), F.explode(P.service_tokens(D.field_text(doc(), "contracted_services"))).alias("token"))
  .filter(F.trim("token") != "").groupBy("row_id").agg(count("tokens")))
query(
    "v6_arpu_is_known", K.ANALYTICS,
    oracle=O.with_parts("SELECT customer_id, arpu_estimated FROM ca WHERE arpu10 IS NOT NULL", "ca"),
)(lambda ca: ca.filter(F.col("arpu_estimated").isNotNull()).select("customer_id", "arpu_estimated"))
query(
    "v7_brand_is_known", K.ANALYTICS,
    oracle=O.with_parts("SELECT customer_id, device_brand FROM ca WHERE device_brand IS NOT NULL AND device_brand <> 'Unknown'", "ca"),
)(lambda ca: ca.filter(F.col("device_brand").isNotNull() & (F.col("device_brand") != "Unknown")).select("customer_id", "device_brand"))
query(
    "v8_boolean_column", K.ANALYTICS,
    oracle=O.with_parts("SELECT customer_id FROM ca WHERE has_payment_issues", "ca"),
)(lambda ca: ca.filter("has_payment_issues").select("customer_id"))
query(
    "v9_range_list_pattern", K.CUSTOMERS,
    oracle=O.with_parts("""
    SELECT customer_id FROM cust WHERE age BETWEEN 18 AND 44 AND operator IN ('TIGO', 'WOM', 'CLARO')
      AND (regexp_matches(phone_number, '^\\+5[0-9]') OR phone_number IS NULL) AND NOT device_model = 'Model Unknown'""", "cust"),
)(lambda c: c.filter(
    F.col("age").between(18, 44) & F.col("operator").isin("TIGO", "WOM", "CLARO")
    & (F.col("phone_number").rlike(r"^\+5[0-9]") | F.col("phone_number").isNull())
    & ~(F.col("device_model") == "Model Unknown")).select("customer_id"))
query(
    "v10_rows_outside_validity", K.ANALYTICS,
    oracle=O.with_parts("""
    SELECT customer_id, months_of_service FROM ca WHERE plan_type = 'PREPAGO' AND (months_of_service < 0 OR months_of_service > 340)""", "ca"),
)(lambda ca: quality.RowsMatching(
    K.ANALYTICS, label="tenure", condition="plan_type = 'PREPAGO' AND (months_of_service < 0 OR months_of_service > 340)")
    .violations({K.ANALYTICS: ca}).select("customer_id", "months_of_service"))

# --- joins --------------------------------------------------------------------------

query(
    "k1_chained_left_joins", K.CUSTOMERS, K.PAYMENTS, K.SERVICES,
    oracle=O.with_parts("SELECT customer_id, payments_count, total_revenue::DOUBLE AS total_revenue, nullif(services, 0) AS services FROM ca", "ca"),
)(lambda c, p, s: c.select("customer_id").join(gold.payments_by_customer(p), "customer_id", "left")
  .join(gold.services_by_customer(s), "customer_id", "left")
  .select("customer_id", "payments_count", "total_revenue", F.col("total_services_count").alias("services")))
query(
    "k2_codes_to_dimension", K.BRONZE, K.DIM_SERVICES,
    oracle=O.with_parts("SELECT service_id, count(*) AS mentions FROM svc_match GROUP BY 1", "svc"),
)(lambda b, dim: b.select(F.explode(P.service_tokens(D.field_text(doc(), "contracted_services"))).alias("token"))
  .select(F.upper(F.trim("token")).alias("service_code")).filter("service_code <> ''")
  .join(F.broadcast(dim), "service_code").groupBy("service_id").agg(count("mentions")))
query(
    "k3_bridge_to_dimension", K.SERVICES, K.DIM_SERVICES,
    oracle=O.with_parts("SELECT customer_id, service_code, status FROM svc", "svc"),
)(lambda s, dim: s.join(F.broadcast(dim), "service_id").select("customer_id", "service_code", "status"))
query(
    "k4_payments_to_analytics", K.PAYMENTS, K.ANALYTICS,
    oracle=O.with_parts("SELECT payment_id, customer_id, credit_score_range FROM pay JOIN ca USING (customer_id)", "ca"),
)(lambda p, ca: p.select("payment_id", "customer_id").join(ca.select("customer_id", "credit_score_range"), "customer_id"))
query(
    "k5_left_after_inner", K.SERVICES, K.DIM_SERVICES, K.ANALYTICS,
    oracle=O.with_parts("SELECT customer_id, service_code, plan_type FROM svc LEFT JOIN ca USING (customer_id)", "ca"),
)(lambda s, dim, ca: s.join(F.broadcast(dim), "service_id").join(ca.select("customer_id", "plan_type"), "customer_id", "left")
  .select("customer_id", "service_code", "plan_type"))
query(
    "k6_lateral_unnest", K.BRONZE,
    oracle=O.with_parts("SELECT token, count(*) AS mentions FROM svc_tok GROUP BY 1", "svc"),
)(lambda b: b.select(F.explode(P.service_tokens(D.field_text(doc(), "contracted_services"))).alias("token"), D.field_text(doc(), "contracted_services").alias("listed"))
  .filter("listed NOT IN ('', '[]')").groupBy("token").agg(count("mentions")))


def _lateral_variants(bronze: DataFrame) -> DataFrame:
    """All elements of all payment lists, by a lateral join with a table function."""
    return bronze.sparkSession.sql(
        """SELECT d._row_id AS row_id, count(*) AS payments
        FROM {bronze} d, LATERAL variant_explode(variant_get(d.data, '$.payment_history', 'variant')) AS e
        WHERE schema_of_variant(variant_get(d.data, '$.payment_history', 'variant')) LIKE 'ARRAY%'
        GROUP BY d._row_id""",
        bronze=bronze,
    )


query(
    "k7_lateral_table_function", K.BRONZE,
    oracle=O.with_parts("""
    SELECT row_id, n_orders + CASE WHEN n % 67 = 11 THEN 2 ELSE 0 END AS payments FROM ids WHERE has_payments""", "raw"),
)(_lateral_variants)
query(
    "k8_anti_join", K.PAYMENTS, K.CUSTOMERS,
    oracle=O.with_parts("SELECT payment_id, customer_id FROM pay WHERE customer_id NOT IN (SELECT customer_id FROM cust)", "pay", "cust"),
)(lambda p, c: p.join(c.select("customer_id"), "customer_id", "left_anti").select("payment_id", "customer_id"))
query(
    "k9_customers_per_service", K.SERVICES, K.DIM_SERVICES,
    oracle=O.with_parts("SELECT service_code, count(*) AS customers FROM svc GROUP BY 1", "svc"),
)(audit.customers_per_service)

# --- aggregates -----------------------------------------------------------------------

query(
    "a1_count_by_keys", K.CUSTOMERS,
    oracle=O.with_parts("SELECT country, operator, plan_type, count(*) AS customers FROM cust GROUP BY ALL", "cust"),
)(lambda c: c.groupBy("country", "operator", "plan_type").agg(count("customers")))
query(
    "a2_filtered_count", K.PAYMENTS,
    oracle=O.with_parts("SELECT customer_id, count(*) FILTER (WHERE payment_status = 'COMPLETED') AS completed FROM pay GROUP BY 1", "pay"),
)(lambda p: p.groupBy("customer_id").agg(F.count_if(F.col("payment_status") == "COMPLETED").alias("completed")))
query(
    "a3_conditional_sum", K.PAYMENTS,
    oracle=O.with_parts("""
    SELECT customer_id, sum(CASE WHEN payment_status = 'COMPLETED' THEN payment_amount END)::DOUBLE AS revenue,
      CAST(sum(CASE WHEN payment_status = 'LATE' THEN 1 ELSE 0 END) AS BIGINT) AS late FROM pay GROUP BY 1""", "pay"),
)(lambda p: p.groupBy("customer_id").agg(
    F.sum(F.when(F.col("payment_status") == "COMPLETED", F.col("payment_amount"))).alias("revenue"),
    F.sum(F.when(F.col("payment_status") == "LATE", 1).otherwise(0)).alias("late")))
query(
    "a4_filtered_average", K.PAYMENTS,
    oracle=O.with_parts("""
    SELECT payment_status, round(avg(payment_amount) FILTER (WHERE payment_date >= TIMESTAMP '1998-01-01'), 4) AS mean FROM pay GROUP BY 1""", "pay"),
)(lambda p: p.groupBy("payment_status").agg(
    F.round(F.avg(F.when(F.col("payment_date") >= F.lit("1998-01-01").cast("timestamp"), F.col("payment_amount"))).cast("double"), 4).alias("mean")))
query(
    "a5_null_as_zero", K.ANALYTICS,
    oracle=O.with_parts(f"""
    SELECT operator, sum(coalesce(total_revenue, 0))::DOUBLE AS revenue, {O.mean2('sum(coalesce(arpu10, 0))', 'count(*)')} AS mean FROM ca GROUP BY 1""", "ca"),
)(lambda ca: ca.groupBy("operator").agg(
    F.sum(F.coalesce("total_revenue", F.lit(0).cast("decimal(28,6)"))).alias("revenue"),
    F.round(F.avg(F.coalesce("arpu_estimated", F.lit(0).cast("decimal(32,10)"))), 2).alias("mean")))
query(
    "a6_first_and_last", K.PAYMENTS,
    oracle=O.with_parts(f"""
    SELECT customer_id, {T('min(payment_date)')} AS first_payment, {T('max(payment_date)')} AS last_payment FROM pay GROUP BY 1""", "pay"),
)(lambda p: p.groupBy("customer_id").agg(F.min("payment_date").alias("first_payment"), F.max("payment_date").alias("last_payment")))
query(
    "a7_any_row", K.PAYMENTS,
    oracle=O.with_parts("""
    SELECT customer_id, bool_or(payment_status IN ('FAILED', 'LATE')) AS issues, bool_or(payment_status = 'PENDING') AS pending FROM pay GROUP BY 1""", "pay"),
)(lambda p: p.groupBy("customer_id").agg(
    F.bool_or(F.col("payment_status").isin("FAILED", "LATE")).alias("issues"),
    F.bool_or(F.col("payment_status") == "PENDING").alias("pending")))
query(
    "a8_distinct_count", K.SERVICES,
    oracle=O.with_parts("SELECT status, count(DISTINCT customer_id) AS customers, count(DISTINCT service_id) AS services FROM svc GROUP BY 1", "svc"),
)(lambda s: s.groupBy("status").agg(F.count_distinct("customer_id").alias("customers"), F.count_distinct("service_id").alias("services")))
query(
    "a9_grand_total", K.ANALYTICS,
    oracle=O.with_parts("SELECT count(*) AS customers, sum(total_revenue)::DOUBLE AS revenue, CAST(sum(services) AS BIGINT) AS services FROM ca", "ca"),
)(lambda ca: ca.agg(count("customers"), F.sum("total_revenue").alias("revenue"), F.sum("total_services_count").alias("services")))
query(
    "a10_ordered_text", K.SERVICES, K.DIM_SERVICES,
    oracle=O.with_parts("SELECT customer_id, string_agg(service_code, ',' ORDER BY service_code) AS combo FROM svc GROUP BY 1", "svc"),
)(lambda s, dim: s.join(F.broadcast(dim), "service_id").groupBy("customer_id").agg(
    F.expr("listagg(service_code, ',') WITHIN GROUP (ORDER BY service_code)").alias("combo")))
query(
    "a11_exact_median", K.ANALYTICS,
    oracle=O.with_parts("SELECT operator, round(quantile_cont(arpu_estimated, 0.5), 6) AS median FROM ca WHERE arpu10 IS NOT NULL GROUP BY 1", "ca"),
)(lambda ca: statistics.grouped_summary(ca, ["operator"], "arpu_estimated", few_groups=True).select("operator", F.round("median", 6).alias("median")))
query(
    "a12_mode", K.ANALYTICS,
    oracle=O.with_parts("""
    SELECT operator, credit_score AS mode, total FROM (
      SELECT *, row_number() OVER (PARTITION BY operator ORDER BY n DESC, credit_score) AS rn,
        CAST(sum(n) OVER (PARTITION BY operator) AS BIGINT) AS total
      FROM (SELECT operator, credit_score, count(*) AS n FROM ca WHERE credit_score IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1""", "ca"),
)(lambda ca: statistics.grouped_summary(ca, ["operator"], "credit_score").select("operator", "mode", "total"))
query(
    "a13_rounded_average", K.ANALYTICS,
    oracle=O.with_parts(f"SELECT city, {O.mean2('sum(arpu10)', 'count(arpu10)')} AS arpu FROM ca GROUP BY 1", "ca"),
)(lambda ca: ca.groupBy("city").agg(F.round(F.avg("arpu_estimated"), 2).alias("arpu")))
query(
    "a14_two_levels", K.PAYMENTS,
    oracle=O.with_parts("SELECT payments, count(*) AS customers FROM (SELECT customer_id, count(*) AS payments FROM pay GROUP BY 1) GROUP BY 1", "pay"),
)(lambda p: p.groupBy("customer_id").agg(count("payments")).groupBy("payments").agg(count("customers")))
_MONTH = T("date_trunc('month', payment_date)")
query(
    "a15_group_by_month", K.PAYMENTS,
    oracle=O.with_parts(f"SELECT {_MONTH} AS month, count(*) AS payments, sum(payment_amount)::DOUBLE AS amount FROM pay GROUP BY 1", "pay"),
)(lambda p: p.groupBy(F.date_trunc("month", "payment_date").alias("month")).agg(count("payments"), F.sum("payment_amount").alias("amount")))
query(
    "a16_aggregate_before_join", K.CUSTOMERS, K.PAYMENTS,
    oracle=O.with_parts("SELECT country, sum(total_revenue)::DOUBLE AS revenue FROM ca GROUP BY 1", "ca"),
)(lambda c, p: c.select("customer_id", "country").join(gold.payments_by_customer(p), "customer_id", "left")
  .groupBy("country").agg(F.sum("total_revenue").alias("revenue")))
query(
    "a17_percent_of_total", K.PAYMENTS,
    oracle=O.with_parts(f"""
    SELECT payment_status, payments, {O.percent('payments', 'total')} AS pct FROM (
      SELECT payment_status, count(*) AS payments, (SELECT count(*) FROM pay) AS total FROM pay GROUP BY 1)""", "pay"),
)(lambda p: p.groupBy("payment_status").agg(count("payments")).withColumn("pct", statistics.percent_of_total("payments")))

# --- windows --------------------------------------------------------------------------


def _newest_document(bronze: DataFrame) -> DataFrame:
    ids = bronze.select(P.customer_id(doc(), F.col("_row_id")).alias("customer_id"), "_loaded_at", "_row_id")
    newest = keep_latest(ids, ["customer_id"], [F.col("_loaded_at").desc(), F.col("_row_id").desc()])
    return newest.select("customer_id", F.col("_row_id").alias("row_id"))


query(
    "w1_newest_document", K.BRONZE,
    oracle=O.with_parts("""
    SELECT customer_id, row_id FROM (SELECT customer_id, row_id, row_number() OVER (PARTITION BY customer_id ORDER BY loaded_at DESC, row_id DESC) AS rn FROM ids)
    WHERE rn = 1""", "raw"),
)(_newest_document)
query(
    "w1b_newest_service", K.SERVICES,
    oracle=O.with_parts(f"SELECT customer_id, service_id, {T('contracted_date')} AS contracted_date FROM svc", "svc"),
)(lambda s: keep_latest(s, ["customer_id", "service_id"], [F.col("last_updated").desc(), F.col("contracted_date").desc()])
  .select("customer_id", "service_id", "contracted_date"))
query(
    "w2_window_over_aggregate", K.ANALYTICS,
    oracle=O.with_parts("""
    SELECT country, customers, CAST(sum(customers) OVER () AS BIGINT) AS everyone FROM (SELECT country, count(*) AS customers FROM ca GROUP BY 1)""", "ca"),
)(lambda ca: ca.groupBy("country").agg(count("customers")).withColumn("everyone", F.sum("customers").over(Window.partitionBy())))
query(
    "w3_surrogate_ids", K.BRONZE,
    oracle=O.with_parts("SELECT row_id, customer_id FROM ids WHERE given_id IS NULL", "raw"),
)(lambda b: b.filter(P.given_customer_id(doc()).isNull()).select(
    F.col("_row_id").alias("row_id"), P.customer_id(doc(), F.col("_row_id")).alias("customer_id")))

# --- sorts, unions, subqueries ----------------------------------------------------------

query(
    "o1_order_by", K.ANALYTICS,
    oracle=O.with_parts("SELECT country, city, sum(total_revenue)::DOUBLE AS revenue FROM ca GROUP BY 1, 2 ORDER BY revenue DESC NULLS FIRST, country, city", "ca"),
)(lambda ca: ca.groupBy("country", "city").agg(F.sum("total_revenue").alias("revenue"))
  .orderBy(F.col("revenue").desc_nulls_first(), F.col("country").asc_nulls_last(), F.col("city").asc_nulls_last()))
query(
    "o2_sort_before_write", K.SERVICES,
    oracle=O.with_parts("SELECT customer_id, service_id FROM svc ORDER BY 1, 2", "svc"),
)(lambda s: s.select("customer_id", "service_id").sortWithinPartitions("customer_id", "service_id"))
query(
    "o3_top_per_group", K.PAYMENTS,
    oracle=O.with_parts("""
    SELECT customer_id, payment_id, payment_amount::DOUBLE AS payment_amount FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY payment_amount DESC, payment_id) AS rn FROM pay) WHERE rn = 1""", "pay"),
)(lambda p: keep_latest(p, ["customer_id"], [F.col("payment_amount").desc(), F.col("payment_id")])
  .select("customer_id", "payment_id", "payment_amount"))
query(
    "o4_union_of_counts", K.BRONZE, K.CUSTOMERS, K.ANALYTICS,
    oracle=O.with_parts("""
    SELECT 'bronze' AS layer, count(*) AS rows FROM ids UNION ALL SELECT 'silver_customers', count(*) FROM cust
    UNION ALL SELECT 'gold_analytics', count(*) FROM ca""", "ca"),
)(lambda b, c, ca: audit.row_counts({"bronze": b, "silver_customers": c, "gold_analytics": ca}))
query(
    "o5_scalar_subquery", K.SERVICES, K.ANALYTICS,
    oracle=O.with_parts("""
    SELECT service_id, count(*) AS customers, (SELECT count(DISTINCT customer_id) FROM ca) AS everyone FROM svc GROUP BY 1""", "ca"),
)(lambda s, ca: s.groupBy("service_id").agg(count("customers"))
  .withColumn("everyone", ca.agg(F.count_distinct("customer_id")).scalar()))
query(
    "o6_chained_steps", K.BRONZE, K.DIM_SERVICES,
    oracle=O.with_parts("SELECT service_code, status, count(*) AS customers FROM svc GROUP BY ALL", "svc"),
)(lambda b, dim: silver.customer_services(b, dim, F.lit(docs.AS_OF)).join(F.broadcast(dim), "service_id")
  .groupBy("service_code", "status").agg(count("customers")))
query(
    "o7_derived_table", K.PAYMENTS,
    oracle=O.with_parts("""
    SELECT customer_id, payments FROM (SELECT customer_id, count(*) AS payments FROM pay GROUP BY 1) WHERE payments > 5""", "pay"),
)(lambda p: p.groupBy("customer_id").agg(count("payments")).filter("payments > 5"))
