"""Document access and column functions on the raw documents, each with its oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abonados.functions import cleaning as C
from abonados.functions import documents as D
from abonados.functions import metrics as M
from abonados.functions import parsing as P
from abonados.plans import checks as K
from contract import documents as docs
from contract import oracle_parts as O
from contract.registry import query

DOC = "data"
T = O.text_of


def text(key: str) -> Column:
    return D.field_text(F.col(DOC), key)


def _per_document(name: str, sql: str, **columns):
    """One output row per document: the row number and the given columns."""
    query(name, K.BRONZE, oracle=O.with_parts(f"SELECT row_id, {sql} FROM ids", "raw"))(
        lambda bronze: bronze.select(
            F.col("_row_id").alias("row_id"), *[make().alias(n) for n, make in columns.items()]
        )
    )


# --- documents -------------------------------------------------------------------

_per_document(
    "j1_key_exists", "id_form <> 'missing' AS has_id, listed IS NOT NULL AS has_services",
    has_id=lambda: D.has_field(F.col(DOC), "customer_id"),
    has_services=lambda: D.has_field(F.col(DOC), "contracted_services"),
)
_per_document(
    "j2_field_text",
    """CASE id_form WHEN 'word' THEN 'C-12' WHEN 'number' THEN account::VARCHAR WHEN 'digits' THEN account::VARCHAR END AS id,
       age, score, listed AS services""",
    id=lambda: text("customer_id"), age=lambda: text("age"), score=lambda: text("credit_score"),
    services=lambda: text("contracted_services"),
)
_per_document(
    "j3_field_json",
    """CASE WHEN id_form = 'null' THEN 'null' WHEN id_form = 'word' THEN '"C-12"' WHEN id_form = 'number' THEN account::VARCHAR
            WHEN id_form = 'digits' THEN '"' || account || '"' END AS id""",
    id=lambda: D.json_text(D.field(F.col(DOC), "customer_id")),
)
query(
    "j4_json_kind", K.BRONZE,
    oracle=O.with_parts("""
    SELECT id_kind, payments_kind, services_kind, count(*) AS documents FROM (
      SELECT CASE id_form WHEN 'null' THEN 'null' WHEN 'number' THEN 'number' WHEN 'missing' THEN NULL ELSE 'string' END AS id_kind,
        CASE WHEN n % 61 = 9 THEN 'string' WHEN n_orders IS NOT NULL THEN 'array' END AS payments_kind,
        CASE WHEN listed IS NULL THEN NULL WHEN n % 4 IN (0, 3) THEN 'array' ELSE 'string' END AS services_kind FROM ids)
    GROUP BY ALL""", "raw"),
)(lambda bronze: bronze.groupBy(
    D.field_kind(F.col(DOC), "customer_id").alias("id_kind"),
    D.field_kind(F.col(DOC), "payment_history").alias("payments_kind"),
    D.field_kind(F.col(DOC), "contracted_services").alias("services_kind"),
).agg(F.count("*").alias("documents")))


def _exploded(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("_row_id").alias("row_id"),
        P.given_customer_id(F.col(DOC)).alias("customer_id"),
        F.explode(D.elements(F.col(DOC), "payment_history")).alias("payment"),
    )


query(
    "j5_array_explode", K.BRONZE,
    oracle=O.with_parts("""
    SELECT row_id, n_orders + CASE WHEN n % 67 = 11 THEN 2 ELSE 0 END AS payments FROM ids WHERE has_payments""", "raw"),
)(lambda bronze: _exploded(bronze).groupBy("row_id").agg(F.count("*").alias("payments")))
query(
    "j6_text_array", K.BRONZE,
    oracle=O.with_parts("""
    SELECT service, count(*) AS mentions FROM (
      SELECT unnest(list_transform(string_split(listed[2:-2], ','), lambda x: x[2:-2])) AS service FROM ids WHERE listed LIKE '[%' AND listed <> '[]')
    GROUP BY service""", "raw"),
)(lambda bronze: bronze.filter(text("contracted_services").startswith("["))
  .select(F.explode(P.service_tokens(text("contracted_services"))).alias("service"))
  .groupBy("service").agg(F.count("*").alias("mentions")))
query(
    "j7_text_to_json", K.BRONZE,
    oracle=O.with_parts("""
    SELECT CASE WHEN listed LIKE '[%' THEN 'array' END AS kind, count(*) AS documents FROM ids WHERE listed IS NOT NULL GROUP BY 1""", "raw"),
)(lambda bronze: bronze.filter(text("contracted_services").isNotNull())
  .groupBy(D.json_kind(F.try_parse_json(text("contracted_services"))).alias("kind"))
  .agg(F.count("*").alias("documents")))
query(
    "j8_json_text", K.BRONZE,
    oracle=O.with_parts("""
    SELECT row_id, payment_json AS payment FROM ids JOIN items ON o_custkey = c_custkey AND o_block = block WHERE has_payments AND given_payment IS NULL""",
                        "raw", "items"),
)(lambda bronze: _exploded(bronze)
  .filter((D.json_kind(F.col("payment")) == "object") & D.field_text(F.col("payment"), "payment_id").isNull())
  .select("row_id", D.json_text(F.col("payment")).alias("payment")))
query(
    "j9_elements_that_are_no_objects", K.BRONZE,
    oracle=O.with_parts("""
    SELECT unnest(['number', 'null']) AS kind, count(*) AS elements FROM ids WHERE has_payments AND n % 67 = 11 HAVING count(*) > 0""", "raw"),
)(lambda bronze: _exploded(bronze)
  .filter(F.col("payment").isNotNull() & (D.json_kind(F.col("payment")) != "object"))
  .groupBy(D.json_kind(F.col("payment")).alias("kind")).agg(F.count("*").alias("elements")))

# --- cleaning ----------------------------------------------------------------------

_per_document("f1_clean_country", f"{O.country('country')} AS country", country=lambda: C.clean_country(text("country")))
_per_document("f2_clean_city", f"{O.city('city')} AS city", city=lambda: C.clean_city(text("city")))
_HOME = O.home(f"({O.country('country')})", f"({O.city('city')})")
_per_document(
    "f3_country_of_city", f"{_HOME} AS country, {O.home('country', 'city')} AS of_raw_texts",
    country=lambda: C.country_of_city(C.clean_country(text("country")), C.clean_city(text("city"))),
    of_raw_texts=lambda: C.country_of_city(text("country"), text("city")),
)
_per_document(
    "f4_clean_phone", f"{O.phone('phone', O.country('country'))} AS phone",
    phone=lambda: C.clean_phone(text("phone_number"), C.clean_country(text("country"))),
)
_per_document("f5_clean_operator", f"{O.operator('operator')} AS operator", operator=lambda: C.clean_operator(text("operator")))
_per_document("f6_clean_plan_type", f"{O.plan('plan')} AS plan_type", plan_type=lambda: C.clean_plan_type(text("plan_type")))
_per_document("f7_clean_device_brand", f"{O.brand('brand')} AS brand", brand=lambda: C.clean_device_brand(text("device_brand")))
_per_document("f8_clean_device_model", f"{O.model('model')} AS model", model=lambda: C.clean_device_model(text("device_model")))
_per_document(
    "f9_customer_id", "customer_id, given_id",
    customer_id=lambda: P.customer_id(F.col(DOC), F.col("_row_id")), given_id=lambda: P.given_customer_id(F.col(DOC)),
)
_per_document(
    "f10_parse_timestamp", f"{T(O.timestamp('registered'))} AS registered, {T(O.timestamp('last_paid'))} AS last_paid",
    registered=lambda: P.parse_timestamp(text("registration_date")), last_paid=lambda: P.parse_timestamp(text("last_payment_date")),
)
_per_document(
    "f11_age", f"CASE WHEN {O.rounded('age')} BETWEEN 0 AND 120 THEN {O.rounded('age')} END AS age",
    age=lambda: P.age_field(F.col(DOC)),
)
_per_document(
    "f12_credit_score", f"CASE WHEN {O.rounded('score')} >= 0 THEN {O.rounded('score')} END AS score",
    score=lambda: P.credit_score_field(F.col(DOC)),
)
_per_document(
    "f13_monthly_data", f"CASE WHEN {O.number('data_gb')} >= 0 THEN {O.number('data_gb')}::DOUBLE END AS data_gb",
    data_gb=lambda: P.non_negative(P.number_field(F.col(DOC), "monthly_data_gb")),
)
_per_document(
    "f14_monthly_bill", f"({O.number('bill')})::DOUBLE AS bill", bill=lambda: P.number_field(F.col(DOC), "monthly_bill_usd"),
)
query(
    "f15_payment_amount", K.BRONZE,
    oracle=O.with_parts(f"""
    SELECT row_id, o_orderkey AS payment, CASE WHEN {O.number('amount')} >= 0 THEN {O.number('amount')}::DOUBLE END AS amount
    FROM ids JOIN items ON o_custkey = c_custkey AND o_block = block WHERE has_payments AND given_payment IS NOT NULL""", "raw", "items"),
)(lambda bronze: _exploded(bronze).filter(D.field_text(F.col("payment"), "payment_id").isNotNull()).select(
    "row_id", F.substring(D.field_text(F.col("payment"), "payment_id"), 2, 20).cast("bigint").alias("payment"),
    P.non_negative(P.number_field(F.col("payment"), "amount")).alias("amount")))
_per_document(
    "f16_customer_status", f"{O.customer_status('status')} AS status", status=lambda: C.clean_customer_status(text("status")),
)
query(
    "f17_payment_status", K.BRONZE,
    oracle=O.with_parts(f"""
    SELECT items.status AS status, {O.payment_status('items.status')} AS cleaned, count(*) AS payments
    FROM ids JOIN items ON o_custkey = c_custkey AND o_block = block WHERE has_payments GROUP BY ALL""", "raw", "items"),
)(lambda bronze: _exploded(bronze).filter(D.json_kind(F.col("payment")) == "object")
  .groupBy(D.field_text(F.col("payment"), "status").alias("status")).agg(F.count("*").alias("payments"))
  .select("status", C.clean_payment_status(F.col("status")).alias("cleaned"), "payments"))
query(
    "f18_credit_score_range", K.CUSTOMERS,
    oracle=O.with_parts(f"SELECT credit_score, {O.SCORE_RANGE} AS bucket, count(*) AS customers FROM cust GROUP BY ALL", "cust"),
)(lambda c: c.groupBy("credit_score", M.credit_score_range(F.col("credit_score")).alias("bucket")).agg(F.count("*").alias("customers")))
query(
    "f19_age_bucket", K.CUSTOMERS,
    oracle=O.with_parts(f"SELECT age, {O.AGE_BUCKET} AS bucket, count(*) AS customers FROM cust GROUP BY ALL", "cust"),
)(lambda c: c.groupBy("age", M.age_bucket(F.col("age")).alias("bucket")).agg(F.count("*").alias("customers")))
_per_document(
    "f20_title_case",
    "array_to_string(list_transform(regexp_extract_all(lower(city), '([\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+)'), lambda w: upper(w[1]) || w[2:]), '') AS city",
    city=lambda: C.title_case(text("city")),
)
query(
    "f21_service_tokens", K.BRONZE,
    oracle=O.with_parts("SELECT row_id, token, count(*) AS mentions FROM svc_tok GROUP BY ALL", "svc"),
)(lambda bronze: bronze.filter((text("contracted_services") != "") & (text("contracted_services") != "[]"))
  .select(F.col("_row_id").alias("row_id"), F.explode(P.service_tokens(text("contracted_services"))).alias("token"))
  .groupBy("row_id", "token").agg(F.count("*").alias("mentions")))
query(
    "f22_months_of_service", K.CUSTOMERS,
    oracle=O.with_parts(f"SELECT customer_id, {O.months('registration_date')} AS months FROM cust", "cust"),
)(lambda c: c.select("customer_id", M.months_between(F.lit(docs.AS_OF), F.col("registration_date")).alias("months")))
query(
    "f23_arpu_estimated", K.ANALYTICS, oracle=O.with_parts("SELECT customer_id, arpu_estimated FROM ca", "ca"),
)(lambda ca: ca.select("customer_id", M.arpu_estimated(
    F.col("total_revenue"), F.col("payments_count"), F.col("monthly_bill_usd")).alias("arpu_estimated")))
query(
    "f24_arpu_real", K.ANALYTICS, oracle=O.with_parts("SELECT customer_id, arpu_real FROM ca", "ca"),
)(lambda ca: ca.select("customer_id", M.arpu_real(F.col("total_revenue"), F.col("months_of_service")).alias("arpu_real")))
query(
    "f25_payment_id", K.BRONZE,
    oracle=O.with_parts("""
    SELECT row_id, coalesce(given_payment, md5(given_id || '_' || payment_json)) AS payment_id
    FROM ids JOIN items ON o_custkey = c_custkey AND o_block = block WHERE has_payments AND given_id IS NOT NULL""", "raw", "items"),
)(lambda bronze: _exploded(bronze)
  .filter(F.col("customer_id").isNotNull() & (D.json_kind(F.col("payment")) == "object"))
  .select("row_id", P.payment_id(D.field_text(F.col("payment"), "payment_id"), F.col("customer_id"), F.col("payment")).alias("payment_id")))
query(
    "f26_projection", K.CUSTOMERS,
    oracle=O.with_parts("SELECT customer_id AS id, first_name || ' ' || last_name AS full_name, email FROM cust", "cust"),
)(lambda c: c.select(F.col("customer_id").alias("id"), F.concat_ws(" ", "first_name", "last_name").alias("full_name"), "email"))
