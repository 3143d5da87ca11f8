"""Sources, sinks, checks and layered runs, each with its oracle."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from abonados.functions import documents as D
from abonados.operators import audit, numbering, quality
from abonados.plans import checks as K
from abonados.plans import job
from abonados.sources import bronze as B
from contract import documents as docs
from contract import oracle_parts as O
from contract.registry import add, comparable, query
from contract.store import layer_store, scratch_store, table, tables

AS_OF = docs.AS_OF
ALL_STORED = (K.BRONZE, K.CUSTOMERS, K.PAYMENTS, K.SERVICES, K.DIM_SERVICES, K.ANALYTICS)
#: Documents of an array file, about: each file costs its creation, whatever it holds.
DOCUMENTS_PER_ARRAY_FILE = 20_000


def _copies_follow(raw: DataFrame) -> bool:
    """Whether copies of one document are read one after the other, by one task, as they lie.

    Row numbers and places alone are read. Copies have the row numbers 2n - 1 and 2n.
    """
    at = F.monotonically_increasing_id()
    placed = raw.select(F.expr("(_row_id - 1) DIV 2").alias("pair"), F.expr("_row_id % 2 = 1").alias("older"), at.alias("at"))
    pairs = placed.groupBy("pair").agg(
        F.max(F.when(F.col("older"), F.col("at"))).alias("first"), F.min(F.when(~F.col("older"), F.col("at"))).alias("then"))
    # the upper bits of a place are the task's
    apart = (F.col("first") > F.col("then")) | (F.shiftright("first", 33) != F.shiftright("then", 33))
    return pairs.filter(apart).isEmpty()


def _write_lines(raw: DataFrame, path: str) -> None:
    """The documents as JSON lines; copies of one document follow each other.

    Documents travel only if copies lie apart. A text is several times its gzip.
    """
    if not _copies_follow(raw):
        raw = raw.repartition(F.expr("(_row_id - 1) DIV 2")).sortWithinPartitions("_row_id")
    raw.select(F.to_json("data").alias("value")).write.option("compression", "gzip").text(path)


def _write_arrays(raw: DataFrame, path: str) -> None:
    """The documents in files of one JSON array each, a line for each document.

    There are as many files as documents need, however sparse their row numbers are. Lines
    are made after the shuffle and written one by one, no array is held in memory.
    """
    files = max(1, math.ceil(raw.count() / DOCUMENTS_PER_ARRAY_FILE))
    rows = raw.select(F.pmod(F.hash("_row_id"), F.lit(files)).alias("block"), "_row_id", "data")
    within = Window.partitionBy("block").orderBy("_row_id")
    begin = F.when(F.lag("_row_id").over(within).isNull(), "[").otherwise(",")
    end = F.when(F.lead("_row_id").over(within).isNull(), "]").otherwise("")
    marked = rows.withColumns({"begin": begin, "end": end})
    lines = marked.select("block", F.concat("begin", F.to_json("data"), "end").alias("value"))
    lines.write.partitionBy("block").text(path)


def _read_back(write, read):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{scratch_store(spark).root}/documents"
        write(table(spark, sf_dir, K.BRONZE), path)
        operator = D.field_text(F.col("data"), "operator")
        return (
            B.as_bronze(read(spark, path))
            .groupBy(operator.alias("operator"), D.field_kind(F.col("data"), "age").alias("age_kind"))
            .agg(
                F.count("*").alias("documents"),
                F.count_distinct("_row_id").alias("numbers"),
                F.count_distinct("_loaded_at").alias("loads"),
            )
        )

    return run


_READ_BACK = O.with_parts("""
    SELECT operator, CASE WHEN age IS NULL THEN NULL WHEN n % 2 = 0 AND TRY_CAST(age AS DOUBLE) IS NOT NULL THEN 'number' ELSE 'string' END AS age_kind,
      count(*) AS documents, count(DISTINCT row_id) AS numbers, 1::BIGINT AS loads FROM ids GROUP BY ALL""", "raw")
add("i1_json_lines", _read_back(_write_lines, B.read_lines), _READ_BACK)
add("i1_json_array_files", _read_back(_write_arrays, B.read_arrays), _READ_BACK)


def _guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty load leaves the stored documents in place."""
    store, raw = scratch_store(spark), table(spark, sf_dir, K.BRONZE)
    first = store.replace_unless_empty("bronze", K.BRONZE, raw)
    second = store.replace_unless_empty("bronze", K.BRONZE, raw.filter(F.col("_loaded_at").isNull()))
    return store.read("bronze", K.BRONZE).agg(
        F.count("*").alias("documents"), F.lit(first).alias("first_load"), F.lit(second).alias("empty_load"))


add("i2_empty_input_guard", _guarded,
    O.with_parts("SELECT count(*) AS documents, true AS first_load, false AS empty_load FROM ids", "raw"))


def _serialised(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, K.BRONZE).select("_row_id", F.to_json("data").alias("document"))
    again = texts.select(F.col("_row_id").alias("row_id"), F.parse_json("document").alias("data"))
    return again.select("row_id", D.field_text(F.col("data"), "record_uuid").alias("record_uuid"))


add("i3_one_document_per_row", _serialised, O.with_parts("SELECT row_id, record_uuid FROM ids", "raw"))


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load replaces the first as a whole; the replaced one can be dropped."""
    store, customers = scratch_store(spark), table(spark, sf_dir, K.CUSTOMERS)
    store.write("silver", K.CUSTOMERS, customers.filter("customer_status = 'ACTIVE'"))
    store.write("silver", K.CUSTOMERS, customers, bucket_by="customer_id")
    dropped = len(store.drop_replaced("silver", K.CUSTOMERS))
    return (
        store.read("silver", K.CUSTOMERS).groupBy("customer_status")
        .agg(F.count("*").alias("customers"), F.lit(dropped).cast("bigint").alias("dropped_loads"))
    )


add("i4_full_refresh", _refreshed, O.with_parts(
    "SELECT customer_status, count(*) AS customers, 1::BIGINT AS dropped_loads FROM cust GROUP BY 1", "cust"))


def _numbered(raw: DataFrame) -> DataFrame:
    return B.as_bronze(raw.select("data"), F.lit(docs.LOADED_AT).cast("timestamp")).agg(
        F.count("*").alias("documents"), F.count_distinct("_row_id").alias("numbers"), F.min("_row_id").alias("least"),
        F.min("_loaded_at").alias("earliest"), F.max("_loaded_at").alias("latest"))


query("i5_load_metadata", K.BRONZE, oracle=O.with_parts(
    f"""SELECT count(*) AS documents, count(*) AS numbers, 1::BIGINT AS least, '{docs.LOADED_AT}' AS earliest, '{docs.LOADED_AT}' AS latest FROM ids""",
    "raw"))(_numbered)
query("i7_bronze_scan", K.BRONZE, oracle=O.with_parts(
    f"SELECT row_id, {O.text_of('loaded_at')} AS loaded_at FROM ids", "raw"),
)(lambda b: b.select(F.col("_row_id").alias("row_id"), F.col("_loaded_at").alias("loaded_at")))


def _by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored models read by their names in the catalog."""
    tables(spark, sf_dir, K.SERVICES, K.DIM_SERVICES)
    store = layer_store(spark, sf_dir)
    return spark.sql(
        f"""SELECT d.service_code, s.status, count(*) AS customers
        FROM {store.name('silver', K.SERVICES)} s JOIN {store.name('silver', K.DIM_SERVICES)} d ON s.service_id = d.service_id
        GROUP BY d.service_code, s.status""")


add("i8_model_scan_by_name", _by_name,
    O.with_parts("SELECT service_code, status, count(*) AS customers FROM svc GROUP BY ALL", "svc"))


def _views(tag: str):
    """Views of one tag, registered by name and counted through SQL."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        given = tables(spark, sf_dir, *ALL_STORED)
        names = [model.name for model in job.select_models(tag) if model.view]
        for name in names:
            job.MODELS[name].apply(given).createOrReplaceTempView(name)
        parts = [f"SELECT '{name}' AS name, count(*) AS rows FROM {name}" for name in names]
        return spark.sql(" UNION ALL ".join(parts))

    return run


add("i11_views_by_name", _views("distribution"), O.with_parts("""
    SELECT 'customers_by_geo' AS name, count(*) AS rows FROM (SELECT DISTINCT country, city FROM ca)
    UNION ALL SELECT 'customers_by_operator', count(*) FROM (SELECT DISTINCT operator FROM ca)""", "ca"))
add("i12_models_by_tag", _views("device"), O.with_parts("""
    SELECT 'device_brand_by_country_operator' AS name, count(*) AS rows FROM (SELECT DISTINCT country, operator, device_brand FROM ca WHERE device_brand <> 'Unknown')
    UNION ALL SELECT 'device_brand_by_plan_type', count(*) FROM (SELECT DISTINCT plan_type, device_brand FROM ca WHERE device_brand <> 'Unknown')
    UNION ALL SELECT 'device_brand_popularity', count(*) FROM (SELECT DISTINCT device_brand FROM ca WHERE device_brand <> 'Unknown')""", "ca"))

# --- quality ----------------------------------------------------------------------------


def _counted(table_name: str, check: str, sql: str, severity: str = "error") -> str:
    return f"SELECT '{table_name}' AS table_name, '{check}' AS check_name, '{severity}' AS severity, ({sql}) AS failures"


def _n(table_sql: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table_sql} WHERE {condition}"


_STATUS_LIST = "('ACTIVE', 'INACTIVE', 'SUSPENDED', 'UNKNOWN')"
_COUNTRY_LIST = "('Argentina', 'México', 'Colombia', 'Perú', 'Chile', 'Desconocido')"


def _twice(table_sql: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {table_sql} GROUP BY {key} HAVING count(*) > 1)"


def _orphans(table_sql: str) -> str:
    return _n(table_sql, "customer_id NOT IN (SELECT customer_id FROM cust)")


_EXPECTED = {
    (K.CUSTOMERS, "not_null_customer_id"): _n("cust", "customer_id IS NULL"),
    (K.CUSTOMERS, "unique_customer_id"): _twice("cust", "customer_id"),
    (K.CUSTOMERS, "not_null_email"): _n("cust", "email IS NULL"),
    (K.CUSTOMERS, "accepted_range_age"): _n("cust", "age < 0 OR age > 120"),
    (K.CUSTOMERS, "not_null_country"): _n("cust", "country IS NULL"),
    (K.CUSTOMERS, "accepted_values_country"): _n("cust", f"country NOT IN {_COUNTRY_LIST}"),
    (K.CUSTOMERS, "accepted_values_customer_status"): _n("cust", f"customer_status NOT IN {_STATUS_LIST}"),
    (K.CUSTOMERS, "accepted_range_credit_score"): _n("cust", "credit_score < 0"),
    (K.CUSTOMERS, "accepted_range_monthly_data_gb"): _n("cust", "monthly_data_gb < 0"),
    (K.PAYMENTS, "not_null_payment_id"): _n("pay", "payment_id IS NULL"),
    (K.PAYMENTS, "unique_payment_id"): _twice("pay", "payment_id"),
    (K.PAYMENTS, "not_null_customer_id"): _n("pay", "customer_id IS NULL"),
    (K.PAYMENTS, "relationships_customer_id_" + K.CUSTOMERS): _orphans("pay"),
    (K.PAYMENTS, "not_null_payment_date"): _n("pay", "payment_date IS NULL"),
    (K.PAYMENTS, "not_null_payment_amount"): _n("pay", "payment_amount IS NULL"),
    (K.PAYMENTS, "accepted_range_payment_amount"): _n("pay", "payment_amount <= 0"),
    (K.PAYMENTS, "accepted_values_payment_status"): _n("pay", "payment_status NOT IN ('COMPLETED', 'PENDING', 'FAILED', 'LATE')"),
    (K.SERVICES, "not_null_customer_id"): _n("svc", "customer_id IS NULL"),
    (K.SERVICES, "relationships_customer_id_" + K.CUSTOMERS): _orphans("svc"),
    (K.SERVICES, "not_null_service_id"): _n("svc", "service_id IS NULL"),
    (K.SERVICES, "accepted_values_status"): _n("svc", f"status NOT IN {_STATUS_LIST}"),
    (K.SERVICES, "not_null_contracted_date"): _n("svc", "contracted_date IS NULL"),
}
_KEYS = {
    (K.CUSTOMERS, "unique_customer_id"): _twice("cust", "customer_id"),
    (K.CUSTOMERS, "not_null_customer_id"): _n("cust", "customer_id IS NULL"),
    (K.PAYMENTS, "unique_payment_id"): _twice("pay", "payment_id"),
    (K.PAYMENTS, "not_null_payment_id"): _n("pay", "payment_id IS NULL"),
    (K.SERVICES, "unique_customer_id_service_id"): _twice("svc", "customer_id, service_id"),
    (K.SERVICES, "not_null_customer_id"): _n("svc", "customer_id IS NULL"),
    (K.SERVICES, "not_null_service_id"): _n("svc", "service_id IS NULL"),
    (K.DIM_SERVICES, "unique_service_id"): _twice("dim", "service_id"),
    (K.DIM_SERVICES, "not_null_service_id"): _n("dim", "service_id IS NULL"),
}
_INTEGRITY = "SELECT customer_id FROM svc GROUP BY 1 HAVING NOT bool_or(status = 'ACTIVE')"
_UNLISTED = """SELECT upper(trim(token)) AS service_code, count(*) AS mentions FROM svc_tok WHERE trim(token) <> ''
    AND upper(trim(token)) NOT IN (SELECT service_code FROM dim) GROUP BY 1"""
_UNPAID = """SELECT customer_id FROM cust WHERE customer_id IN (SELECT given_id FROM ids WHERE has_payments AND given_id IS NOT NULL)
    AND customer_id NOT IN (SELECT customer_id FROM pay)"""
_DESCRIBED = {
    (K.SERVICES, "customer_services_integrity"): f"SELECT count(*) FROM ({_INTEGRITY})",
    (K.BRONZE, "services_completeness"): f"SELECT count(*) FROM ({_UNLISTED})",
    (K.CUSTOMERS, "payment_history_completeness"): f"SELECT count(*) FROM ({_UNPAID})",
}
_GOLD = {
    (K.ANALYTICS, "not_null_customer_id"): _n("ca", "customer_id IS NULL"),
    (K.ANALYTICS, "unique_customer_id"): _twice("ca", "customer_id"),
    (K.ANALYTICS, "accepted_range_total_revenue"): _n("ca", "total_revenue < 0"),
    (K.ANALYTICS, "accepted_range_arpu_real"): _n("ca", "arpu_real < 0"),
}


def _expect(expected: dict, select=lambda check: True) -> str:
    warned = ("relationships_", "customer_services_", "services_completeness", "payment_history_")
    return O.with_parts(" UNION ALL ".join(
        _counted(t, check, sql, "warn" if check.startswith(warned) else "error")
        for (t, check), sql in expected.items() if select(check)), "ca")


def _checks(name: str, checks: list, expected: dict, select=lambda check: True) -> None:
    chosen = [check for check in checks if select(check.name)]
    add(name,
        lambda spark, sf_dir: comparable(quality.run_checks(chosen, tables(spark, sf_dir, *ALL_STORED))),
        _expect(expected, select))


_DECLARED = K.SILVER_CHECKS + K.GOLD_CHECKS
_ALL_DECLARED = {**_EXPECTED, **_GOLD}
_checks("q1_not_null", _DECLARED, _ALL_DECLARED, lambda check: check.startswith("not_null"))
_checks("q2_unique", _DECLARED, _ALL_DECLARED, lambda check: check.startswith("unique"))
_checks("q3_accepted_values", _DECLARED, _ALL_DECLARED, lambda check: check.startswith("accepted_values"))
_checks("q4_accepted_range", _DECLARED, _ALL_DECLARED, lambda check: check.startswith("accepted_range"))
_checks("q5_relationships", _DECLARED, _ALL_DECLARED, lambda check: check.startswith("relationships"))
_checks("q6_primary_keys", K.KEY_CHECKS, _KEYS)
_checks("q9_described_checks", K.DESCRIBED_CHECKS, _DESCRIBED)

query("q5_orphaned_services", K.SERVICES, K.CUSTOMERS, oracle=O.with_parts(
    "SELECT customer_id, service_id FROM svc WHERE customer_id NOT IN (SELECT customer_id FROM cust)", "svc", "cust"),
)(lambda s, c: quality.Relationship(K.SERVICES, column="customer_id", parent=K.CUSTOMERS, parent_column="customer_id")
  .violations({K.SERVICES: s, K.CUSTOMERS: c}).select("customer_id", "service_id"))


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    check = quality.RowsMatching("events", label="value_validity", condition="event_type = 'view' AND (value < 0 OR value > 30)")
    return check.violations({"events": events}).select("event_id", "user_id", "value")


add("q7_rows_are_violations", _event_rows,
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'view' AND (value < 0 OR value > 30)")
query("q8_drop_orphans", K.PAYMENTS, K.CUSTOMERS, oracle=O.with_parts(
    "SELECT payment_id FROM pay WHERE customer_id IN (SELECT customer_id FROM cust)", "pay", "cust"),
)(lambda p, c: quality.drop_orphans(p, c, "customer_id").select("payment_id"))


def _cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored payments after suspended customers and, by cascade, their payments are deleted."""
    store = scratch_store(spark)
    store.buckets = layer_store(spark, sf_dir).bucket_count()
    given = tables(spark, sf_dir, K.CUSTOMERS, K.PAYMENTS)
    for name, frame in given.items():
        frame = frame.filter("customer_status <> 'SUSPENDED'") if name == K.CUSTOMERS else frame
        store.write("silver", name, frame, "customer_id", gather=True, sliced=name == K.PAYMENTS)
    job.cascade(store)
    return comparable(store.read("silver", K.PAYMENTS).select("payment_id", "customer_id", "payment_date", "payment_amount"))


add("q8_cascade", _cascade, O.with_parts(f"""
    SELECT payment_id, customer_id, {O.text_of('payment_date')} AS payment_date, CAST(payment_amount AS DOUBLE) AS payment_amount FROM pay
    WHERE customer_id IN (SELECT customer_id FROM cust WHERE customer_status <> 'SUSPENDED')""", "pay", "cust"))
query("q9_customers_without_active_service", K.SERVICES, oracle=O.with_parts(_INTEGRITY, "svc"),
      )(lambda s: K.ServicesIntegrity().violations({K.SERVICES: s}).select("customer_id"))
query("q9_unlisted_services", K.BRONZE, K.DIM_SERVICES, oracle=O.with_parts(_UNLISTED, "svc"),
      )(lambda b, dim: K.ServicesCompleteness().violations({K.BRONZE: b, K.DIM_SERVICES: dim}))
query("q9_customers_without_payment", K.BRONZE, K.CUSTOMERS, K.PAYMENTS, oracle=O.with_parts(_UNPAID, "cust", "pay"),
      )(lambda b, c, p: K.PaymentHistoryCompleteness().violations({K.BRONZE: b, K.CUSTOMERS: c, K.PAYMENTS: p}))
query("q10_layer_counts", *ALL_STORED, oracle=O.with_parts(f"""
    SELECT '{K.BRONZE}' AS layer, count(*) AS rows FROM ids UNION ALL SELECT '{K.CUSTOMERS}', count(*) FROM cust
    UNION ALL SELECT '{K.PAYMENTS}', count(*) FROM pay UNION ALL SELECT '{K.SERVICES}', count(*) FROM svc
    UNION ALL SELECT '{K.DIM_SERVICES}', count(*) FROM dim UNION ALL SELECT '{K.ANALYTICS}', count(*) FROM ca""", "ca"),
      )(lambda *given: audit.row_counts(dict(zip(ALL_STORED, given))))
query("q11_freshness", K.BRONZE, oracle=O.with_parts(f"""
    SELECT {O.text_of('max(loaded_at)')} AS newest, date_diff('second', max(loaded_at), TIMESTAMP '2024-01-02 12:00:00') / 3600.0 AS age_hours,
      'warn' AS state FROM ids""", "raw"),
      )(lambda b: audit.freshness(b, F.lit("2024-01-02 12:00:00"), 24, 48))
_LOST = {
    "customer_id": "false",
    "registration_date": f"{O.dated('registered')} AND ({O.timestamp('registered')}) IS NULL",
    "last_payment_date": f"{O.dated('last_paid')} AND ({O.timestamp('last_paid')}) IS NULL",
    "credit_limit": "credit_limit IS NOT NULL AND TRY_CAST(credit_limit AS DECIMAL(18,6)) IS NULL",
    "data_usage_current_month": "TRY_CAST(usage AS DECIMAL(18,6)) IS NULL",
    "latitude": "TRY_CAST(latitude AS DECIMAL(12,8)) IS NULL",
    "longitude": "TRY_CAST(longitude AS DECIMAL(12,8)) IS NULL",
}
query("q12_rejected_values", K.BRONZE, oracle=O.with_parts(" UNION ALL ".join(
    f"SELECT '{field}' AS field, count(*) FILTER (WHERE {test}) AS rejected FROM ids" for field, test in _LOST.items()), "raw"),
      )(audit.rejected_values)


def _layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines to gold in a store of its own; the results of all checks.

    All documents come in one load here, so the row number alone decides between
    copies; the oracle leaves the load time out of its order too.
    """
    store = scratch_store(spark)
    path = f"{store.root}/documents"
    _write_lines(table(spark, sf_dir, K.BRONZE), path)
    results = job.run(store, path, as_of=F.lit(AS_OF), gate=False)
    return comparable(results["silver"].unionByName(results["gold"]))


_ONE_LOAD = _expect({**_EXPECTED, **_KEYS, **_DESCRIBED, **_GOLD}).replace("loaded_at DESC, ", "")
add("i13_layered_run", _layered_run, _ONE_LOAD)


def _dense(raw: DataFrame) -> DataFrame:
    """Documents numbered without gaps, the newest load first."""
    rows = raw.select(F.col("_row_id").alias("row_id"), "_loaded_at")
    return numbering.dense_numbers(rows, [F.col("_loaded_at").desc_nulls_first(), F.col("row_id")]).select("row_id", "number")


query("w3_dense_numbers", K.BRONZE, oracle=O.with_parts(
    "SELECT row_id, row_number() OVER (ORDER BY loaded_at DESC NULLS FIRST, row_id) AS number FROM ids", "raw"))(_dense)
