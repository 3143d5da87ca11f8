"""Silver builders and the wide table on hand-written documents."""

import datetime as dt
import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from abonados.plans import gold, silver

LOADED = "2024-01-01 00:00:00"


def bronze(spark, documents):
    """Documents, each a dict or a (dict, load time) pair, numbered in order."""
    rows = []
    for number, given in enumerate(documents, start=1):
        document, loaded = given if isinstance(given, tuple) else (given, LOADED)
        rows.append((number, json.dumps(document), loaded))
    return spark.createDataFrame(rows, "_row_id long, json string, loaded string").select(
        F.parse_json("json").alias("data"), F.col("loaded").cast("timestamp").alias("_loaded_at"), "_row_id"
    )


def person(number, **fields):
    return {"customer_id": number, "registration_date": "2023-05-06", **fields}


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_newest_document_wins(spark):
    given = bronze(spark, [
        (person(1, first_name="late"), "2024-02-01 00:00:00"), person(1, first_name="early"),
        person(2, first_name="first"), person(2, first_name="second"),
    ])
    assert rows(silver.customers(given), "customer_id", "first_name") == [(1, "late"), (2, "second")]


def test_invalid_newest_document_is_not_replaced(spark):
    payment = {"payment_id": "p", "date": "2024-01-02", "amount": 5, "status": "paid"}
    given = bronze(spark, [
        person(1, payment_history=[payment]),
        person(1, registration_date="06/05/2023", payment_history=[]),
    ])
    assert silver.customers(given).count() == 0
    assert rows(silver.payments(given), "customer_id", "payment_id") == [(1, "p")]


def test_date_that_does_not_exist(spark):
    given = bronze(spark, [person(1, registration_date="13-45-2023", payment_history=[
        {"payment_id": "p", "date": "2024-01-02", "amount": 5}])])
    assert silver.customers(given).count() == 0
    assert silver.payments(given).count() == 1  # its shape is valid


def test_newest_document_without_payments_hides_older_ones(spark):
    payment = {"payment_id": "p", "date": "2024-01-02", "amount": 5}
    for newest in ([], [{"payment_id": "q", "date": "n/a", "amount": 5}], [7, None]):
        given = bronze(spark, [person(1, payment_history=[payment]), person(1, payment_history=newest)])
        assert silver.payments(given).count() == 0
    given = bronze(spark, [person(1, payment_history=[payment]), person(1, payment_history="none"), person(1)])
    assert silver.payments(given).count() == 1  # documents without an array do not compete


def test_payments(spark):
    items = [
        {"payment_id": "a", "date": "2024-01-02T03:04:05", "amount": "10.5", "status": "paid"},
        {"payment_id": "b", "date": "01-02-2024", "amount": 1e3, "status": "declined"},
        {"payment_id": "c", "date": "2024-01-02", "amount": 0},
        {"payment_id": "d", "date": "2024-01-02", "amount": -1},
        {"payment_id": "e", "date": "2024-01-02", "amount": "unknown"},
        {"payment_id": "f", "date": "2024-01-02", "amount": ""},
        {"payment_id": "g", "date": "02/01/2024", "amount": 1},
        {"payment_id": "h", "date": "2024-01-02"},
        {"payment_id": 9, "date": "2024-01-02", "amount": "3"},
        "text", None, 4,
    ]
    given = bronze(spark, [person("7", payment_history=items), person("C-1", payment_history=items), person(None, payment_history=items)])
    assert rows(silver.payments(given), "payment_id", "customer_id", "payment_date", "payment_amount", "payment_status") == [
        ("9", 7, dt.datetime(2024, 1, 2), Decimal(3), "UNKNOWN"),
        ("a", 7, dt.datetime(2024, 1, 2, 3, 4, 5), Decimal("10.5"), "COMPLETED"),
        ("b", 7, dt.datetime(2024, 1, 2), Decimal(1000), "FAILED"),
    ]


def test_payment_hash(spark):
    one, other = {"date": "2024-01-02", "amount": 5}, {"amount": 5, "date": "2024-01-02"}
    given = bronze(spark, [person(1, payment_history=[one, other]), person(2, payment_history=[one])])
    ids = rows(silver.payments(given), "customer_id", "payment_id")
    assert ids[0] == ids[1] and ids[0][1] != ids[2][1]


def test_services(spark):
    dim = silver.dim_services(spark)
    given = bronze(spark, [
        person(1, contracted_services=["VOICE", "sms", "VOICE", "FAX", "", None], status="activo"),
        person(2, contracted_services="data, Roaming", status="x"),
        person(3, contracted_services=[]), person(4, contracted_services=""), person(5, contracted_services=None), person(6),
        person(7, contracted_services="INTERNATIONAL", registration_date="bad"),
        person(None, contracted_services="VOICE"),
    ])
    result = silver.customer_services(given, dim, F.lit("2024-03-01"))
    registered = dt.datetime(2023, 5, 6)
    assert rows(result, "customer_id", "service_id", "status", "contracted_date") == sorted([
        (1, 1, "ACTIVE", registered), (1, 2, "ACTIVE", registered), (2, 3, "UNKNOWN", registered), (2, 4, "UNKNOWN", registered),
        (7, 5, "UNKNOWN", dt.datetime(2024, 3, 1)), (9000008, 1, "UNKNOWN", registered),
    ], key=repr)


def test_surrogate_ids_agree(spark):
    given = bronze(spark, [person(None, contracted_services="VOICE"), person("x", contracted_services="SMS")])
    customers = rows(silver.customers(given), "customer_id")
    services = rows(silver.customer_services(given, silver.dim_services(spark)), "customer_id")
    assert customers == services == [(9000001,), (9000002,)]


def test_order_of_input_does_not_matter(spark):
    documents = [person(i % 7, first_name=str(i), payment_history=[{"payment_id": f"p{i}", "date": "2024-01-02", "amount": i + 1}],
                        contracted_services="VOICE") for i in range(60)]
    given = bronze(spark, documents)
    shuffled = given.repartition(5).orderBy(F.rand(3))
    for build in (silver.customers, silver.payments, lambda b: silver.customer_services(b, silver.dim_services(spark), F.lit("2024-01-01"))):
        assert rows(build(given), "*") == rows(build(shuffled), "*")


def test_one_customer_may_hold_most_documents(spark):
    random.seed(1)
    documents = [person(1 if i % 3 else i, first_name=str(i)) for i in range(3000)]
    result = dict(rows(silver.customers(bronze(spark, documents).repartition(8)), "customer_id", "first_name"))
    expected = {}
    for i in range(3000):
        expected[1 if i % 3 else i] = str(i)
    assert result == expected


def test_wide_table(spark):
    payments = [
        {"payment_id": "a", "date": "2023-06-01", "amount": 10, "status": "paid"},
        {"payment_id": "b", "date": "2023-07-01", "amount": 5, "status": "paid"},
        {"payment_id": "c", "date": "2023-08-01", "amount": 7, "status": "late"},
    ]
    given = bronze(spark, [
        person(1, payment_history=payments, contracted_services="VOICE,SMS", credit_score=600, age=30),
        person(2, monthly_bill_usd=4), person(3, monthly_bill_usd=-4),
        person(4, payment_history=[{"payment_id": "d", "date": "2023-06-01", "amount": 1, "status": "pending"}], monthly_bill_usd=4),
    ])
    dim = silver.dim_services(spark)
    table = gold.customer_analytics(
        silver.customers(given), silver.payments(given), silver.customer_services(given, dim), F.lit("2024-05-05"))
    result = {r.customer_id: r for r in table.collect()}
    one = result[1]
    assert (one.total_revenue, one.payments_count, one.avg_payment_amount) == (15, 2, Decimal("7.5"))
    assert (one.first_payment_date, one.last_payment_date) == (dt.datetime(2023, 6, 1), dt.datetime(2023, 8, 1))
    assert (one.has_payment_issues, one.has_pending_payments) == (True, False)
    assert (one.total_services_count, one.active_services_count, one.months_of_service) == (2, 2, 11)
    assert (one.arpu_estimated, one.arpu_real) == (Decimal("7.5"), 15 / 11)
    assert (one.credit_score_range, one.age_bucket) == ("FAIR (580-669)", "25-34")
    two, three, four = result[2], result[3], result[4]
    assert (two.total_revenue, two.payments_count, two.has_payment_issues, two.total_services_count, two.arpu_estimated) == (None, None, None, 0, 4)
    assert three.arpu_estimated is None
    assert (four.total_revenue, four.payments_count, four.arpu_estimated, four.has_pending_payments) == (None, 0, 4, True)
    assert table.columns == [*gold.DIMENSIONS, *gold.MEASURES]
    assert silver.customers(given).columns == list(silver.CUSTOMER_COLUMNS)
    assert [f.dataType.simpleString() for f in silver.payments(given).schema] == [
        "string", "bigint", "timestamp", "decimal(18,6)", "string", "timestamp"]


def test_service_sets(spark):
    services = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 1), (3, 5), (4, 1)], "customer_id long, service_id int")
    analytics = spark.createDataFrame(
        [(1, Decimal(10), Decimal(5)), (2, None, None), (3, Decimal(1), Decimal(1))],
        "customer_id long, total_revenue decimal(28,6), arpu_estimated decimal(32,10)")
    dim = silver.dim_services(spark)
    popular = gold.service_combinations_popularity(services, dim, analytics)
    assert rows(popular, "service_combo", "services_count", "customers", "total_revenue", "avg_arpu", "pct_customers") == [
        ("INTERNATIONAL", 1, 1, Decimal(1), Decimal(1), Decimal("33.33")),
        ("SMS,VOICE", 2, 2, Decimal(10), Decimal("2.5"), Decimal("66.67"))]
    revenue = gold.service_combo_revenue(services, dim, analytics)
    assert ("VOICE", 1, Decimal(0), Decimal(0), 1) in rows(revenue, "service_combo", "services_count", "total_revenue", "avg_arpu", "customers")
    shares = gold.services_popularity(services, dim, analytics)
    assert ("VOICE", 3, Decimal(100)) in rows(shares, "service_code", "customers", "penetration_pct")


def test_empty_tables(spark):
    nothing = bronze(spark, [person(1)]).filter("_row_id < 0")
    dim = silver.dim_services(spark)
    customers, payments, services = silver.customers(nothing), silver.payments(nothing), silver.customer_services(nothing, dim)
    table = gold.customer_analytics(customers, payments, services)
    assert table.count() == 0
    assert gold.payment_issues_pct(table).collect()[0].pct_payment_issues is None
    assert gold.revenue_stats_plan_operator(table).count() == 0
    assert gold.service_combinations_popularity(services, dim, table).count() == 0
    assert gold.services_popularity(services, dim, table).count() == 0
