"""Given ids that equal surrogates."""

import pytest
from pyspark.sql import functions as F

from abonados.operators import quality as Q
from abonados.plans import checks as K
from abonados.plans import silver
from abonados.plans.silver import customers

DOCUMENTS = [
    (1, '{"customer_id": 9000003, "first_name": "old", "registration_date": "2023-05-06"}'),
    (2, '{"customer_id": "9000003", "first_name": "given", "registration_date": "2023-05-06"}'),
    (3, '{"first_name": "surrogate", "registration_date": "2023-05-06"}'),
    (4, '{"first_name": "alone", "registration_date": "2023-05-06"}'),
    (5, '{"customer_id": 7, "first_name": "past", "registration_date": "2023-05-06"}'),
    (6, '{"customer_id": 7, "first_name": "invalid", "registration_date": "06/05/2023"}'),
]


@pytest.fixture
def found(spark):
    raw = spark.createDataFrame(DOCUMENTS, "_row_id long, j string")
    return customers(raw.select(F.parse_json("j").alias("data"), F.current_timestamp().alias("_loaded_at"), "_row_id"))


def test_no_customer_is_replaced_by_another(found):
    assert sorted((r.customer_id, r.first_name) for r in found.collect()) == [
        (9000003, "given"), (9000003, "surrogate"), (9000004, "alone")]
    assert found.columns == list(silver.CUSTOMER_COLUMNS)


def test_the_key_check_reports_the_id(found):
    assert Q.run_checks([Q.Unique(K.CUSTOMERS, columns=("customer_id",))], {K.CUSTOMERS: found}).first().failures == 1


def test_rows_are_limited_before_the_shuffle(found):
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("WindowGroupLimit") == 2
