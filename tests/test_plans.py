"""Physical plans stay distributed, pruned and on the JVM."""

import contextlib
import io
import re

import pytest

from abonados.plans import checks as K
from contract.catalogue import ORACLES, QUERIES
from contract.store import table

SF = "/root/testdata/sf0.001"
# Keyless aggregates and windows over aggregated rows end in one partition by nature.
MAY_GATHER = {"g7_customer_status_distribution", "g15_payment_issues_pct", "g18_service_combinations_popularity",
              "g20_services_popularity"}
BUILDERS = ["b1_customers", "b2_payments", "b3_customer_services", *[n for n in QUERIES if re.match(r"g\d", n)]]


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", BUILDERS)
def test_plans_of_layers(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text)
    if name not in MAY_GATHER:
        assert "SinglePartition" not in text


def test_wide_table_needs_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(QUERIES["g0_customer_analytics"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_deduplication_is_limited_before_the_shuffle(spark):
    for name in ("b1_customers", "b2_payments", "b3_customer_services"):
        text = plan(QUERIES[name](spark, SF))
        assert text.count("WindowGroupLimit") == 2, name


def test_documents_are_read_field_by_field(spark):
    raw = table(spark, SF, K.BRONZE)
    from pyspark.sql import functions as F

    from abonados.functions import documents as D

    text = plan(raw.select(D.field_text(F.col("data"), "city"), D.field_text(F.col("data"), "country")))
    assert re.search(r"ReadSchema: struct<data:struct<0:string,1:string>>", text)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["g4_arpu_by_plan_type"](spark, SF))
    assert "PushedFilters: [IsNotNull(arpu_estimated)]" in text
    assert re.search(r"ReadSchema: struct<plan_type:string,arpu_estimated:decimal\(32,10\)>", text)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
