"""Values that cleaning loses are counted in the pass that writes, and can be listed."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from abonados.plans import checks as K
from abonados.plans import job
from abonados.session import shared_dir
from abonados.sources.tables import LayerStore

GOOD = {
    "customer_id": 1, "email": "a@b.c", "registration_date": "2023-05-06", "country": "AR", "status": "activo", "age": "41",
    "credit_score": 600, "monthly_data_gb": "2.5", "monthly_bill_usd": -3, "credit_limit": "10", "latitude": 1.5,
    "last_payment_date": "", "longitude": None, "contracted_services": ["VOICE"],
    "payment_history": [{"payment_id": "a", "date": "2024-01-02", "amount": 5, "status": "paid"}],
}
BAD = {
    ("age", "shape"): "old", ("age", "conversion"): 1e30, ("age", "range"): "121",
    ("credit_score", "shape"): True, ("credit_score", "range"): -1,
    ("monthly_data_gb", "shape"): "2,5", ("monthly_data_gb", "range"): "-0.1",
    ("monthly_bill_usd", "shape"): "1e3", ("monthly_bill_usd", "conversion"): 10**12,
    ("registration_date", "shape"): "yesterday", ("registration_date", "conversion"): "13-45-2023",
    ("last_payment_date", "conversion"): "2023-02-30", ("customer_id", "conversion"): 12.5,
    ("credit_limit", "conversion"): "much", ("data_usage_current_month", "conversion"): "1,5",
    ("latitude", "conversion"): "north", ("longitude", "conversion"): 123456, ("contracted_services", "shape"): "[VOICE",
}
BAD_PAYMENTS = {
    ("payment_amount", "conversion"): {"amount": 10**12, "date": "2024-01-02"},
    ("payment_amount", "range"): {"amount": 0, "date": "2024-01-02"},
    ("payment_amount", "shape"): {"amount": "unknown", "date": "2024-01-02"},
    ("payment_date", "shape"): {"amount": 1, "date": "02/01/2024"},
    ("payment_date", "conversion"): {"amount": 1, "date": "2024-02-31"},
}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    mark = uuid.uuid4().hex[:10]
    store = LayerStore(spark, f"{shared_dir(spark)}/rejects-{mark}", f"r{mark}", sized_by=("bronze", K.BRONZE))
    rows = [GOOD] + [{**GOOD, "customer_id": 100 + i, field: value} for i, ((field, _), value) in enumerate(BAD.items())]
    rows.append({**GOOD, "customer_id": 99, "payment_history": list(BAD_PAYMENTS.values())})
    path = tmp_path_factory.mktemp("rejects") / "documents.json"
    path.write_text("\n".join(map(json.dumps, rows)))
    job.ingest(store, str(path))
    job.run_layer(store, "silver", F.lit("2024-06-01"), gate=False)
    return store


def test_every_reason_is_counted_once(store):
    found = {(r.field, r.reason): r.rejected for r in store.read("silver", job.REJECTED_VALUES).collect()}
    assert {key for key, n in found.items() if n} == {*BAD, *BAD_PAYMENTS}
    assert all(found[key] == 1 for key in {*BAD, *BAD_PAYMENTS})


def test_quarantine_lists_the_values(store):
    rows = job.quarantine(store).collect()
    assert {(r.field, r.reason) for r in rows} == {*BAD, *BAD_PAYMENTS} and len(rows) == len(BAD) + len(BAD_PAYMENTS)
    values = {(r.field, r.reason): json.loads(r.value) for r in rows}
    assert all(values[key] == value for key, value in BAD.items())
    numbers = {r._row_id for r in store.read("bronze", K.BRONZE).select("_row_id").collect()}
    assert {r._row_id for r in rows} <= numbers
    assert sorted(r.position for r in rows if r.field.startswith("payment_")) == [0, 1, 2, 3, 4]


def test_counting_keeps_results_and_pruned_scans(spark, store):
    from pyspark.sql import Observation

    from abonados.plans import silver

    raw = store.read("bronze", K.BRONZE)
    plain, counted = silver.customers(raw), silver.customers(raw, rejected=Observation())
    assert sorted(plain.collect(), key=str) == sorted(counted.collect(), key=str)
    assert "data:variant" not in counted._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_reasons_read_texts_as_the_row_does(spark):
    """A field that the row reads as text was read as a variant once more for its reason."""
    from abonados.operators import rejects as R

    document = F.col("data")
    reasons = {**R.customer_reasons(document), "payment_date": R.payment_reasons(document)["payment_date"]}
    as_text = {"registration_date", "last_payment_date", "credit_limit", "data_usage_current_month", "latitude", "longitude", "payment_date"}
    rows = spark.createDataFrame([(json.dumps(GOOD),)], "text string").select(F.parse_json("text").alias("data"))
    for field in as_text:
        found = rows.select(reasons[field].alias("reason"))
        read = found._jdf.queryExecution().analyzed().toString()
        assert "VariantType" not in read and "try_variant_get" not in read, field
        assert found.first()["reason"] is None
