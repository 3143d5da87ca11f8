"""Reading, storing, checking and running the layers."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from abonados.operators import audit
from abonados.operators import quality as Q
from abonados.plans import checks as K
from abonados.plans import job
from abonados.session import shared_dir
from abonados.sources import bronze as B
from abonados.sources.tables import LayerStore


@pytest.fixture
def store(spark):
    mark = uuid.uuid4().hex[:10]
    return LayerStore(spark, f"{shared_dir(spark)}/test-{mark}", f"t{mark}", sized_by=("bronze", K.BRONZE))


DOCUMENTS = [
    {"customer_id": 1, "email": "a@b.c", "registration_date": "2023-05-06", "country": "AR", "status": "activo",
     "contracted_services": ["VOICE"], "payment_history": [{"payment_id": "a", "date": "2024-01-02", "amount": 5, "status": "paid"}]},
    {"customer_id": 2, "email": "d@e.f", "registration_date": "05-06-2023", "country": "x", "status": "suspended", "contracted_services": "SMS"},
]


def written(tmp_path, documents, layout="lines"):
    path = tmp_path / f"{uuid.uuid4().hex}.json"
    text = "\n".join(map(json.dumps, documents)) if layout == "lines" else json.dumps(documents, indent=1)
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("layout, read", [("lines", B.read_lines), ("arrays", B.read_arrays)])
def test_both_layouts_read_the_same(spark, tmp_path, layout, read):
    path = written(tmp_path, DOCUMENTS, layout)
    loaded = B.as_bronze(read(spark, path))
    found = {r._row_id: json.loads(r.j) for r in loaded.select("_row_id", F.to_json("data").alias("j")).collect()}
    assert found == {1: DOCUMENTS[0], 2: DOCUMENTS[1]}


def test_several_array_files(spark, tmp_path):
    paths = [written(tmp_path, [{"k": i}, {"k": i + 10}], "arrays") for i in range(3)]
    loaded = B.as_bronze(B.read_arrays(spark, paths))
    assert loaded.count() == 6 and loaded.select("_row_id").distinct().count() == 6


def test_malformed_lines(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"k":1}\n{broken\n{"k":2}\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        B.read_lines(spark, str(path)).collect()
    assert B.read_lines(spark, str(path), "DROPMALFORMED").count() == 2
    assert B.read_lines(spark, str(path), "PERMISSIVE").filter("data IS NULL").count() == 1


def test_empty_source_keeps_the_old_load(store, tmp_path):
    assert job.ingest(store, written(tmp_path, DOCUMENTS))
    assert not job.ingest(store, written(tmp_path, []))
    assert not job.ingest(store, written(tmp_path, [], "arrays"), "arrays")
    assert store.read("bronze", K.BRONZE).count() == 2


def test_failed_load_keeps_the_old_one(store, tmp_path):
    job.ingest(store, written(tmp_path, DOCUMENTS))
    bad = tmp_path / "bad.json"
    bad.write_text('{"k":1}\n' * 100 + "{broken\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE|abort"):
        job.ingest(store, str(bad))
    assert store.read("bronze", K.BRONZE).count() == 2


def test_refresh_replaces_and_old_loads_can_be_dropped(spark, store):
    store.write("silver", "t", spark.range(5))
    store.write("silver", "t", spark.range(3), bucket_by="id", gather=True)
    assert store.read("silver", "t").count() == 3
    assert len(store.loads("silver", "t")) == 2
    assert len(store.drop_replaced("silver", "t")) == 1
    assert len(store.loads("silver", "t")) == 1 and store.read("silver", "t").count() == 3


def test_run_from_lines_to_gold(store, tmp_path):
    results = job.run(store, written(tmp_path, DOCUMENTS), as_of=F.lit("2024-06-01"))
    assert results["silver"].filter("severity = 'error' AND failures > 0").count() == 0
    table = store.read("gold", K.ANALYTICS)
    assert {r.customer_id: r.total_revenue for r in table.collect()} == {1: 5, 2: None}
    popular = store.spark.sql("SELECT * FROM services_popularity")
    assert {r.service_code: r.customers for r in popular.collect()} == {"VOICE": 1, "SMS": 1}
    warned = results["silver"].filter("check_name = 'customer_services_integrity'").first()
    assert (warned.severity, warned.failures) == ("warn", 1)


def test_gate_stops_before_gold(store, tmp_path):
    broken = [{**DOCUMENTS[0], "email": None}]
    with pytest.raises(Q.QualityError, match="not_null_email: 1"):
        job.run(store, written(tmp_path, broken))
    assert not store.exists("gold", K.ANALYTICS)


def test_unknown_payment_status_fails_the_gate(store, tmp_path):
    odd = [{**DOCUMENTS[0], "payment_history": [{"payment_id": "a", "date": "2024-01-02", "amount": 5, "status": "?"}]}]
    with pytest.raises(Q.QualityError, match="accepted_values_payment_status: 1"):
        job.run(store, written(tmp_path, odd))


def test_equal_payments_break_the_key(store, tmp_path):
    twice = [{**DOCUMENTS[0], "payment_history": [{"date": "2024-01-02", "amount": 5, "status": "paid"}] * 2}]
    with pytest.raises(Q.QualityError, match="unique_payment_id: 1"):
        job.run(store, written(tmp_path, twice))


def test_strict_runs_raise_where_others_give_null(store, tmp_path):
    path = written(tmp_path, [DOCUMENTS[0], {**DOCUMENTS[1], "credit_limit": "bad"}])
    job.run(store, path)
    assert store.read("silver", K.CUSTOMERS).filter("credit_limit IS NULL").count() == 2
    with pytest.raises(Exception, match="(?i)CAST_INVALID_INPUT"):
        job.run(store, path, strict=True)
    assert store.read("silver", K.CUSTOMERS).count() == 2


def test_models_and_tags():
    assert len([m for m in job.MODELS.values() if m.view]) == 20
    assert [m.name for m in job.select_models("silver")] == [K.CUSTOMERS, K.PAYMENTS, K.DIM_SERVICES, K.SERVICES]
    assert job.select_models("gold")[0].name == K.ANALYTICS and len(job.select_models("gold")) == 21
    assert {m.name for m in job.select_models("arpu")} == {"arpu_by_plan_type"}
    for model in job.MODELS.values():
        earlier = list(job.MODELS)[: list(job.MODELS).index(model.name)]
        assert all(name == K.BRONZE or name in earlier for name in model.inputs)


CHECKED = [(1, "a", 5, 10), (2, None, -1, 20), (2, "b", 120, 30), (None, "z", 121, None)]


@pytest.mark.parametrize("check, violations", [
    (Q.NotNull("t", column="s"), 1),
    (Q.AcceptedValues("t", column="s", values=("a", "b")), 1),
    (Q.AcceptedRange("t", column="n", min_value=0, max_value=120), 2),
    (Q.AcceptedRange("t", column="n", min_value=-1, max_value=121, inclusive=False), 2),
    (Q.AcceptedRange("t", column="m", min_value=20), 1),
    (Q.RowsMatching("t", label="odd", condition="s = 'b' AND n > 100"), 1),
    (Q.Unique("t", columns=("k",)), 1),
    (Q.Unique("t", columns=("k", "s")), 0),
    (Q.Relationship("t", column="k", parent="p", parent_column="id"), 2),
], ids=lambda v: getattr(v, "name", None))
def test_checks(spark, check, violations):
    tables = {"t": spark.createDataFrame(CHECKED, "k int, s string, n int, m int"), "p": spark.createDataFrame([(1,)], "id int")}
    assert check.violations(tables).count() == violations
    assert check.failures(tables).first().failures == violations
    assert Q.run_checks([check], tables).first().failures == violations


def test_enforce_lets_warnings_pass(spark):
    tables = {"t": spark.createDataFrame(CHECKED, "k int, s string, n int, m int")}
    Q.enforce(Q.run_checks([Q.NotNull("t", Q.WARN, column="s")], tables))
    with pytest.raises(Q.QualityError):
        Q.enforce(Q.run_checks([Q.NotNull("t", column="s")], tables))


def test_audit(spark):
    table = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS _loaded_at")
    for now, state in (("2024-01-01 10:00:00", "pass"), ("2024-01-02 10:00:00", "warn"), ("2024-01-05 00:00:00", "error")):
        assert audit.freshness(table, F.lit(now), 24, 48).first().state == state
    assert audit.freshness(table.filter("false"), F.lit("2024-01-01"), 24, 48).first().state == "error"
    odd = spark.createDataFrame([('{"customer_id":1.5,"latitude":"x","registration_date":"2023-02-30"}',)], "j string")
    lost = audit.rejected_values(odd.select(F.parse_json("j").alias("data")))
    assert {r.field for r in lost.filter("rejected = 1").collect()} == {"customer_id", "latitude", "registration_date"}


def test_row_checks_are_counted_while_rows_are_written(spark, store, tmp_path):
    """Nothing is read again for them, and results equal those of a scan."""
    broken = [{**DOCUMENTS[0], "customer_id": 5, "email": None, "payment_history": [{"payment_id": "z", "date": "2024-01-01", "amount": 3, "status": "odd"}]}]
    job.ingest(store, written(tmp_path, [*DOCUMENTS, *broken]))
    results = job.run_layer(store, "silver", F.lit("2024-06-01"), gate=False)
    tables = job.stored_tables(store)
    checks = K.SILVER_CHECKS + K.KEY_CHECKS + K.DESCRIBED_CHECKS
    scanned = Q.run_checks(checks, tables)
    assert sorted(results.collect()) == sorted(scanned.collect())
    assert results.filter("check_name = 'not_null_email'").first().failures == 1
    assert results.filter("check_name = 'accepted_values_payment_status'").first().failures == 1
    counts = {m.name: store.counts("silver", m.name) for m in job.select_models("silver")}
    rows_only = [c for c in checks if isinstance(c, Q.RowCheck)]
    counted = Q.run_checks(rows_only, tables, counts)
    assert "FileScan" not in counted._jdf.queryExecution().toString()
    with pytest.raises(Q.QualityError, match="payment_status"):
        job.run_layer(store, "silver", F.lit("2024-06-01"))
    assert store.read("silver", job.CHECK_RESULTS).count() == results.count()
