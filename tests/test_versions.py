"""Tables of a layer become current together; views are stored and outlive the session."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from abonados.operators import quality as Q
from abonados.plans import checks as K
from abonados.plans import job, views
from abonados.sources.tables import LayerStore
from contract import store as S
from test_plans import SF


@pytest.fixture
def store(spark, tmp_path):
    mark = uuid.uuid4().hex[:10]
    return LayerStore(spark, str(tmp_path / "layers"), f"v{mark}", sized_by=("bronze", K.BRONZE))


def rows(frame):
    return sorted(map(repr, frame.collect()))


def test_failure_between_two_tables_leaves_the_layer_whole(spark, store):
    with store.publishing("silver"):
        store.write("silver", "a", spark.range(1))
        store.write("silver", "b", spark.range(1))
    with pytest.raises(RuntimeError), store.publishing("silver"):
        assert store.write("silver", "a", spark.range(2)).count() == 2
        assert store.read("silver", "a").count() == 2  # the block reads what it wrote
        assert LayerStore(spark, store.root, store.prefix).read("silver", "a").count() == 1
        raise RuntimeError
    assert [store.read("silver", t).count() for t in "ab"] == [1, 1]
    assert [spark.table(store.name("silver", t)).count() for t in "ab"] == [1, 1]
    assert store.versions("silver").numbers() == [1]


def test_views_follow_a_version_that_was_committed(spark, store, monkeypatch):
    store.write("silver", "a", spark.range(1))
    with monkeypatch.context() as broken:
        broken.setattr(LayerStore, "follow_version", lambda *_: None)  # the writer ends here
        store.write("silver", "a", spark.range(2))
    assert store.read("silver", "a").count() == 2
    assert spark.table(store.name("silver", "a")).count() == 1
    store.write("silver", "b", spark.range(1))
    assert spark.table(store.name("silver", "a")).count() == 2


def test_versions_of_two_writers_and_torn_ones(spark, store):
    store.write("silver", "a", spark.range(1))
    versions = store.versions("silver")
    with open(f"{store.root}/silver/_versions/0000000002.json", "w") as torn:
        torn.write('{"a": ')
    assert store.read("silver", "a").count() == 1
    other = LayerStore(spark, store.root, store.prefix)
    with store.publishing("silver"):
        store.write("silver", "a", spark.range(2))
        other.write("silver", "b", spark.range(7))
    assert versions.numbers() == [1, 2, 3, 4]
    assert (store.read("silver", "a").count(), store.read("silver", "b").count()) == (2, 7)
    assert store.read("silver", "a", version=1).count() == 1


def test_replaced_and_failed_loads_vanish(spark, store):
    for n in (1, 2, 3):
        store.write("silver", "a", spark.range(n))
    with pytest.raises(Exception, match="(?i)odd"):
        store.write("silver", "a", spark.range(9).select(F.raise_error(F.lit("odd")).alias("id")))
    with pytest.raises(RuntimeError), store.publishing("silver"):
        store.write("silver", "a", spark.range(4))
        raise RuntimeError

    def folders():
        return [f for f in os.listdir(f"{store.root}/silver") if f.startswith("a__")]

    assert store.remove_replaced("silver") == [] and len(folders()) >= 4  # all are recent
    assert store.versions("silver").numbers() == [1, 2, 3]
    store.remove_replaced("silver", keep=2, older_than=-60)
    assert len(folders()) == 2 and store.read("silver", "a", version=2).count() == 2
    store.remove_replaced("silver", older_than=-60)
    assert folders() == store.loads("silver", "a") == [store.current_load("silver", "a")]
    assert store.read("silver", "a").count() == 3 and store.versions("silver").numbers() == [3]


DOCUMENT = {"customer_id": 1, "email": "a@b.c", "registration_date": "2023-05-06", "contracted_services": ["VOICE"],
            "payment_history": [{"payment_id": "a", "date": "2024-01-02", "amount": 5, "status": "paid"}]}


def loaded(store, tmp_path, *documents):
    path = tmp_path / f"{uuid.uuid4().hex}.json"
    path.write_text("\n".join(map(json.dumps, documents)))
    return job.run(store, str(path), as_of=F.lit("2024-06-01"))


def test_a_layer_that_fails_its_checks_is_not_published(store, tmp_path):
    loaded(store, tmp_path, DOCUMENT)
    before = rows(store.read("silver", K.CUSTOMERS)), rows(store.read("gold", K.ANALYTICS))
    with pytest.raises(Q.QualityError, match="not_null_email: 1"):
        loaded(store, tmp_path, {**DOCUMENT, "email": None}, {**DOCUMENT, "customer_id": 2})
    assert (rows(store.read("silver", K.CUSTOMERS)), rows(store.read("gold", K.ANALYTICS))) == before
    failed = store.read("silver", job.CHECK_RESULTS).filter("check_name = 'not_null_email'").first()
    assert failed.failures == 1


def test_views_follow_refreshes_in_every_session(spark, store, tmp_path):
    loaded(store, tmp_path, DOCUMENT)
    other = spark.newSession()
    name = store.name("gold", "customers_by_operator")
    assert other.table(name).agg(F.sum("customers")).first()[0] == 1
    loaded(store, tmp_path, DOCUMENT, {**DOCUMENT, "customer_id": 2, "payment_history": []})
    assert other.table(name).agg(F.sum("customers")).first()[0] == 2
    assert spark.sql("SELECT sum(customers) FROM customers_by_operator").first()[0] == 2
    for model in job.select_models("gold"):
        assert other.catalog.tableExists(store.name("gold", model.name))


@pytest.mark.parametrize("name", [m.name for m in job.MODELS.values() if m.view])
def test_stored_views_equal_their_functions(spark, name):
    model = job.MODELS[name]
    given = S.tables(spark, SF, *model.inputs)
    layers = S.layer_store(spark, SF)
    layers.create_view("gold", name, views.text(name, {n: layers.name(job.MODELS[n].layer, n) for n in model.inputs}))
    stored = spark.newSession().table(layers.name("gold", name))
    expected = model.apply(given)
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in expected.schema]
    assert rows(stored) == rows(expected) != []
