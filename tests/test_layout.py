"""Buckets follow the stored data, whatever the cores and shuffle settings."""

import uuid

import pytest
from pyspark.sql import functions as F

from abonados.plans import checks as K
from abonados.sources import tables as T
from contract.catalogue import QUERIES
from contract.store import layer_store
from test_plans import SF, plan


@pytest.fixture
def store(spark, tmp_path):
    return T.LayerStore(spark, str(tmp_path), f"layout_{uuid.uuid4().hex[:8]}", sized_by=("bronze", "raw"))


def files_of(store, layer, table):
    return store.read(layer, table).select(F.input_file_name()).distinct().count()


@pytest.mark.parametrize(("stored", "buckets"), [(0, 16), (1 << 30, 16), (1 << 40, 8192), (1 << 50, 100_000)])
def test_buckets_for_bytes(stored, buckets):
    assert T.buckets_for(stored) == buckets


@pytest.mark.parametrize("partitions", ["4099", "2"])
def test_shuffle_settings_do_not_count(spark, store, monkeypatch, partitions):
    monkeypatch.setattr(T, "BUCKET_BYTES", 2000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    store.write("bronze", "raw", spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("text")))
    wanted = T.buckets_for(store.stored_bytes("bronze", "raw"))
    assert wanted > 16
    rows = spark.range(9000).select((F.col("id") % 3000).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        store.write("silver", "grouped", rows, bucket_by="key")
        store.write("silver", "gathered", spark.range(3000).withColumnRenamed("id", "key"), bucket_by="key", gather=True)
        assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = store.read("silver", "grouped").join(store.read("silver", "gathered"), "key")
        assert "Exchange" not in plan(joined)
        assert joined.agg(F.sum("n")).first()[0] == 9000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for table in ("grouped", "gathered"):
        assert store.layout("silver", table).buckets == wanted
        assert files_of(store, "silver", table) <= wanted


def test_hot_keys_are_noted(spark, store):
    store.write("bronze", "raw", spark.range(10))
    even = spark.range(10_000).withColumnRenamed("id", "key")
    hot = even.select(F.when(F.col("key") % 3 == 0, 7).otherwise(F.col("key")).alias("key"))
    store.write("silver", "even", even, bucket_by="key", gather=True)
    store.write("silver", "hot", hot, bucket_by="key", gather=True)
    store.write("silver", "none", hot.filter("key < 0"), bucket_by="key", gather=True)
    assert not store.layout("silver", "even").uneven
    layout = store.layout("silver", "hot")
    assert layout.uneven and (layout.rows, layout.hottest) == (10_000, 3335)
    assert store.layout("silver", "none") == T.Layout("key", 16, 0, 0)
    assert store.layout("bronze", "raw") is None


def test_stored_layers_have_layouts_that_agree(spark):
    QUERIES["g0_customer_analytics"](spark, SF)
    store = layer_store(spark, SF)
    layouts = [store.layout("silver", t) for t in (K.CUSTOMERS, K.PAYMENTS, K.SERVICES)]
    assert {(x.key, x.buckets) for x in layouts} == {("customer_id", 16)} and not any(x.uneven for x in layouts)
