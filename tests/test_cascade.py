"""Deleting orphans writes only the slices that hold them."""

import hashlib
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from abonados.sources import tables as T
from test_plans import plan

KEYS = 400


@pytest.fixture
def store(spark, tmp_path):
    return T.LayerStore(spark, str(tmp_path / "layers"), f"cascade_{uuid.uuid4().hex[:8]}", buckets=16)


def written(store, parents, children):
    store.write("silver", "parent", parents, "key", gather=True)
    store.write("silver", "child", children, "key", gather=True, sliced=True)


def children(spark):
    rows = spark.range(3 * KEYS)
    key = F.when(F.col("id") % 50 == 49, F.lit(None)).otherwise(F.col("id") % KEYS)
    return rows.select(key.alias("key"), F.col("id").alias("item"))


def files(store):
    folder = Path(store.root) / "silver" / T.folder_of(store.current_load("silver", "child"))
    return {str(f.relative_to(folder)): hashlib.md5(f.read_bytes()).hexdigest() for f in folder.rglob("*.parquet")}


def items(frame):
    return sorted((r["key"] is not None, r["key"] or 0, r["item"]) for r in frame.collect())


def kept(frame, *gone):
    return [r for r in items(frame) if not (r[0] and r[1] in gone)]


def test_only_slices_with_orphans_are_written(spark, store):
    given = children(spark)
    written(store, spark.range(KEYS).filter("id NOT IN (7, 8)").withColumnRenamed("id", "key"), given)
    before, layout = files(store), store.layout("silver", "child")
    gone = given.filter("key IN (7, 8)").count()
    assert gone > 1
    slices = {r["slice"] for r in spark.range(7, 9).select(T.slice_of("id", 16).alias("slice")).collect()}
    assert store.delete_orphans("silver", "child", "parent", "key") == gone
    after = files(store)
    assert before.items() <= after.items()
    new = set(after) - set(before)
    assert {int(f.split("_slice=")[1].split("/")[0]) for f in new} == slices and len(new) == len(slices) < 16
    read = store.read("silver", "child")
    assert items(read) == kept(given, 7, 8)
    used = {r[0].split("/silver/")[1].split("/", 1)[1] for r in read.select(F.input_file_name()).distinct().collect()}
    assert new < used and len(used) == len(before)
    assert read.columns == spark.table(store.name("silver", "child")).columns == ["key", "item"]
    assert items(spark.table(store.name("silver", "child"))) == kept(given, 7, 8)
    after_layout = store.layout("silver", "child")
    assert (after_layout.buckets, after_layout.rows) == (layout.buckets, layout.rows - gone)
    assert items(store.read("silver", "child", version=2)) == items(given)


def test_revisions_follow_each_other_and_are_removed_with_their_base(spark, store):
    given = children(spark)
    written(store, spark.range(1, KEYS).withColumnRenamed("id", "key"), given)
    base = store.current_load("silver", "child")
    store.delete_orphans("silver", "child", "parent", "key")
    store.write("silver", "parent", spark.range(KEYS).filter("id NOT IN (0, 9)").withColumnRenamed("id", "key"), "key", gather=True)
    store.delete_orphans("silver", "child", "parent", "key")
    assert items(store.read("silver", "child")) == kept(given, 0, 9)
    assert store.delete_orphans("silver", "child", "parent", "key") == 0
    assert len(store.versions("silver").numbers()) == 5
    store.remove_replaced("silver", older_than=-60)
    assert items(store.read("silver", "child")) == kept(given, 0, 9)
    assert T.folder_of(store.current_load("silver", "child")) == base
    assert store.drop_replaced("silver", "child") == []
    store.write("silver", "child", given, "key", gather=True, sliced=True)
    assert base in store.remove_replaced("silver", older_than=-60)
    assert not (Path(store.root) / "silver" / base).exists()
    assert store.loads("silver", "child") == [store.current_load("silver", "child")]
    assert items(store.read("silver", "child")) == items(given)


def test_joins_of_slices_need_no_shuffle(spark, store):
    written(store, spark.range(2, KEYS).withColumnRenamed("id", "key"), children(spark))
    store.delete_orphans("silver", "child", "parent", "key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = store.read("silver", "child").join(store.read("silver", "parent"), "key")
        assert "Exchange" not in plan(joined) and joined.count() == joined.select("item").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_odd_tables(spark, store):
    given = children(spark)
    written(store, spark.range(0).withColumnRenamed("id", "key"), given)
    orphans = given.filter("key IS NOT NULL").count()
    assert store.delete_orphans("silver", "child", "parent", "key") == orphans
    assert store.read("silver", "child").count() == 3 * KEYS - orphans
    store.write("silver", "child", given.filter("item < 0"), "key", gather=True, sliced=True)
    assert store.delete_orphans("silver", "child", "parent", "key") == 0
    store.write("silver", "child", given, "key", gather=True)
    with pytest.raises(ValueError, match="slices"):
        store.delete_orphans("silver", "child", "parent", "key")
