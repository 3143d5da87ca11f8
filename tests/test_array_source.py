"""Files that hold one JSON array, read in byte ranges, against parsing them whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from abonados.sources import bronze


def documents(n, seed=1):
    draw = random.Random(seed)
    odd = ['}', '{', '"', '\\', '\\\\"', ']', '[', '},{', '"}', '\n', 'é', '日', ',', '\\}']
    return [
        {
            "customer_id": i,
            "name": "".join(draw.choice(odd) for _ in range(draw.randrange(9))),
            "payment_history": [{"amount": k, "note": draw.choice(odd)} for k in range(draw.randrange(3))],
            "nested": {"a": {"b": [[], {}, [draw.choice(odd)]]}},
        }
        for i in range(n)
    ]


@pytest.fixture
def ranges(spark):
    """Byte ranges of 200 bytes, so that they begin anywhere."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "32")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def read(spark, path, mode="FAILFAST"):
    found = bronze.as_bronze(bronze.read_arrays(spark, str(path), mode)).orderBy("_row_id")
    return [r[0] and json.loads(r[0]) for r in found.select(F.to_json("data")).collect()]


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_elements_of_split_files_in_order(spark, ranges, tmp_path, indent, ascii_only):
    first, second = documents(60), documents(25, seed=2)
    (tmp_path / "a.json").write_text(json.dumps(first, indent=indent, ensure_ascii=ascii_only))
    (tmp_path / "b.json").write_text(" \n" + json.dumps(second, ensure_ascii=ascii_only) + "\n")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert read(spark, tmp_path) == first + second


@pytest.mark.parametrize("text", ["[]", " [ ] ", "[1, 2]", '[1, {"a": 1}, "x}", {"b": {}}, [3], null]', '[{"a": 1}]'])
def test_arrays_of_other_things(spark, ranges, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    assert read(spark, tmp_path) == json.loads(text)


@pytest.mark.parametrize("text", ['[{"a": 1}, {"a": 2', '[{"a": 1}', '{"a": 1}', '[{"a": 1}, {"b": }, {"c": 3}]', "nothing"])
def test_malformed_arrays(spark, ranges, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="JSON|MALFORMED"):
        read(spark, tmp_path)
    kept = [d for d in ({"a": 1}, {"c": 3}) if f"{json.dumps(d)}," in text or f"{json.dumps(d)}]" in text]
    assert read(spark, tmp_path, "DROPMALFORMED") == kept
    permissive = read(spark, tmp_path, "PERMISSIVE")
    assert [d for d in permissive if d] == kept and permissive.count(None) == 1


def test_array_beyond_one_variant(spark, tmp_path):
    """An array above the size of a variant equals the same documents in lines."""
    rows = spark.range(150_000).select(
        F.to_json(F.struct(F.col("id").alias("customer_id"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 8).alias("note"))).alias("text")
    )
    rows.write.text(str(tmp_path / "lines"))
    size = 0
    with open(tmp_path / "array.json", "w") as out:
        for part in sorted((tmp_path / "lines").glob("*.txt")):
            for line in part.read_text().splitlines():
                size += out.write(("," if size else "[") + line)
        out.write("]")
    assert size > 140 << 20
    found = bronze.read_arrays(spark, str(tmp_path / "array.json"))
    lines = bronze.read_lines(spark, str(tmp_path / "lines"))
    sums = [d.agg(F.count("*"), F.sum(F.xxhash64(F.to_json("data")).cast("decimal(38,0)"))).first() for d in (found, lines)]
    assert sums[0] == sums[1]


def test_elements_are_parsed_once_after_the_sort(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"b": "}"}]')
    found = bronze.read_arrays(spark, str(tmp_path))
    # a tree's upper lines run later; a sort runs what is below it twice
    optimized = found._jdf.queryExecution().optimizedPlan().toString()
    above, below = optimized.split("Sort [file", 1)
    assert "parseJson" in above and "parseJson" not in below
    assert [json.loads(r[0]) for r in found.select(F.to_json("data")).collect()] == [{"a": 1}, {"b": "}"}]


@pytest.mark.parametrize(("segment", "cell"), [(1, 1), (90, 3), (400, 7), (1 << 20, 4096)])
def test_runs_of_elements_of_any_size(spark, ranges, tmp_path, monkeypatch, segment, cell):
    monkeypatch.setattr(bronze, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(bronze, "CELL_CHUNKS", cell)
    first, second = documents(70, seed=3), documents(20, seed=4)
    (tmp_path / "b.json").write_text(json.dumps(second, indent=2))
    (tmp_path / "a.json").write_text(json.dumps(first))
    (tmp_path / "c.json").write_text("[]")
    assert read(spark, tmp_path) == first + second
    (tmp_path / "d.json").write_text('[{"a": 1} {"b": 2}]')
    with pytest.raises(Exception, match="JSON|MALFORMED"):
        read(spark, tmp_path)


def test_texts_are_counted_once_and_shuffled_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"b": "}"}]')
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = bronze.read_arrays(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one scan counts, the other has the texts, which go to their place in the order at once
    assert plan.count("FileScan text") == 2
    assert plan.count("Exchange rangepartitioning") == 1
    assert plan.count("regexp_replace(chunk") + plan.count("regexp_replace(value") == 1
    assert "collect_list(struct" in plan.split("Exchange rangepartitioning")[0]


def test_an_element_keeps_its_own_keys_only(spark, tmp_path):
    """Elements are parsed together, and yet none carries the keys of others."""
    (tmp_path / "a.json").write_text(json.dumps([{f"key{i}": i} for i in range(50)]))
    rows = bronze.read_arrays(spark, str(tmp_path)).collect()
    assert [bytes(r[0].metadata).count(b"key") for r in rows] == [1] * 50
