"""Documents that the queries derive from the given tables."""

import json

import pytest
from pyspark.sql import functions as F

from contract import documents, job_queries

SF = "/root/testdata/sf0.001"


def test_documents_are_parsed_once(spark):
    optimized = documents.bronze(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # the document, and one number with an exponent for each of five fields
    assert 1 <= optimized.count("parseJson") <= 6
    assert "variant_get" not in optimized


def test_members_that_are_json_already(spark):
    rows = documents.bronze(spark, SF).select("_row_id", F.to_json("data").alias("json")).collect()
    assert len(rows) == len({r["_row_id"] for r in rows})
    found = [json.loads(r["json"]) for r in rows]
    kinds = {type(d.get("customer_id")) for d in found}
    assert kinds == {int, str, type(None)}
    assert any("customer_id" not in d for d in found) and any(d.get("customer_id", 0) is None for d in found)
    assert {type(d["contracted_services"]) for d in found if "contracted_services" in d} == {list, str}
    assert any(d.get("payment_history") == "none" for d in found)
    listed = [d["payment_history"] for d in found if isinstance(d.get("payment_history"), list)]
    assert {type(p.get("amount")) for payments in listed for p in payments if isinstance(p, dict)} >= {int, str}


def test_array_files_hold_whole_arrays_and_are_few(spark, tmp_path):
    raw = spark.range(1, 5001).select(F.col("id").alias("_row_id"), F.expr("parse_json('{\"a\": ' || id || '}')").alias("data"))
    job_queries._write_arrays(raw, str(tmp_path / "arrays"))
    files = list((tmp_path / "arrays").rglob("*.txt"))
    assert len(files) == 1
    assert json.loads(files[0].read_text()) == [{"a": i} for i in range(1, 5001)]


def _pairs(spark, numbers, tasks):
    """Documents that tell their row number, in this order, dealt evenly over so many tasks."""
    rows = spark.createDataFrame([(n,) for n in numbers], "_row_id long").coalesce(1)
    rows = rows.repartition(tasks) if tasks > 1 else rows
    text = F.concat(F.lit('{"n": '), "_row_id", F.lit(', "text": "'), F.repeat(F.lit("word "), 200), F.lit('"}'))
    return rows.select("_row_id", F.parse_json(text).alias("data"))


def _numbers_by_file(spark, path):
    lines = spark.read.text(str(path)).select(
        F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), F.expr("get_json_object(value, '$.n')").cast("long").alias("n"))
    found = {}
    for row in lines.orderBy("at").collect():
        found.setdefault(row.file, []).append(row.n)
    return found


@pytest.mark.parametrize("tasks", [1, 2, 3])
@pytest.mark.parametrize("numbers", [range(1, 61), range(60, 0, -1), [2, 5, 6, 7, 1]], ids=["in order", "backwards", "apart"])
def test_copies_follow_each_other_in_lines(spark, tmp_path, numbers, tasks):
    job_queries._write_lines(_pairs(spark, numbers, tasks), str(tmp_path / "lines"))
    found = _numbers_by_file(spark, tmp_path / "lines")
    assert sorted(n for held in found.values() for n in held) == sorted(numbers)
    for held in found.values():
        for n in held:
            if n % 2 == 0 and n - 1 in numbers:
                assert held.index(n - 1) == held.index(n) - 1


def test_lines_are_small_and_documents_stay_where_they_lie(spark, tmp_path):
    assert job_queries._copies_follow(_pairs(spark, range(1, 2001), 1))
    assert not job_queries._copies_follow(_pairs(spark, range(2000, 0, -1), 1))
    text = F.expr("parse_json('{\"text\": \"' || repeat('word ', 200) || '\"}')")
    # seven tasks, which a shuffle would bring together
    alone = spark.range(1, 2001, 2, 7).select(F.col("id").alias("_row_id"), text.alias("data"))
    job_queries._write_lines(alone, str(tmp_path / "lines"))
    files = list((tmp_path / "lines").glob("part-*"))
    assert len(files) == 7
    assert sum(f.stat().st_size for f in files) < 1000 * 1000 / 10


def test_array_files_are_few_however_sparse_row_numbers_are(spark, tmp_path):
    raw = spark.range(500).select((F.col("id") * 1_000_003 + 1).alias("_row_id"), F.expr("parse_json('{\"a\": ' || id || '}')").alias("data"))
    job_queries._write_arrays(raw, str(tmp_path / "arrays"))
    files = list((tmp_path / "arrays").rglob("*.txt"))
    assert len(files) == 1
    assert json.loads(files[0].read_text()) == [{"a": i} for i in range(500)]


def test_many_array_files_hold_every_document_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(job_queries, "DOCUMENTS_PER_ARRAY_FILE", 100)
    raw = spark.range(1, 2001).select(F.col("id").alias("_row_id"), F.expr("parse_json('{\"a\": ' || id || '}')").alias("data"))
    job_queries._write_arrays(raw, str(tmp_path / "arrays"))
    files = list((tmp_path / "arrays").rglob("*.txt"))
    assert 10 <= len(files) <= 20
    assert sorted(d["a"] for f in files for d in json.loads(f.read_text())) == list(range(1, 2001))
