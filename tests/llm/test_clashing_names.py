"""Columns whose names the pipeline's stages use themselves are kept as they are."""

from abonados.llm import decontaminate, near_dedup
from abonados.llm.common import unused

SCHEMA = "doc_id long, text string, _lost string, _dirty string, _mark string, _own_mark string, __LOST int"


def test_stages_keep_columns_of_any_name(spark):
    passage = " ".join(f"item{i}" for i in range(20))
    plain = " ".join(f"w{i}" for i in range(40))
    rows = [(1, plain), (2, f"{plain} end"), (3, passage), (None, None), (4, "")]
    documents = spark.createDataFrame([(i, t, "l", "d", "m", "o", 5) for i, t in rows], SCHEMA)
    benchmark = spark.createDataFrame([("a", passage)], "item_id string, text string")
    clean = decontaminate.decontaminate(documents, benchmark).collect()
    assert sorted(str(r.doc_id) for r in clean) == ["1", "2", "4", "None"]
    apart = near_dedup.drop_near_duplicates(documents, size=5, percent=80).collect()
    assert sorted(str(r.doc_id) for r in apart) == ["1", "3", "4", "None"]
    assert {tuple(r)[2:] for r in [*clean, *apart]} == {("l", "d", "m", "o", 5)}


def test_unused_names(spark):
    frame = spark.createDataFrame([], "a int, _a int, B int")
    assert unused(frame, "a", "b", "c", "c") == ["__a", "_b", "c", "_c"]
