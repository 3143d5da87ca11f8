"""Bands bring only documents together that look alike, and miss few of these."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from abonados.llm import near_dedup


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.8, 0.85, 0.95])
def test_bands_find_pairs_at_the_threshold(threshold):
    bands = near_dedup._bands(threshold)
    assert len(bands) <= near_dedup.MOST_TREES
    assert (1 - threshold ** bands.shape[1]) ** len(bands) <= near_dedup.MISSED
    assert len(np.unique(bands)) == bands.size


def test_documents_that_differ_share_no_node(spark):
    """Single tokens of 16 bits brought more of them together the more there were."""
    draw = np.random.default_rng(4)
    rows = [(bytes(draw.bytes(16)), bytes(draw.bytes(2 * near_dedup.SLOTS))) for _ in range(3000)]
    classes = spark.createDataFrame(rows, "key binary, tokens binary").withColumn("known", F.lit(None).cast("binary"))
    level = near_dedup._roots(classes, near_dedup._bands(0.85))
    assert level.count() == 3000 * len(near_dedup._bands(0.85))
    assert near_dedup._open(level).count() == 0


def test_tokens_keep_their_values(spark):
    texts = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    row = near_dedup._sketched(texts, 3, "doc_id", "text").select("tokens", near_dedup._low().alias("low")).first()
    found = near_dedup._signatures(pa.array([bytes(row.tokens)], pa.binary()))[0]
    assert found.dtype == np.uint16 and len(found) == near_dedup.SLOTS
    assert bytes(row.low) == found.astype(np.uint8).tobytes()
    assert len(np.unique(found >> 8)) > 1


def test_groups_that_a_large_node_leaves_apart_meet(spark, monkeypatch):
    """Few rows of pairs of blocks: the node does not branch, no link is lost."""
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 4)
    monkeypatch.setattr(near_dedup, "PAIR_ROWS", 1000)
    monkeypatch.setattr(near_dedup, "_children", None)
    base = [f"w{i}" for i in range(200)]
    found = [(i, " ".join([*base[: 3 * i], f"own{i}", *base[3 * i + 1 :]])) for i in range(60)]
    found.append((0, found[0][1]))  # a row that repeats id and text
    judged = near_dedup.near_duplicates(spark.createDataFrame(found, "doc_id long, text string"), 3, 85).collect()
    assert len(judged) == 61 and {r["component_id"] for r in judged} == {0}


def test_rows_of_the_largest_group_are_not_paired(spark):
    """Rows grew with the square of a group; all rows of different groups still meet."""
    near_key = lambda i: int(i).to_bytes(16, "big")
    for held, others in ((4000, 40), (3000, 700)):
        rows = [(7, near_key(i), near_key(0)) for i in range(held)] + [(7, near_key(held + i), None) for i in range(others)]
        nodes = spark.createDataFrame(rows, "node long, key binary, known binary")
        parted = near_dedup._parted(nodes)
        assert parted.filter("main").count() == held and parted.filter("not main").count() == others
        pairs = near_dedup._block_pairs(parted).collect()
        half = near_dedup.SMALL_NODE / 2
        most = -(-others // half)
        assert len(pairs) == held * most + others * (-(-held // half) + most)
        cells = {}
        for row in pairs:
            cells.setdefault(row.node, []).append(int.from_bytes(row.key, "big"))
        assert max(map(len, cells.values())) < 2 * near_dedup.SMALL_NODE
        met = np.zeros((held + others, held + others), bool)
        for keys in cells.values():
            met[np.ix_(keys, keys)] = True
        assert met[held:, :].all()
    alone = nodes.filter("known IS NOT NULL")
    assert near_dedup._parted(alone).count() == 0
