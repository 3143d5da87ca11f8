"""Exact statistics against brute force."""

import random
import statistics
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abonados.operators import statistics as S


def brute(rows):
    groups = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    result = {}
    for key, values in groups.items():
        counts = Counter(values)
        mode = min(v for v, n in counts.items() if n == max(counts.values()))
        middle = statistics.median(float(v) for v in values)
        result[key] = (middle, mode, len(values))
    return result


def summary(spark, rows, schema="k string, v decimal(20,4)"):
    frame = spark.createDataFrame(rows, schema)
    return {r.k: (r.median, r.mode, r.total) for r in S.grouped_summary(frame, ["k"], "v").collect()}


def made_rows(seed):
    random.seed(seed)
    rows = []
    for key, size in (("big", 4001), ("even", 300), ("one", 1), ("two", 2), (None, 57), ("", 8)):
        for _ in range(size):
            rows.append((key, Decimal(random.choice((random.randint(-50, 50), random.randint(0, 10**6)))) / 4))
    rows += [("even", None), ("nothing", None)]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_summary_equals_brute_force(spark, seed):
    rows = made_rows(seed)
    assert summary(spark, rows) == brute(rows)


def test_summary_is_exact_with_a_poor_sketch(spark, monkeypatch):
    """With brackets that miss the middle, the result stays exact."""
    rows = made_rows(3)
    true_sketch = F.percentile_approx
    monkeypatch.setattr(S.F, "percentile_approx", lambda c, p, a: true_sketch(c, [0.9, 0.95], 100))
    assert summary(spark, rows) == brute(rows)
    monkeypatch.setattr(S.F, "percentile_approx", lambda c, p, a: true_sketch(c, [0.01, 0.02], 100))
    assert summary(spark, rows) == brute(rows)
    monkeypatch.setattr(S.F, "percentile_approx", lambda c, p, a: true_sketch(c, [0.5, 0.5], 100))
    assert summary(spark, rows) == brute(rows)


def test_summary_of_equal_values(spark):
    rows = [("a", Decimal(3))] * 1000 + [("a", Decimal(4))] * 1000
    assert summary(spark, rows) == {"a": (3.5, Decimal(3), 2000)}


def test_percent_of_total(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("c", 5)], "k string, n long")
    result = {r.k: r.p for r in frame.withColumn("p", S.percent_of_total("n")).collect()}
    assert result == {"a": Decimal("12.50"), "b": Decimal("25.00"), "c": Decimal("62.50")}
