"""Periodic runs against brute force over all periods of short texts."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from abonados.llm import queries, runs

SCHEMA = "doc_id long, text string, runs string, start long, words string, first string"


def brute(words, min_length=24, min_exponent=3):
    """Every maximal stretch of period q, kept only where no smaller period holds."""
    n, found = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i : i + length]
            smaller = any(stretch[d:] == stretch[:-d] for d in range(1, q))
            if length >= max(min_length, min_exponent * q) and not smaller:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, text)
    found = brute(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (
        len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def texts():
    draw = random.Random(5)
    out = [None, "", " \t\n", "one", "one two", "a " * 23, "a " * 24, "b " * 2000, "ab\x0bab ab " * 30, "x y " * 12]
    out += ["\x1ca \x85b " * 20, "é " * 30 + "e " * 30, "a b c " * 8 + "a b", "a b c " * 9 + "d " + "a b c " * 9]
    for _ in range(150):
        size, letters = draw.randrange(5, 260), draw.choice([1, 2, 2, 3, 50])
        words = [f"w{draw.randrange(letters)}" for _ in range(size)]
        if draw.random() < 0.6:
            q = draw.randrange(1, 14)
            at = draw.randrange(size)
            words[at:at] = (words[:q] * 14)[: draw.randrange(10, 120)]
        out.append(" ".join(words))
    inner = (["a"] * 24 + ["b"]) * 4
    out += [" ".join(inner * 3 + ["c"]), "\n".join(out[-1:] * 6), out[30], out[30]]
    return list(enumerate(out))


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(i, t, "r", 1, "w", "f") for i, t in texts()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.op11(spark, str(tmp_path)).collect()}
    assert got == {(i, *expected(i, t)) for i, t in texts()}


@pytest.mark.parametrize(("min_length", "min_exponent"), [(2, 2), (24, 3), (10, 4)])
def test_runs_of_any_bounds(spark, min_length, min_exponent):
    rows = [(i, t, "mine", 7, "w", "f") for i, t in texts()]
    frame = spark.createDataFrame(rows, SCHEMA)
    judged = runs.periodic_runs(frame, min_length=min_length, min_exponent=min_exponent).collect()
    for row in judged:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        assert [tuple(r) for r in row.runs] == brute(words, min_length, min_exponent)
        assert (row.start, row.words, row.n_words) == (7, "w", len(words))


def test_many_positions_in_one_class(spark):
    text = "z " * 5000 + "end"
    (row,) = runs.periodic_runs(spark.createDataFrame([(text,)], "text string")).collect()
    assert [tuple(r) for r in row.runs] == [(0, 5000, 1)] and row.collapsed == "z end"


def test_empty_table(spark):
    assert runs.run_digests(runs.periodic_runs(spark.createDataFrame([], SCHEMA))).collect() == []
