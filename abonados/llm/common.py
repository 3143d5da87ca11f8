"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abonados.session import shared_dir

#: White space as the contracts name it: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it is not installed."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, paths)])
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: a short lineage that
    survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widened(df: DataFrame, **kinds: str) -> T.StructType:
    """The frame's schema with further columns behind its own."""
    more = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in kinds.items()]
    return T.StructType([*df.schema.fields, *more])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column has it then."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_remainder(column: Column, modulus: int) -> Column:
    """crc32 of the id's text, by ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


# ------------------------------------------------------------------ hashed words

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; distinct values stay distinct."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def hashed_words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of many texts, A-Z taken as lower case.

    ``data`` holds the bytes of the texts one after the other and ``ends`` where each
    of them ends. Returns the hashes and, for each text, where its words end.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + np.uint8(32), data)
    inside = (data != 32) & ((data < 9) | (data > 13))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    cuts = ends[:-1][(ends[:-1] > 0) & (ends[:-1] < n)]
    begins[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(up[:n] * (data.astype(np.uint64) + np.uint64(1)), out=sums[1:])
    words = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return words, np.searchsorted(first, ends, side="left")


def text_chunks(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``size`` bytes, or one longer text: their numbers (first,
    end), bytes, and where each text ends. Nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    held = texts.buffers()[2]
    whole = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    start = 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end, whole[offsets[start] : offsets[end]], offsets[start + 1 : end + 1] - offsets[start]
        start = end


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of ``size`` words in a row, sorted; of fewer words, one hash of all."""
    n = len(words)
    if not n:
        return words
    parts = min(n, size)
    value = np.full(n - parts + 1, parts, np.uint64)
    for i in range(parts):
        value = mixed(value + words[i : n - parts + 1 + i])
    return np.unique(value)


def components(edges: DataFrame, a: str, b: str, rounds: int | None = None) -> DataFrame:
    """Connected components: each value of either column with the least value of its
    component, as (``node``, ``label``); after so many ``rounds`` with the least that is
    known by then, which need not be the same for a whole component.

    Every round takes the least label among neighbours and then the label of the label,
    so chains shorten by halves. Labels are aggregated in the map tasks before they
    travel, so a node with very many neighbours is no hot group.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = stored(both.union(both.select("y", "x")).distinct(), "edges")
    labels = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
    labels = stored(labels.select("node", F.least("node", "m").alias("label")), "labels")
    if rounds == 0:
        return labels
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("y"), "label"), "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("label").alias("best"))
        )
        step = labels.join(near, "node").select("node", "label", F.least("label", "best").alias("best"))
        jump = labels.select(F.col("node").alias("best"), F.col("label").alias("over"))
        step = step.join(jump, "best").select("node", "label", F.least("best", "over").alias("next"))
        step = stored(step, "labels")
        changed = step.filter(F.col("next") != F.col("label")).limit(1).count()
        labels = step.select("node", F.col("next").alias("label"))
        rounds = None if rounds is None else rounds - 1
        if not changed or rounds == 0:
            return labels
