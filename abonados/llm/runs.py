"""Periodic runs of words, found while classes of suffixes grow together.

Pairs of neighbours in the suffix order are united by decreasing length of their common
prefix (LCP). Every class keeps its positions in order. Two positions that become
neighbours there, at a distance within the LCP, begin a repetition of that period: all
positions that share at least so many words are in the class by then, so no smaller
period can hold, and each run is met once, at its first position.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abonados.llm.common import mixed, ready, widened

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
#: Bytes of text that are searched together; one longer text is searched alone.
TOGETHER = 4 << 20
#: Positions in one list of an ordered set before it is halved.
CHUNK = 512


class Positions:
    """An ordered set of whole numbers, in sorted lists of bounded length."""

    __slots__ = ("chunks", "firsts", "size")

    def __init__(self, first: int):
        self.chunks, self.firsts, self.size = [[first]], [first], 1

    def add(self, x: int) -> tuple[int, int]:
        """Adds a number that is not in the set; its neighbours there, -1 for none."""
        k = max(bisect_right(self.firsts, x) - 1, 0)
        chunk = self.chunks[k]
        i = bisect_left(chunk, x)
        before = chunk[i - 1] if i else (self.chunks[k - 1][-1] if k else -1)
        after = chunk[i] if i < len(chunk) else (self.firsts[k + 1] if k + 1 < len(self.firsts) else -1)
        chunk.insert(i, x)
        self.firsts[k] = chunk[0]
        self.size += 1
        if len(chunk) > CHUNK:
            half = len(chunk) // 2
            self.chunks.insert(k + 1, chunk[half:])
            self.firsts.insert(k + 1, chunk[half])
            del chunk[half:]
        return before, after

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk


def least_lcp(min_length: int, min_exponent: int) -> int:
    """The least LCP at which a run long enough for both bounds can begin."""
    return min(max(min_length - p, (min_exponent - 1) * p, 1) for p in range(1, min_length + 2))


def suffix_order(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions of many texts, text by text, in the order of the suffixes that begin
    there and end with their text. Ranks are doubled in length until none are equal."""
    n = len(words)
    texts = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    stop = np.repeat(ends, np.diff(ends, prepend=0))
    here = np.arange(n)
    _, rank = np.unique(texts * (int(words.max()) + 1) + words, return_inverse=True)
    step = 1
    while True:
        next_rank = np.zeros(n, np.int64)
        inside = here + step < stop
        next_rank[inside] = rank[here[inside] + step] + 1
        key = rank * (n + 1) + next_rank
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


def common_prefixes(words: list[int], order: list[int]) -> list[int]:
    """For one text: the LCP of each suffix with the one before it in the order."""
    n = len(words)
    before = [-1] * n
    for a, b in zip(order, order[1:]):  # noqa: B905
        before[b] = a
    lcp, h = [0] * n, 0
    for i in range(n):
        j = before[i]
        if j < 0:
            h = 0
            continue
        most = n - max(i, j)
        while h < most and words[i + h] == words[j + h]:
            h += 1
        lcp[i] = h
        if h:
            h -= 1
    return [lcp[i] for i in order]


def runs_of(words: list[int], order: list[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one text, by start and period.

    Classes are united by decreasing LCP, the smaller into the larger; a position's new
    neighbours are looked at as it arrives. Neighbours at distance d within the LCP are
    a run if it cannot be extended to the left; to the right, the LCP is its end.
    """
    least = least_lcp(min_length, min_exponent)
    lcp = np.array(common_prefixes(words, order), np.int64)
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}
    found = []

    def root(x: int) -> int:
        if x not in parent:
            parent[x] = x
            classes[x] = Positions(x)
            return x
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def seed(i: int, j: int, common: int) -> None:
        period = j - i
        if period > common or common + period < max(min_length, min_exponent * period):
            return
        if i and words[i - 1] == words[j - 1]:
            return
        found.append((i, common + period, period))

    for edge, common in zip(edges.tolist(), lcp[edges].tolist(), strict=True):
        a, b = root(order[edge - 1]), root(order[edge])
        if classes[a].size < classes[b].size:
            a, b = b, a
        large, small = classes[a], classes.pop(b)
        parent[b] = a
        moved = list(small)
        arrived = set(moved)
        pairs = {}
        for x in moved:
            before, after = large.add(x)
            pairs[x] = before
            if after >= 0:
                pairs[after] = x
        for j, i in pairs.items():
            # neighbours that came together from the smaller class are not new
            if i >= 0 and (i in arrived) != (j in arrived):
                seed(i, j, common)
    return sorted(found, key=lambda run: (run[0], run[2]))


def _repeating(words: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Which texts hold some window of so many words twice; by hashes, so hardly any more."""
    n = len(words)
    value, length = mixed(words.astype(np.uint64) + np.uint64(1)), 1
    while length < window:
        step = min(length, window - length)
        shifted = np.zeros(n, np.uint64)
        shifted[: n - step] = value[step:]
        value = mixed(value * np.uint64(3) + shifted)
        length += step
    sizes = np.diff(ends, prepend=0)
    texts = np.repeat(np.arange(len(ends)), sizes)
    whole = np.arange(n) + window <= np.repeat(ends, sizes)
    value = mixed(value[whole] + texts[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    texts = texts[whole]
    order = np.argsort(value, kind="stable")
    twice = np.flatnonzero(value[order][1:] == value[order][:-1])
    return np.unique(texts[order[twice]])


def _search(texts: list[list[bytes]], min_length: int, min_exponent: int) -> dict[int, list[tuple[int, int, int]]]:
    """The runs of the texts that have any, by the text's number."""
    sizes = np.array([len(words) for words in texts], np.int64)
    if not sizes.sum():
        return {}
    flat = pa.array([word for words in texts for word in words], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    chosen = _repeating(codes, ends, least_lcp(min_length, min_exponent))
    if not len(chosen):
        return {}
    starts = ends - sizes
    words = np.concatenate([codes[starts[t] : ends[t]] for t in chosen])
    chosen_ends = np.cumsum(sizes[chosen])
    order = suffix_order(words, chosen_ends)
    found, start = {}, 0
    for t, end in zip(chosen.tolist(), chosen_ends.tolist(), strict=True):
        runs = runs_of(words[start:end].tolist(), (order[start:end] - start).tolist(), min_length, min_exponent)
        if runs:
            found[t] = runs
        start = end
    return found


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(
    documents: DataFrame, text: str = "text", min_length: int = 24, min_exponent: int = 3
) -> DataFrame:
    """All rows with ``n_words``, ``runs`` (start, length and smallest period in words, by
    start and period) and ``collapsed``: the words that no run repeats, joined by a space.

    Words are split at ``[\\x20\\x09-\\x0D]``. A run is a longest stretch with a period,
    of at least ``min_length`` words and ``min_exponent`` (2 or more) periods. Null and
    empty texts have no words, no runs and an empty ``collapsed``. Repeated rows are
    judged each. Columns of these three names are replaced, all others are kept.
    """
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has at least two periods and one word")
    ready(documents.sparkSession)
    rows = documents.drop("n_words", "runs", "collapsed")
    at = rows.columns.index(text)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.large_string()).cast(pa.large_binary())
            split: list[list[bytes]] = []
            found: dict[int, list[tuple[int, int, int]]] = {}
            held, first = 0, 0
            for value in texts:
                plain = value.as_py() or b""
                split.append(plain.split())
                held += len(plain)
                if held >= TOGETHER:
                    found |= {first + t: r for t, r in _search(split[first:], min_length, min_exponent).items()}
                    held, first = 0, len(split)
            found |= {first + t: r for t, r in _search(split[first:], min_length, min_exponent).items()}
            names = ("start", "length", "period")
            runs = [[dict(zip(names, run, strict=True)) for run in found.get(i, ())] for i in range(len(split))]
            collapsed = [_collapsed(words, found.get(i, [])) for i, words in enumerate(split)]
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in names]))
            more = {
                "n_words": pa.array([len(words) for words in split], pa.int64()),
                "runs": pa.array(runs, kind),
                "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *more.values()], names=[*batch.schema.names, *more])

    return rows.mapInArrow(judged, widened(rows, n_words="long", runs=RUNS, collapsed="string"))


def run_digests(judged: DataFrame) -> DataFrame:
    """Adds what sums up the runs: their number, the one of greatest exponent (least
    start, then period, of equal ones) and hashes of the list and of ``collapsed``.
    Replaces columns of these names."""
    exponent = lambda r: r["length"].cast("double") / r["period"]
    ranked = F.transform(
        "runs",
        lambda r: F.struct(
            exponent(r).alias("e"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("n")
        ),
    )
    best = F.array_max(ranked)
    start, period, length = -best["s"], -best["p"], best["n"]
    lines = F.transform(
        "runs",
        lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")),
    )
    return judged.withColumns(
        {
            "n_runs": F.size("runs").cast("long"),
            "start": start,
            "length": length,
            "period": period,
            "exponent_milli": ((length * 1000 - (length * 1000) % period) / period).cast("long"),
            "runs_sha256": F.sha2(F.concat_ws("", lines).cast("binary"), 256),
            "collapsed_sha256": F.sha2(F.col("collapsed").cast("binary"), 256),
        }
    )
