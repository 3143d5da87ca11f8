"""Packing by the histogram of lengths, the shortest pack first.

All documents of one length are alike to the packer, so it works on counts. Lengths are
placed from the longest to the shortest, each time into the packs with most room, and
the counts of the packing patterns are updated; packs of one pattern are numbered in a
row. As many packs are open as the tokens need, and those left over open packs of powers
of two, so that room and tokens are equal. A length that no pack has room for is cut:
the first part fills a pack, the rest returns to the histogram. Documents then find
their parts by their rank among documents of their length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from abonados.llm.common import ready, stored
from abonados.llm.encoder import encoder, vocabulary

#: What ends a document.
END_ID = 1
#: Ranks within one length stay below this, so length and rank fit one number.
RANKS = 1 << 48


@dataclass(frozen=True)
class Plan:
    """Where documents go, by length and rank, and what the packs look like.

    ``parts[k]`` holds the k-th parts of documents as rows (length * RANKS + first rank,
    number of ranks, part's start, part's length, first pack, offset there), ordered.
    ``patterns`` are (lengths with their times, first pack, number of packs). Both are
    bounded by the size of a pack, whatever the number of documents.
    """

    parts: list[np.ndarray]
    patterns: list[tuple[tuple[tuple[int, int], ...], int, int]]


def _grown(pattern: tuple[tuple[int, int], ...], length: int) -> tuple[tuple[int, int], ...]:
    if pattern and pattern[-1][0] == length:
        return (*pattern[:-1], (length, pattern[-1][1] + 1))
    return (*pattern, (length, 1))


def shortest_pack_first(histogram: dict[int, int], size: int) -> Plan:
    """Packs lengths from 1 to ``size``, given with their counts, into packs of at most
    ``size``: as many full ones as there are tokens for, and one pack of each power of
    two that makes up the rest (of a ``size`` that is no such power likewise)."""
    total = sum(length * count for length, count in histogram.items())
    packs, rest = divmod(total, size)
    # most room first, then the lowest pack: (room, first pack, packs, filled, pattern)
    rooms = [(-size, 0, packs, 0, ())] if packs else []
    for k in range(rest.bit_length() - 1, -1, -1):
        if rest >> k & 1:
            rooms.append((-(1 << k), packs, 1, 0, ()))
            packs += 1
    heapq.heapify(rooms)
    waiting: list[list[tuple[int, int, int, int, int]]] = [[] for _ in range(size + 1)]
    for length, count in histogram.items():
        if count:
            waiting[length].append((length, 0, count, 0, 0))
    parts: list[list[tuple[int, int, int, int, int, int]]] = []
    patterns = []
    for length in range(size, 0, -1):
        for origin, rank, count, start, level in waiting[length]:
            while count:
                room, pack, many, filled, pattern = heapq.heappop(rooms)
                part, n = min(length, -room), min(count, many)
                if level == len(parts):
                    parts.append([])
                parts[level].append((origin * RANKS + rank, n, start, part, pack, filled))
                if part < length:
                    waiting[length - part].append((origin, rank, n, start + part, level + 1))
                grown = _grown(pattern, part)
                if room + part:
                    heapq.heappush(rooms, (room + part, pack, n, filled + part, grown))
                else:
                    patterns.append((grown, pack, n))
                if n < many:
                    heapq.heappush(rooms, (room, pack + n, many - n, filled, pattern))
                rank, count = rank + n, count - n
    return Plan([np.array(sorted(rows), np.int64) for rows in parts], patterns)


def encoded(
    documents: DataFrame, size: int, tokenizer: str | None, id_column: str, text: str
) -> tuple[DataFrame, int]:
    """Stored rows ``doc``, ``ids``, ``doc_tokens``, ``block`` (the task that wrote it) and
    the ranks within the block: ``full_rank`` of its first full piece among full pieces
    and ``tail_rank`` of what remains, among those of the same length. Also the bytes of
    an id as stored."""
    path = tokenizer or vocabulary()
    width = 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4
    end = np.array([END_ID], "<u4").tobytes()
    rows = documents.select(F.col(id_column).alias("doc"), F.col(text).cast("string").alias("text"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block = encoder(path), TaskContext.get().partitionId()
        used = np.zeros(size + 1, np.int64)
        for batch in batches:
            ids, lengths, full, tail = [], [], [], []
            for value in batch.column(1):
                row = encode(value.as_py() or "") + end
                whole, left = divmod(len(row) // 4, size)
                lengths.append(len(row) // 4)
                full.append(int(used[size]))
                tail.append(int(used[left]))
                used[size] += whole
                if left:
                    used[left] += 1
                ids.append(np.frombuffer(row, "<u4").astype(f"<u{width}").tobytes())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": batch.column(0),
                    "ids": pa.array(ids, pa.binary()),
                    "doc_tokens": pa.array(lengths, pa.int64()),
                    "block": pa.array([block] * len(ids), pa.int32()),
                    "full_rank": pa.array(full, pa.int64()),
                    "tail_rank": pa.array(tail, pa.int64()),
                }
            )

    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, ids binary, doc_tokens long, block int, full_rank long, tail_rank long"
    return stored(rows.mapInArrow(numbered, schema), "encoded"), width


def _counted(held: DataFrame, size: int) -> DataFrame:
    """``block``, ``length`` and ``n``: how many pieces of this length a block holds."""
    piece = F.inline(
        F.array(
            F.struct((F.col("doc_tokens") % size).alias("length"), F.lit(1).cast("long").alias("n")),
            F.struct(F.lit(size).cast("long").alias("length"), F.floor(F.col("doc_tokens") / size).alias("n")),
        )
    )
    pieces = held.select("block", piece).filter("length > 0 AND n > 0")
    return pieces.groupBy("block", "length").agg(F.sum("n").alias("n"))


def pack_by_histogram(
    documents: DataFrame,
    tokenizer: str | None = None,
    size: int = 2048,
    id_column: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Where every token of every document stands in sequences of at most ``size`` tokens:
    a row per piece with the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and, if wanted, ``ids`` (little-endian 32-bit integers).

    A document is its ids and one end id. Full pieces of long documents are sequences of
    their own; other documents are whole, or cut where only so they fill a sequence. No
    sequence needs padding: all are full, but for one of each power of two that makes up
    the rest. Null and empty texts are the end id alone, repeated rows are packed each,
    null ids stay null, an empty table has no pieces, other columns are left aside.
    """
    if not 1 <= size < 1 << 15:
        raise ValueError("sequences of 1 to 32767 tokens")
    ready(documents.sparkSession)
    held, width = encoded(documents, size, tokenizer, id_column, text)
    counts = stored(_counted(held, size), "lengths")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n"))
    # a row per length: bounded by the size of a sequence
    plan = shortest_pack_first({r["length"]: r["n"] for r in totals.collect()}, size)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # a row per block, with the ranks at which its lengths begin
    begins = ranks.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("begin"))
    ranked = held.join(begins, "block").select(
        "doc",
        "ids",
        (F.col("full_rank") + F.coalesce(F.col("begin")[F.lit(size).cast("long")], F.lit(0))).alias("full"),
        (F.col("tail_rank") + F.coalesce(F.col("begin")[F.col("doc_tokens") % size], F.lit(0))).alias("tail"),
    )
    parts = plan.parts

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held_ids = [np.frombuffer(v.as_buffer(), f"<u{width}").astype("<u4").tobytes() for v in batch.column(1)]
            tokens = np.array([len(ids) // 4 for ids in held_ids], np.int64)
            whole, left = tokens // size, tokens % size
            full, tail = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            of_full = np.repeat(np.arange(len(tokens)), whole)
            number = np.arange(len(of_full)) - np.repeat(np.cumsum(whole) - whole, whole)
            of_tail = np.flatnonzero(left)
            row = np.concatenate([of_full, of_tail])
            key = np.concatenate([size * RANKS + full[of_full] + number, left[of_tail] * RANKS + tail[of_tail]])
            begin = np.concatenate([number * size, whole[of_tail] * size])
            found = []
            for table in parts:
                at = np.searchsorted(table[:, 0], key, side="right") - 1
                hit = (at >= 0) & (key - table[at, 0] < table[at, 1])
                row, key, begin, at = row[hit], key[hit], begin[hit], at[hit]
                if not len(row):
                    break
                chosen = table[at]
                found.append((row, begin + chosen[:, 2], chosen[:, 3], chosen[:, 4] + key - chosen[:, 0], chosen[:, 5]))
            if not found:
                continue
            row, start, length, sequence, offset = (np.concatenate(column) for column in zip(*found, strict=True))
            pieces = [
                held_ids[r][4 * s : 4 * (s + n)]
                for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)
            ]
            columns = {
                "doc": batch.column(0).take(pa.array(row)),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array([zlib.crc32(piece) for piece in pieces], pa.int64()),
                "doc_tokens": pa.array(tokens[row]),
                "sequence_id": pa.array(sequence),
                "offset": pa.array(offset),
            }
            if with_ids:
                columns["ids"] = pa.array(pieces, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    kind = ranked.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranked.mapInArrow(placed, schema + ", ids binary" * with_ids).withColumnRenamed("doc", id_column)
