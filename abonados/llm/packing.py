"""Packing documents into sequences of fixed length by the sum-of-squares rule.

A piece goes where the sum of the squared numbers of open sequences per residual gap
becomes smallest. The rule looks at all open sequences, so it works on shards of a fixed
number of pieces; a shard is large enough that its last open sequences do not count. The
rule keeps gaps even for pieces to come; when none come, what stands in sequences left
open is placed once more, each piece where the least gap remains.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abonados.llm.common import ready, stored, widened
from abonados.llm.encoder import encoder, vocabulary

#: The pieces that one task packs.
SHARD = 65_536
#: What ends a document.
END_ID = 0


def cut(
    documents: DataFrame,
    tokenizer: str | None = None,
    size: int = 2048,
    id_column: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents: the id, ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, if wanted, ``ids`` (little-endian 32-bit integers).

    A document is its ids and one end id; only if it is longer than ``size`` it is cut.
    Null and empty texts are one piece with the end id alone. Repeated rows are pieces
    each, null ids stay null, and other columns are left aside.
    """
    ready(documents.sparkSession)
    path = tokenizer or vocabulary()
    rows = documents.select(F.col(id_column).alias("doc"), F.col(text).cast("string").alias("text"))
    end = np.array([END_ID], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            docs: list[int] = []
            numbers, starts, lengths, sums, kept = [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                ids = encode(value.as_py() or "") + end
                for number, at in enumerate(range(0, len(ids), size * 4)):
                    part = ids[at : at + size * 4]
                    docs.append(row)
                    numbers.append(number)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(part)
            columns = {
                "doc": batch.column(0).take(pa.array(docs, pa.int64())),
                "piece": pa.array(numbers, pa.int32()),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(pieces, schema).withColumnRenamed("doc", id_column)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For pieces in their order: the sequence that each goes to, and its offset there.

    A piece of length s that goes from gap g to g - s changes the sum of squares by
    2 (1 - N[g] + N[g - s]), and a new sequence by 1 + 2 N[size - s]; full sequences do
    not count. Of equal choices the smallest gap is taken, and a new sequence last.
    """
    open_with = np.zeros(size + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    sequences, offsets, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    far = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        choices = np.where(open_with[s:size] > 0, 2 * (1 - open_with[s:size]) + 2 * open_with[: size - s], far)
        if len(choices) and open_with[s]:
            choices[0] = 1 - 2 * open_with[s]
        fresh = 1 + 2 * open_with[size - s] if s < size else 0
        best = int(np.argmin(choices)) if len(choices) else -1
        if best >= 0 and choices[best] <= fresh:
            gap = best + s
            sequence = stacks[gap].pop()
            open_with[gap] -= 1
        else:
            gap, sequence, used = size, used, used + 1
        left = gap - s
        if left:
            stacks[left].append(sequence)
            open_with[left] += 1
        sequences[i], offsets[i] = sequence, size - gap
    return sequences, offsets


def refit(lengths: np.ndarray, sequences: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A placement of pieces in descending order with the pieces of sequences that are not
    full placed again by best fit, where that takes fewer sequences."""
    if not len(lengths):
        return sequences, offsets
    filled = np.bincount(sequences, weights=lengths)
    moved = np.flatnonzero(filled[sequences] < size)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    is_open = np.zeros(size + 1, bool)
    places, starts, used = np.empty(len(moved), np.int64), np.empty(len(moved), np.int64), 0
    for i, s in enumerate(lengths[moved].tolist()):
        gap = s + int(np.argmax(is_open[s:]))
        if is_open[gap]:
            sequence = stacks[gap].pop()
            is_open[gap] = bool(stacks[gap])
        else:
            gap, sequence, used = size, used, used + 1
        if gap > s:
            stacks[gap - s].append(sequence)
            is_open[gap - s] = True
        places[i], starts[i] = sequence, size - gap
    if used >= np.count_nonzero(filled < size):
        return sequences, offsets
    sequences, offsets = sequences.copy(), offsets.copy()
    sequences[moved], offsets[moved] = places + len(filled), starts
    return sequences, offsets


def pack(pieces: DataFrame, size: int = 2048, shard: int = SHARD) -> DataFrame:
    """``pieces`` (with ``length``) and their ``sequence_id`` and ``offset``.

    Pieces that fill a sequence have one of their own. The others are dealt evenly to
    shards, and each shard is packed longest first, then ``refit``. Columns of these two names are
    replaced. No pieces give no sequences; rows of null or impossible length raise.
    """
    ready(pieces.sparkSession)
    pieces = pieces.drop("sequence_id", "offset")
    partial = F.col("length") < size
    held = stored(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    count = held.filter(partial).count()
    shards = max(1, -(-count // shard))
    names = held.columns
    full = held.filter(~partial).select(
        *names, (-F.col("_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    dealt = held.filter(partial).repartition(shards)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got).sort_by([("length", "descending"), ("_row", "ascending")])
        lengths = rows.column("length").to_numpy()
        sequences, offsets = refit(lengths, *sum_of_squares(lengths, size), size)
        # a sequence is named by a row that stands in it at the start
        first = np.empty(int(sequences.max()) + 1, np.int64)
        begins = offsets == 0
        first[sequences[begins]] = rows.column("_row").to_numpy()[begins]
        rows = rows.append_column("sequence_id", pa.array(first[sequences]))
        yield from rows.append_column("offset", pa.array(offsets)).to_batches(10_000)

    schema = widened(held, sequence_id="long", offset="long")
    return dealt.mapInArrow(packed, schema).unionByName(full).drop("_row")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that carry ``ids``: ``sequence_id``,
    ``length`` and ``ids`` in order of the offsets. A group is one sequence."""
    part = F.struct("offset", "ids")
    ordered = F.transform(F.array_sort(F.collect_list(part)), lambda p: p["ids"])
    joined = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda done, ids: F.concat(done, ids))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
