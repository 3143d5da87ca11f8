"""Token counts for every context limit, from one exact histogram of encoded lengths.

Documents are counted by length. Sums over the lengths from a limit upwards then answer
how many documents a limit cuts, how many tokens it keeps and what the quantiles are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from abonados.llm.common import ready
from abonados.llm.encoder import encoder, vocabulary

#: Lengths that are summed in one task; their sums are then summed over blocks.
BLOCK = 1024


def length_histogram(documents: DataFrame, tokenizer: str | None = None, text: str = "text") -> DataFrame:
    """``n_tokens`` and ``documents``: how many have this encoded length. Null and empty
    texts have length 0, repeated rows count each, an empty table has no lengths."""
    ready(documents.sparkSession)
    path = tokenizer or vocabulary()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            lengths = [len(encode(value.as_py() or "")) // 4 for value in batch.column(0)]
            values, counts = np.unique(np.array(lengths, np.int64), return_counts=True)
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(values), "n": pa.array(counts.astype(np.int64))})

    texts = documents.select(F.col(text).cast("string").alias("text"))
    lengths = texts.mapInArrow(counted, "n_tokens long, n long")
    return lengths.groupBy("n_tokens").agg(F.sum("n").alias("documents"))


def limits(histogram: DataFrame) -> DataFrame:
    """Each length of a histogram, read as a context limit: ``documents`` of that length,
    ``documents_longer`` (cut by the limit), ``tokens_longer`` (all their tokens),
    ``tokens_kept`` (of all documents, cut at the limit), ``tokens_total`` and
    ``quantile`` (the share of documents that fit).

    Sums run over lengths within a block and over whole blocks, so no task sees more than
    a block's lengths or one row per block.
    """
    tokens = F.col("n_tokens") * F.col("documents")
    rows = histogram.withColumns({"block": F.floor(F.col("n_tokens") / BLOCK), "tokens": tokens})
    whole = rows.groupBy("block").agg(F.sum("documents").alias("bd"), F.sum("tokens").alias("bt"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    whole = whole.select(
        "block",
        *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"{c}_after") for c in ("bd", "bt")],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in ("bd", "bt")],
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {c: F.coalesce(F.sum(c.removeprefix("in_")).over(inside), F.lit(0)) for c in ("in_documents", "in_tokens")}
    ).join(whole, "block")
    longer, tokens_longer = F.col("in_documents") + F.col("bd_after"), F.col("in_tokens") + F.col("bt_after")
    return rows.select(
        "n_tokens",
        "documents",
        longer.alias("documents_longer"),
        tokens_longer.alias("tokens_longer"),
        (F.col("bt_all") - tokens_longer + longer * F.col("n_tokens")).alias("tokens_kept"),
        F.col("bt_all").alias("tokens_total"),
        ((F.col("bd_all") - longer) / F.col("bd_all")).alias("quantile"),
    )


def kept_at(histogram: DataFrame, limit: int) -> DataFrame:
    """One row for any limit: ``documents``, ``documents_cut``, ``tokens_kept``, ``tokens_total``."""
    n, d = F.col("n_tokens"), F.col("documents")
    zero = F.lit(0).cast("long")
    return histogram.agg(
        F.coalesce(F.sum(d), zero).alias("documents"),
        F.coalesce(F.sum(F.when(n > limit, d)), zero).alias("documents_cut"),
        F.coalesce(F.sum(F.least(n, F.lit(limit)) * d), zero).alias("tokens_kept"),
        F.coalesce(F.sum(n * d), zero).alias("tokens_total"),
    )


def token_quantile(histogram: DataFrame, share: float) -> DataFrame:
    """The least length that at least ``share`` of the documents do not exceed, as ``n_tokens``."""
    return limits(histogram).filter(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))
