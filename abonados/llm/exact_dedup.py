"""Exact deduplication with a split of heavy hitters, in built-in functions only.

A summary of frequent items (Misra-Gries counters that are purged together, Spark's
``approx_top_k``) names the digests that may be hot. How often they really occur and
which of their rows stays is then counted exactly; these few winners are broadcast and
settle the hot rows where they are read. All other rows are shuffled by digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from abonados.llm.common import SPACES, stored


def _digested(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """Only the id, the digest of the text without white space, and the text's length."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return documents.select(
        F.col(id_column).alias("_id"),
        F.unhex(F.sha2(F.translate(whole, SPACES, "").cast("binary"), 256)).alias("_digest"),
        F.char_length(whole).alias("_length"),
    )


def frequent_digests(digested: DataFrame, most: int, counters: int) -> list[bytes]:
    """At most ``most`` digests that may be frequent; the summary holds ``counters`` of
    them in every task, whatever the number of rows."""
    top = digested.agg(F.expr(f"approx_top_k(base64(_digest), {most}, {counters})").alias("top"))
    rows = top.selectExpr("inline(top)").filter("count > 1").selectExpr("unbase64(item) AS digest")
    return [bytes(row.digest) for row in rows.collect()]


def _winners(rows: DataFrame) -> DataFrame:
    """Per digest its size and the row that stays: the longest text, then the least id."""
    best = F.struct((-F.col("_length")).alias("l"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"))
    return (
        rows.groupBy("_digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.min(best).alias("_best"))
        .select("_digest", "group_size", F.col("_best.i").alias("keep_id"), (-F.col("_best.l")).alias("_longest"))
    )


def _judged(documents: DataFrame, id_column: str, text: str, heavy: int, counters: int) -> DataFrame:
    """Every row with the id of the one that stays and whether it is that one."""
    rows = _digested(documents, id_column, text)
    hot = frequent_digests(rows, heavy, counters)
    is_hot = F.col("_digest").isin([F.lit(bytearray(d)) for d in hot]) if hot else F.lit(False)
    rest = rows.filter(~is_hot)
    by_digest = Window.partitionBy("_digest")
    best = F.struct((-F.col("_length")).alias("l"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"))
    judged = (
        rest.withColumn("group_size", F.count(F.lit(1)).over(by_digest))
        .withColumn("_best", F.min(best).over(by_digest))
        .withColumn("keep_id", F.col("_best.i"))
        .withColumn("_longest", -F.col("_best.l"))
        .drop("_best")
    )
    if hot:
        hot_rows = rows.filter(is_hot)
        judged = judged.unionByName(hot_rows.join(F.broadcast(_winners(hot_rows)), "_digest"))
    stays = F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_length") == F.col("_longest"))
    return judged.select("_id", "_digest", "_length", "keep_id", "group_size", stays.alias("kept"))


def duplicate_report(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", heavy: int = 64, counters: int = 4096
) -> DataFrame:
    """One row per document, dropped ones too: the id, ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256``. Other columns of the input are left aside.

    Texts are equal if they are after white space is deleted; null counts as empty. The
    row with the most code points stays, then the least id, null ids last. Rows that
    agree in id and text count one by one and have the same flags. An empty table gives
    an empty report. At most ``heavy`` winners are broadcast, one short row each.
    """
    judged = _judged(documents, id_column, text, heavy, counters)
    return judged.select(
        F.col("_id").alias(id_column),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def deduplicate(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", heavy: int = 64, counters: int = 4096
) -> DataFrame:
    """The rows that stay, whole and with the input's columns: one per distinct text.

    Which rows go is settled on narrow rows; the whole rows travel once, by id, so a
    large group of copies meets in no task. Rows that agree in id and text count once.
    """
    report = stored(_judged(documents, id_column, text, heavy, counters), "copies")
    lost = report.filter(~F.col("kept")).select("_id", "_digest", "_length").distinct()
    repeated = report.filter("kept").groupBy("_digest").count().filter("count > 1").limit(1).count()
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = documents.withColumns(
        {
            "_own_digest": F.unhex(F.sha2(F.translate(whole, SPACES, "").cast("binary"), 256)),
            "_own_length": F.char_length(whole),
        }
    )
    same = (
        marked[id_column].eqNullSafe(lost["_id"])
        & (marked["_own_digest"] == lost["_digest"])
        & (marked["_own_length"] == lost["_length"])
    )
    kept = marked.join(lost, same, "left_anti")
    if repeated:
        kept = kept.dropDuplicates(["_own_digest"])
    return kept.drop("_own_digest", "_own_length")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS kept,
       text_sha256
FROM d
"""
