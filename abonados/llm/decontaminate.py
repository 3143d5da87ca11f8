"""Benchmark decontamination as a prefix-filtered join, in built-in functions only.

An item is cut into windows of consecutive words. A document that contains a window
contains its rarest word, so that one word is the window's necessary prefix: words are
ordered by how many documents have them, and only where a document has the rarest word
of some window is the window looked at. The place of the word bounds where the window
may begin and end in the document, and there the words themselves are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from abonados.llm.common import lower_ascii, stored, unused

#: What separates words: everything in ASCII that is no letter or digit.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Up to so many words of benchmarks are kept in the filter of a scan, which then gives
#: no row for other words; more are joined.
FILTER_WORDS = 50_000


def words_of(text: Column) -> Column:
    """The words of a text in lower case (A-Z only); none for null."""
    parts = F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS)
    return F.filter(parts, lambda word: word != "")


def item_windows(benchmark: DataFrame, window: int, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """Every window of every item: ``item``, its ``words`` and ``window``, the same words
    as one text. An item of fewer words is one window; one without words has none."""
    items = benchmark.select(F.col(id_column).cast("string").alias("item"), words_of(F.col(text)).alias("all"))
    size = F.least(F.size("all"), F.lit(window))
    begins = items.filter(F.size("all") > 0).select(
        "item", "all", F.explode(F.sequence(F.lit(1), F.size("all") - size + 1)).alias("begin")
    )
    cut = begins.select("item", F.slice("all", F.col("begin"), size).alias("words"))
    return cut.withColumn("window", F.array_join("words", " ")).distinct()


def _found(documents: DataFrame, words: list[str] | DataFrame) -> DataFrame:
    """Rows (``uid``, ``word``) for words of a document that are among ``words``."""
    if isinstance(words, list):
        chosen = F.filter(F.array_distinct("words"), lambda word: word.isin(words))
        return documents.select(F.explode(chosen).alias("word"))
    return documents.select(F.explode(F.array_distinct("words")).alias("word")).join(words, "word", "left_semi")


def _short_list(words: DataFrame) -> list[str] | DataFrame:
    listed = [row.word for row in words.limit(FILTER_WORDS + 1).collect()]
    return listed if len(listed) <= FILTER_WORDS else words


def prefix_words(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` with ``word``, the one that fewest documents have (then the least), and
    ``place``, where it first stands in the window, from 0."""
    vocabulary = stored(windows.select(F.explode("words").alias("word")).distinct(), "vocabulary")
    listed = _short_list(vocabulary)
    if isinstance(listed, list) and not listed:
        return windows.select("*", F.lit("").alias("word"), F.lit(0).alias("place"))
    rarity = _found(documents, listed).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    each = windows.select("window", "words", F.posexplode("words").alias("place", "word")).join(rarity, "word", "left")
    rarest = each.groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("word"), F.col("place"))).alias("r")
    )
    # a window with a word that no document has occurs nowhere
    rarest = rarest.filter("r.n > 0").select("window", F.col("r.word").alias("word"), F.col("r.place").alias("place"))
    return windows.join(rarest, "window")


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    share: int = 20,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_hit`` (words inside an occurrence of
    a window), ``n_items``, ``item_ids`` (sorted texts of the items that occur),
    ``items_sha256`` (of the ids joined by commas) and ``contaminated``: at least one word
    in ``share`` is hit.

    Null and empty texts have no words. Null items and items without words have no
    windows, so with an empty benchmark no document is hit. Repeated rows are judged each
    for itself; a benchmark may repeat items. Other columns of the input are left aside.
    """
    documents = documents.select(
        F.col(id_column).alias("id"), words_of(F.col(text)).alias("words"), F.monotonically_increasing_id().alias("uid")
    )
    windows = item_windows(benchmark, window, item_column, item_text)
    windows = stored(prefix_words(documents, windows).withColumn("size", F.size("words")), "windows")
    prefixes = _short_list(windows.select("word").distinct())

    # where a prefix word stands, with the words around it that a window could span
    reach = window - 1
    around = lambda i: F.struct(
        i.alias("at"),
        F.element_at("words", i + 1).alias("word"),
        F.least(i, F.lit(reach)).alias("before"),
        F.array_join(
            F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + 1 + reach), " "
        ).alias("near"),
    )
    if isinstance(prefixes, list):
        found = F.filter(
            F.transform("words", lambda word, i: F.when(word.isin(prefixes) if prefixes else F.lit(False), i)),
            lambda i: i.isNotNull(),
        )
        places = F.transform(found, around)
    else:
        places = F.transform("words", lambda word, i: around(i))
    placed = documents.select("uid", "id", F.size("words").alias("n_words"), F.explode_outer(places).alias("p"))
    # every document has a row here, also without such a word; its number holds from here on
    placed = stored(placed.select("uid", "id", "n_words", "p.*"), "placed")

    # bounds: the window begins and ends inside the document; then the words are compared
    begin = F.col("before") - F.col("place")
    fits = (begin >= 0) & (F.col("at") - F.col("place") + F.col("size") <= F.col("n_words"))
    same = F.array_join(F.slice(F.split("near", " "), F.greatest(begin, F.lit(0)) + 1, F.col("size")), " ")
    needed = windows.select("word", "place", "size", "window", "item")
    hits = (
        placed.filter(F.col("word").isNotNull())
        .join(needed, "word")
        .filter(fits & (same == F.col("window")))
        .select("uid", "id", "n_words", (F.col("at") - F.col("place")).alias("begin"), "size", "item")
    )
    hits = stored(hits.distinct(), "hits")

    spans = hits.groupBy("uid", "begin").agg(F.max(F.col("begin") + F.col("size")).alias("end"))
    before = Window.partitionBy("uid").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans.withColumn("from", F.greatest("begin", F.coalesce(F.max("end").over(before), F.lit(0))))
    counts = covered.groupBy("uid").agg(F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).alias("n_hit"))
    items = hits.groupBy("uid").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    judged = counts.join(items, "uid")
    everyone = placed.groupBy("uid").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"))
    return (
        everyone.join(judged, "uid", "left")
        .select(
            F.col("id").alias(id_column),
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
        .withColumn("items_sha256", F.sha2(F.array_join("item_ids", ",").cast("binary"), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    )


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that are not contaminated, whole and with the input's columns.

    Rows that agree in id and text are judged alike, so they stay or go together.
    """
    mark = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    keyed = documents.select(F.struct(F.col(id_column).alias("i"), mark.alias("m")).alias("doc_id"), F.col(text).alias("text"))
    dirty = contamination(keyed, benchmark, window, share).filter("contaminated").select("doc_id").distinct()
    id_name, mark_name, own = unused(documents, "_dirty", "_mark", "_own_mark")
    dirty = dirty.select(F.col("doc_id.i").alias(id_name), F.col("doc_id.m").alias(mark_name))
    marked = documents.withColumn(own, mark)
    same = marked[id_column].eqNullSafe(F.col(id_name)) & (F.col(own) == F.col(mark_name))
    return marked.join(dirty, same, "left_anti").drop(own)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
sizes AS (SELECT DISTINCT least(13, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT DISTINCT doc_id, i, dw.k AS k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""
