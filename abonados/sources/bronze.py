"""Raw documents: reading JSON and numbering the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DOCUMENT, LOADED_AT, ROW_ID = "data", "_loaded_at", "_row_id"
#: Text of an array that is parsed at a time, unless one element is longer.
SEGMENT_BYTES = 256 << 10
#: Chunks of an array file for each row that tells where elements end.
CELL_CHUNKS = 4096
#: What may stand around an element.
BLANKS = " \t\n\x0b\f\r"


def read_lines(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    """Documents from JSON lines, one variant each. Files are split over tasks.

    ``mode`` is Spark's: a malformed line fails the load (``FAILFAST``), is
    dropped (``DROPMALFORMED``) or becomes a NULL row (``PERMISSIVE``).
    """
    return (
        spark.read.option("singleVariantColumn", DOCUMENT)
        .option("mode", mode)
        .json(path)
    )


def _occurrences(text: Column, letter: str) -> Column:
    """How often an ASCII character occurs."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(letter), F.lit("")))


def _opened(text: Column) -> Column:
    """Opened less closed, but for closing braces: chunks hold none."""
    return _occurrences(text, "{") + _occurrences(text, "[") - _occurrences(text, "]")


def _chunks(spark: SparkSession, path) -> DataFrame:
    """Files cut behind every closing brace, whatever it closes. Byte ranges of a file are
    read by different tasks: ``file`` and ``key`` (its path, and a hash of it that narrow rows
    carry instead), ``block`` (where the range starts), ``at`` (grows with the position),
    ``chunk``."""
    cut = spark.read.option("lineSep", "}").text(path)
    return cut.select(
        F.col("_metadata.file_path").alias("file"),
        F.xxhash64("_metadata.file_path").alias("key"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("chunk"),
    )


def _counted(chunks: DataFrame) -> DataFrame:
    """Adds ``counts`` to chunks: their bytes, their quotes, and how much deeper they end than
    they began if they begin outside of a string, and inside."""
    escaped = F.col("chunk").contains("\\")
    plain = F.when(escaped, F.regexp_replace("chunk", r"(?s)\\.", "")).otherwise(F.col("chunk"))
    # Each step is a column, computed once. Escaped characters are gone from the plain text,
    # so every quote opens or closes, and what is outside of strings if the chunk begins
    # outside is inside if it begins inside. Most of a text goes first.
    cut = chunks.withColumn("plain", plain).withColumn("marks", F.regexp_replace("plain", r'[^"{\[\]]++', ""))
    cut = cut.withColumn("bare", F.regexp_replace("marks", '"[^"]*+"?', ""))
    counted = cut.select(
        *chunks.columns,
        F.octet_length("chunk").alias("bytes"),
        _occurrences(F.col("marks"), '"').alias("quotes"),
        _opened(F.col("marks")).alias("all"),
        _opened(F.col("bare")).alias("outside"),
    )
    deeper = []
    for inside, opened in ((0, F.col("outside")), (1, F.col("all") - F.col("outside"))):
        closes = F.when((F.col("quotes") + inside) % 2 == 0, 1).otherwise(0)
        deeper.append(opened - closes)
    return counted.select(*chunks.columns, F.array("bytes", "quotes", *deeper).alias("counts"))


def _with_ends(chunks: DataFrame) -> DataFrame:
    """Marks the chunks that end an element of the outer array: ``ends``. ``reach`` is the
    bytes of a range up to the chunk's end.

    Whether a range begins inside of a string and how deep it is nested is unknown to the
    task that reads it, so each range is summed up for both cases. The sums are one row
    per range; running totals over them tell which case holds, and how deep.
    """
    within = Window.partitionBy("key", "block").orderBy("at")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    # an array is shuffled whole, so what is summed up and what is marked come from one shuffle
    local = chunks.repartition("key", "block")
    local = local.withColumns({name: F.col("counts")[i] for i, name in enumerate(("bytes", "quotes", "deeper0", "deeper1"))})
    local = local.withColumn("quoted", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    for case in (0, 1):
        step = F.when(F.col("quoted") == case, F.col("deeper0")).otherwise(F.col("deeper1"))
        local = local.withColumn(f"step{case}", step)
    local = local.withColumns({f"depth{case}": F.sum(f"step{case}").over(upto) for case in (0, 1)})
    local = local.withColumn("reach", F.sum(F.col("bytes") + 1).over(upto))
    ranges = local.groupBy("key", "block").agg(
        F.sum("quotes").alias("quotes"), F.sum("step0").alias("step0"), F.sum("step1").alias("step1"), F.max("at").alias("last")
    )
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    step = F.when(F.col("inside") == 0, F.col("step0")).otherwise(F.col("step1"))
    ranges = ranges.withColumn("step", step).select(
        "key",
        "block",
        "inside",
        F.coalesce(F.sum("step").over(before), F.lit(0)).alias("base"),
        F.max("last").over(Window.partitionBy("key")).alias("last"),
    )
    joined = local.join(ranges, ["key", "block"])
    depth = F.col("base") + F.when(F.col("inside") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    outside = (F.col("inside") + F.col("quoted") + F.col("quotes")) % 2 == 0
    final = F.col("at") == F.col("last")
    return joined.select(
        *[name for name in chunks.columns if name != "counts"], "reach", final.alias("final"), depth.alias("depth"),
        ((depth == 1) & outside & ~final).cast("int").alias("ends"),
    )


def _elements(chunks: DataFrame) -> DataFrame:
    """``file``, ``number`` and ``text`` of every element, put together from its chunks.
    What follows the last element has a number of its own."""
    earlier = Window.partitionBy("key", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = chunks.groupBy("key", "block").agg(F.sum("ends").alias("ends"))
    ranges = ranges.select("key", "block", F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("base"))
    numbered = chunks.withColumn("here", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
    numbered = numbered.join(ranges, ["key", "block"]).withColumn("number", F.col("base") + F.col("here"))
    part = F.struct("at", "chunk", "final", "depth")
    whole = numbered.groupBy("file", "number").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["chunk"]), "}")
    last = F.element_at("parts", -1)
    text = F.when(last["final"], joined).otherwise(F.concat(joined, F.lit("}")))
    return whole.select("file", "number", text.alias("text"), last["final"].alias("final"), last["depth"].alias("depth"))


def _segments(chunks: DataFrame, marked: DataFrame) -> DataFrame:
    """``file``, ``number`` and ``text`` of runs of whole elements, in order, of about
    ``SEGMENT_BYTES``; what follows the last element belongs to the last run.

    ``marked`` are the chunks without file and text. Where runs end is one narrow row for each
    ``CELL_CHUNKS`` chunks, which every task gets: so texts are shuffled once, straight to
    the order's ranges, and only as they were read.
    """
    cell = F.expr(f"at DIV {CELL_CHUNKS}").alias("cell")
    slot = F.expr(f"reach DIV {SEGMENT_BYTES}").alias("slot")
    ends = marked.groupBy("key", "block", cell, slot).agg(
        F.min(F.when(F.col("ends") == 1, F.col("at"))).alias("end"), F.max(F.when(F.col("final"), F.col("depth"))).alias("depth")
    )
    cells = ends.groupBy("key", "block", "cell").agg(F.collect_list("end").alias("ends"), F.max("depth").alias("depth"))
    whole = Window.partitionBy("key")
    before = whole.orderBy("block", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "key", "block", "cell", "ends",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("base"),
        F.sum(F.size("ends")).over(whole).alias("last"),
        F.max("depth").over(whole).alias("depth"),
    )
    found = chunks.withColumn("cell", cell).join(F.broadcast(cells), ["key", "block", "cell"], "left")
    ended = F.size(F.filter("ends", lambda end: end < F.col("at")))
    # both passes over a file cut the same ranges; if a cluster changes in between, none is lost
    number = F.coalesce(F.col("base") + ended, F.raise_error("ranges of array files changed while they were read").cast("bigint"))
    found = found.select("file", number.alias("number"), "block", "at", "chunk", "last", "depth")
    placed = found.repartitionByRange("file", "number")
    part = F.struct("block", "at", "chunk")
    runs = placed.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(part)).alias("parts"), F.max(F.col("number") == F.col("last")).alias("final"), F.max("depth").alias("depth")
    )
    joined = F.array_join(F.transform("parts", lambda p: p["chunk"]), "}")
    text = F.when(F.col("final"), joined).otherwise(F.concat(joined, F.lit("}")))
    return runs.select("file", "number", text.alias("text"), "final", "depth").sortWithinPartitions("file", "number")


def read_arrays(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    """Documents from files that each hold one JSON array, in the order of the files'
    names and of the array.

    A file of any size is read by many tasks, a byte range each; only its elements are
    parsed. ``mode`` is that of ``read_lines``, and applies to elements. Of a file that does
    not begin with ``[``, the first element is malformed, and of one that does not end
    with the ``]`` that closes it, the last.
    """
    modes = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")
    if mode not in modes:
        raise ValueError(f"mode is one of {modes}")
    chunks = _chunks(spark, path)
    # Texts are put in order before they are parsed: a sort runs what is below it twice.
    if mode == "FAILFAST":
        # one malformed element fails all, so elements need not be told apart before
        elements = _segments(chunks, _with_ends(_counted(chunks).drop("file", "chunk")))
    else:
        elements = _elements(_with_ends(_counted(chunks))).orderBy("file", "number")
    first, final = F.col("number") == 0, F.col("final")
    begun = F.ltrim("text", F.lit(BLANKS))
    lead = F.when(first, "[").otherwise(",")
    body = F.when(begun.startswith(lead), F.substring(begun, 2, 2**31 - 1)).otherwise(F.col("text"))
    ended = F.rtrim(body, F.lit(BLANKS))
    body = F.when(final & ended.endswith("]"), F.left(ended, F.length(ended) - 1)).otherwise(body)
    # outside of the array is one brace less than before it, for the one that is not there
    whole = ~first | begun.startswith("[")
    whole &= ~final | ((F.col("depth") == -1) & F.rtrim("text", F.lit(BLANKS)).endswith("]"))
    listed = F.concat(F.lit("["), body, F.lit("]"))
    if mode == "FAILFAST":
        whole &= first | begun.startswith(",") | begun.startswith("]")
        broken = F.raise_error(F.concat(F.lit("no JSON array of whole elements: "), F.col("file")))
        parsed = F.parse_json(F.when(whole, listed).otherwise(broken.cast("string")))
    else:
        parsed = F.try_parse_json(F.when(whole, listed))
    found = F.variant_get(parsed, "$", "array<variant>")
    if mode == "PERMISSIVE":
        rows = elements.select(found.alias("found"))
        # what follows the last element is empty as a rule, which is no malformed element
        rows = rows.filter(F.col("found").isNull() | (F.size("found") > 0))
        return rows.select(F.explode_outer("found").alias(DOCUMENT))
    # not by a column: Spark would filter empty ones below the sort, and parse there too
    return elements.select(F.explode(found).alias(DOCUMENT))


def as_bronze(documents: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Adds the load time, constant in one load, and a unique row number.

    The row number grows with the position in a file and leaves gaps between
    partitions, so no second pass and no single task is needed. It is stored with
    the row; later layers must never compute it again.
    """
    return documents.select(
        F.col(DOCUMENT),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias(LOADED_AT),
        (F.monotonically_increasing_id() + 1).alias(ROW_ID),
    )
