"""Language identification by compression with one dictionary for each language."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from abonados.llm.common import ready, widened

#: What a model reads: documents for each language, and characters of each of them.
SAMPLE_DOCUMENTS = 160
SAMPLE_CHARACTERS = 700
#: Compressor level, and the bytes that are compressed at a time: in a longer run the
#: text itself would become the dictionary.
LEVEL = 9
RUN_BYTES = 1500
#: Margins in bytes are taken at this scale to give a score.
BYTES_PER_UNIT = 2.0
#: Scores below this are too close to call.
LEAST_SCORE = 0.55
UNKNOWN = "und"


def train(
    documents: DataFrame,
    lang: str = "lang",
    text: str = "text",
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_characters: int = SAMPLE_CHARACTERS,
) -> dict[str, bytes]:
    """A raw-content dictionary for each language: passages from a bounded sample of
    labelled documents, the distinct texts with the least hashes. Copies count once.

    Rows with a null language, or a text without letters, are not learned from. The
    model holds at most ``sample_documents`` x ``sample_characters`` characters for each
    language; only these come to the driver.
    """
    usable = documents.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    order = F.xxhash64(F.col(text))
    begin = F.pmod(F.shiftright(order, 8), F.greatest(F.char_length(F.col(text)) - sample_characters, F.lit(0)) + 1)
    passages = usable.select(
        F.col(lang).cast("string").alias("lang"),
        order.alias("order"),
        F.substring(F.col(text), begin.cast("int") + 1, F.lit(sample_characters)).alias("passage"),
    )
    # narrow rows first: copies meet in the map tasks, and only chosen texts travel
    first = Window.partitionBy("lang").orderBy("order")
    least = passages.select("lang", "order").distinct().withColumn("rank", F.row_number().over(first))
    least = F.broadcast(least.filter(F.col("rank") <= sample_documents))  # so many rows for each language
    chosen = passages.join(least, ["lang", "order"]).groupBy("lang", "rank").agg(F.min("passage").alias("passage"))
    model: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "rank").collect():
        model.setdefault(row["lang"], []).append(row["passage"])
    return {name: "\n".join(parts).lower().encode() for name, parts in model.items()}


def identify(
    documents: DataFrame, model: dict[str, bytes], text: str = "text", least_score: float = LEAST_SCORE
) -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    A whole text in lower case is compressed, run by run, with every language's
    dictionary; the smallest sum wins, and of equal ones the first by name. The score falls with the margin in bytes
    over the others. Null texts and texts without letters are ``und`` with score 0. A
    document is rejected if it is ``und`` or the margin is narrow. Columns of these
    names are replaced. Without a language learned, every text is ``und``.
    """
    ready(documents.sparkSession)
    kept = documents.drop("lang_pred", "score", "rejected")
    names = sorted(model)
    position = kept.columns.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = []
        for name in names:
            held = zstandard.ZstdCompressionDict(model[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            packers.append(zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_dict_id=False))
        for batch in batches:
            found, scores = [], []
            for value in batch.column(position):
                string = value.as_py()
                if not packers or not string or not any(map(str.isalpha, string)):
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                data = string.lower().encode()
                runs = [data[i : i + RUN_BYTES] for i in range(0, len(data), RUN_BYTES)]
                sizes = [sum(len(packer.compress(run)) for run in runs) for packer in packers]
                best = min(sizes)
                found.append(names[sizes.index(best)])
                scores.append(1 / sum(math.exp(max(-50.0, (best - size) / BYTES_PER_UNIT)) for size in sizes))
            columns = [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    schema = widened(kept, lang_pred="string", score="double")
    judged = kept.mapInArrow(judge, schema)
    narrow = (F.col("lang_pred") == UNKNOWN) | (F.col("score") < least_score)
    return judged.withColumn("rejected", narrow)
