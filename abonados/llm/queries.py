"""The text operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abonados.llm import (
    chat,
    decontaminate,
    exact_dedup,
    histogram_packing,
    language,
    lm,
    near_dedup,
    packing,
    runs,
    token_alignment,
    token_counts,
    toxicity,
    url_filter,
)
from abonados.llm.common import id_remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


@query("op1_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near-duplicates of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document stands in sequences of 2048 tokens."""
    return packing.pack(packing.cut(table(spark, sf_dir, "documents")))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals for every context limit that is some document's length."""
    return token_counts.limits(token_counts.length_histogram(table(spark, sf_dir, "documents")))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three folds of four."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = language.train(documents.filter(~held_out))
    judged = language.identify(documents.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How probable every document is, learned from six folds of seven."""
    fold = id_remainder(F.col("doc_id"), 7)
    scored = lm.score(table(spark, sf_dir, "documents"), fold != 2, fold == 5)
    return scored.select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How toxic every document is, learned from the labels of four folds of five."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(id_remainder(F.col("doc_id"), 5) != 0)
    model = toxicity.train(documents, labels, documents)
    held_out = (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return toxicity.score(documents, model).select("doc_id", held_out, "score", "predicted")


@query("op6_exact_dedup", exact_dedup.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal texts stays, for every document."""
    return exact_dedup.duplicate_report(table(spark, sf_dir, "documents"))


@query("op8_url_filter", url_filter.ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.filter_urls(pages, url_filter.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op9_decontamination", decontaminate.ORACLE)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document stands in windows of benchmark items."""
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(documents, benchmark).drop("item_ids")


@query("op10_chat_formatting")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with the role found for it and its canonical form, learned from the
    roles of four folds of five; roles are no input of the parse."""
    turns = table(spark, sf_dir, "conversations")
    held_out = id_remainder(F.col("conv_id"), 5) == 0
    model = chat.train(turns.filter(~held_out))
    parsed = chat.parse(turns.drop("role"), model)
    return parsed.select("conv_id", "turn", held_out.alias("held_out"), "role_pred", "rendered")


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """The documents of the contract: of ids whose crc32 ends in 0, all words from word
    a = g % n on repeat with period 1 + floor((n - a) / (3 + g % 8)), g = floor(crc32 / 10)."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    g, n = F.floor(h / 10), F.size("words")
    first = (g % n).cast("int")
    period = F.lit(1) + F.floor((n - F.col("first")) / (F.lit(3) + g % 8)).cast("int")
    at = lambda w, i: F.when(i < F.col("first"), w).otherwise(
        F.get("words", F.col("first") + (i - F.col("first")) % F.col("span"))
    )
    planted = documents.filter(h % 10 == 0).withColumn("words", words)
    planted = planted.withColumn("first", F.when(n > 0, first)).withColumn("span", period)
    planted = planted.withColumn("text", F.when(n > 0, F.array_join(F.transform("words", at), " ")))
    return planted.select("doc_id", "text").unionByName(documents.filter(h % 10 != 0).select("doc_id", "text"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, the strongest of them, and hashes of all."""
    judged = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    return runs.run_digests(judged).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )


@query("op12_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document stands in sequences without padding."""
    return histogram_packing.pack_by_histogram(table(spark, sf_dir, "documents"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two vocabularies' tokens of every document correspond."""
    aligned = token_alignment.align_tokens(table(spark, sf_dir, "documents"), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")
