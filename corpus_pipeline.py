"""A corpus from raw documents to packed sequences, stage by stage.

Every stage reads what the stage before it kept. All but the last return the columns of
``documents``; the last says where each piece stands in sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abonados.llm import decontaminate, exact_dedup, language, near_dedup, packing
from abonados.llm.common import id_remainder, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; learned from three quarters of the labelled ones."""
    model = language.train(docs.filter(id_remainder(F.col("doc_id"), 4) != 2))
    judged = language.identify(docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), model)
    return judged.filter(~F.col("rejected")).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group whose five-word shingles agree in 80 of 100 or more."""
    return near_dedup.drop_near_duplicates(docs, size=5, percent=80)


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than one word in 20 inside benchmark windows."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut(docs))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmarks),
    ("best_fit_packing", pack_sequences),
]

#: Compression, minwise trees and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
