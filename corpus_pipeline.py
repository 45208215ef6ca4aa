"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns them with the columns of
``documents``; the last returns packed pieces. Nulls, repeated rows and empty tables are handled as the
operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenfield.llm import decontaminate, near_dedup, packing, suffix_dedup, toxicity
from wrenfield.llm.common import modest_batches, shielded, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the model learns from all labelled ones (a bounded sample)."""
    modest_batches(spark)
    weights = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    safe, named = shielded(docs, "text")
    return named(toxicity.score(safe, weights).where(F.col("score") < toxicity.THRESHOLD))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the smallest id."""
    modest_batches(spark)
    return near_dedup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that occur elsewhere; documents of which nothing is left go."""
    modest_batches(spark)
    safe, named = shielded(docs, "doc_id", "text", "n_chars")
    cut = suffix_dedup.remove_repeats(safe)
    left = cut.where((F.col("n_removed") == 0) | (F.trim(F.col("text")) != ""))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return named(left.withColumn("n_chars", n_chars))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    modest_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 2048."""
    modest_batches(spark)
    return packing.pack(docs, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("repeated strings", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
#: SQL cannot express the model, the signatures or the tokens; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
