"""From raw documents to packed sequences: four stages, each on all that the one before kept.

1. quality: documents that the classifier rejects go.
2. near_duplicates: one document of each group of near duplicates stays (five-word shingles, similarity 0.8).
3. repeats: bytes that repeat an earlier document's 50-byte strings go; documents of which nothing is left, too.
4. packing: what remains is cut into sequences by powers of two.

Between stages the documents are a Parquet table in the shared folder, with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvetch.llm import minmax_hash, packing, quality_gam, suffix_dedup
from kvetch.llm.common import written
from kvetch.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least the classifier's threshold; it learns from the labels it may see."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_gam.keep_good(docs.select(*COLUMNS), labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; documents without words are in no group and stay."""
    return minmax_hash.keep_one(docs.select(*COLUMNS))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat an earlier document's; ``n_chars`` counts what is left."""
    rest = [c for c in COLUMNS if c not in ("doc_id", "text", "n_chars")]
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS), carry=[*rest, "n_chars"])
    left = cut.where((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    counted = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.char_length("kept_text").cast("long"))
    return left.select(
        "doc_id", F.col("kept_text").alias("text"), *[F.col(f"row.{c}").alias(c) for c in rest], counted.alias("n_chars")
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Scores of a fitted model and a tokenizer's ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
