"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import named
from corpusmill.llm import decontaminate, line_dedup, minhash, packing, toxicity
from corpusmill.llm.queries import TOKENIZER, table
from corpusmill.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without_row_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, ...) that have (left_semi) or lack (left_anti) a key of (id_hash, version)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
        F.xxhash64("doc_id").alias("id_hash"),
        F.xxhash64(text).alias("version"),
    )
    return rows.join(keys.select("id_hash", "version"), ["id_hash", "version"], how).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    predicted = scored.columns[-1]
    return scored.where(F.col(predicted) == 0).select(*[named(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 10 characters or more stay in one document only; n_chars follows the text.

    A document that loses all its lines stays, with an empty text.
    """
    cleaned = line_dedup.drop_repeated_lines(docs)
    kinds = docs.schema
    return cleaned.select(
        *[
            F.char_length("text").cast(kinds[c].dataType).alias(c) if c == "n_chars" else named(c)
            for c in docs.columns
        ]
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (5-word shingles, similarity 0.8) the smallest id stays."""
    kept = minhash.near_duplicates(docs).where("kept").select("id_hash", "version").distinct()
    return _without_row_keys(docs, kept, "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without_row_keys(docs, found, "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
# The first stage's model and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
