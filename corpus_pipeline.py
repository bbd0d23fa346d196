"""The corpus pipeline: language, exact copies, near copies, benchmark passages, packing.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; each is written and read back as the next
one's ``docs``. All but the last keep the columns of ``documents`` and the order of decisions is that of
``STAGES``: what a stage drops, no later one sees.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm import decontaminate, exact_dedup, language, near_dedup, packing
from brooklet.session import discard_saved, saved, saved_paths

LEAST_SHARE = 0.3  # of its main language, for a document to stay


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those in which no language reaches ``LEAST_SHARE``. Where no document
    is labelled, no language is known and only the letter counts."""
    model = language.train(docs)
    if not model.languages:
        return docs.where(language.has_letter(F.col("text")))
    return language.keep_identified(docs, model, LEAST_SHARE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, near_dedup.MinHash(shingle=5))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

# The mixture model and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = set(saved_paths())
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # The stage's output is written: its input and what it wrote on the way are not read again.
        discard_saved(spark, [path for path in saved_paths()[:-1] if path not in before])
    return docs
