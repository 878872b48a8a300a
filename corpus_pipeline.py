"""Corpus pipeline: language ID, line dedup, n-gram Jaccard join, mixing to target weights, BPE encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``; extra columns of the input are not carried on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm import stages
from starload.llm.frames import shared_path

STAGES = [
    ("language_id", stages.keep_known_languages),
    ("line_dedup", stages.drop_recurring_lines),
    ("ngram_jaccard_join", stages.keep_one_per_group),
    ("mix_to_target_weights", stages.mix_sources),
    ("byte_level_bpe", stages.encode_bytes_bpe),
]

#: Hyperdimensional profiles, template clusters and BPE merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the whole table ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
