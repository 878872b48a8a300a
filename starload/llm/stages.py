"""The stages of the corpus pipeline, each one operator of this subpackage with production parameters.

Each takes ``(spark, docs, sf_dir)`` and all but the last return the columns of documents. Extra
columns are not carried on. Rows with a null id, or with an id that others have, are rows like all others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import bpe, curriculum, langid, line_templates, ngram_join
from starload.llm.frames import crc_mod, cut, ship, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> list:
    return [docs[c] for c in COLUMNS]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or unlike every learned language, go: those below the cosines of its labelled texts."""
    ship(spark)
    labelled = docs.where(F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(True)))
    langs, prototypes = langid.fit(labelled)
    return langid.filter_known(docs.select(*_columns(docs)), langs, prototypes, langid.gate(labelled, langs, prototypes))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates stay in one document only; all documents are kept."""
    ship(spark)
    rows = docs.select(*_columns(docs))
    return (line_templates.drop_recurring(rows, carry=["lang", "source"])
            .select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")))


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id (null ids last) stays of each group linked at 0.8 by five-word shingles.

    Rows are told apart by their place in ``docs``, so copies under one id or without an id go as well. ``docs`` must
    give the same rows in the same partitions each time, as files do.
    """
    ship(spark)
    rows = docs.select(*_columns(docs), F.monotonically_increasing_id().alias("row_key"))
    groups = written(ngram_join.jaccard_groups(rows.select(F.col("row_key").alias("doc_id"), "text"), width=5, percent=80)
                     .select(F.col("doc_id").alias("row_key"), "component_id"), "groups")
    several = groups.where("component_id <> row_key").select("component_id").distinct()
    linked = written(groups.join(several, "component_id", "left_semi").join(rows.select("row_key", "doc_id"), "row_key"), "linked")
    first = (linked.groupBy("component_id")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))["row_key"].alias("kept")))
    # written, so that the planner broadcasts few keys instead of shuffling all texts
    gone = written(linked.join(first, "component_id").where("row_key <> kept").select("row_key"), "gone")
    return rows.join(gone, "row_key", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix reads it, sorted by training position; ids may repeat or be null."""
    ship(spark)
    # written, so that a row has the same key in the plan and in the join
    rows = written(docs.select(*_columns(docs)).withColumn("row_key", F.monotonically_increasing_id()), "mix-rows")
    plan = cut(curriculum.occurrences(rows, carry=["row_key"]).select("row_key", "position"))
    return rows.join(plan, "row_key").orderBy("position", "doc_id", "row_key").select(*COLUMNS)


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row's place in its files, which keeps the order they were written in: ``order_file, order_row``."""
    try:
        part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
        return docs.select("*", F.nullif(part, F.lit("")).cast("long").alias("order_file"),
                           F.col("_metadata.row_index").alias("order_row"))
    except AnalysisException:  # no files: the order of the rows as they come
        return docs.select("*", F.lit(0).cast("long").alias("order_file"), F.monotonically_increasing_id().alias("order_row"))


def encode_bytes_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text: ``doc_id, order_file, order_row, n_tokens, ids_sha256, decoded_sha256, token_ids``.

    Readers split and pack files as they like; ascending ``order_file, order_row`` is the order of ``docs``' files, which
    after the mixing stage is the training order.
    """
    ship(spark)
    key = F.struct("doc_id", "order_file", "order_row").alias("doc_id")
    encoded = bpe.encode_documents(_placed(docs).select(key, "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                   public_tokenizers.PATTERN, keep_ids=True)
    return encoded.select("doc_id.*", *[c for c in encoded.columns if c != "doc_id"])
