"""The registered queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import (bpe, curriculum, ego_join, hard_negatives, intvec, langid, line_templates, ngram_join, page_text,
                          sharding, topk, toxicity, training_order, vector_codes)
from starload.llm.frames import crc_mod, shared_path, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products of every twentieth vector with all others."""
    vectors = topk.integer_vectors(_table(spark, sf_dir, "embeddings"))
    return topk.topk(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by 4-word shingles at a Jaccard similarity of at least 0.85."""
    return ngram_join.jaccard_groups(_table(spark, sf_dir, "documents"), width=4, percent=85)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level BPE ids and the decoded bytes, as digests."""
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's BPE ids as sequences in training order: shards are written, then read back as digests.

    ``slot, shard, doc_id, seq_no, n_tokens, tokens_sha256`` (of the little-endian 16-bit ids).
    """
    cutter = training_order.bpe_cutter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    slotted, total = training_order.assign_slots(_table(spark, sf_dir, "documents"), cutter, key=20240607)
    path = shared_path(spark, "op4-shards")
    training_order.write_shards(slotted, total, path)
    return (training_order.read_shards(spark, path)
            .select("slot", "shard", "doc_id", "seq_no", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its lines of templates that recur across documents."""
    return line_templates.drop_recurring(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; profiles are learned from the three folds that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    langs, prototypes = langid.fit(docs.where(crc_mod("doc_id", 4) != 2))
    pred = langid.predict(docs, langs, prototypes)
    return pred.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine links of at least 0.93 within a label, as link counts and groups."""
    return ego_join.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.93)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights."""
    return curriculum.mix(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples; labels of the fold held out are not read."""
    docs = _table(spark, sf_dir, "documents")
    index = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0))
    scored = toxicity.score(docs, index)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "evidence")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page, by the template of its host."""
    return page_text.main_text(_table(spark, sf_dir, "pages"))


def op11_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards of nearly equal bytes."""
    placed = sharding.assign(_table(spark, sf_dir, "documents"), 16, carry=["doc_id"])
    return placed.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; a label is moved on where the id is divisible by 7."""
    rows = intvec.integer_rows(_table(spark, sf_dir, "embeddings"), 256)
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(moved, F.col("vec_id") % 100 == 0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector: 4 parts, 256 entries, 4 rounds."""
    codes, books = vector_codes.compress(intvec.integer_rows(_table(spark, sf_dir, "embeddings"), 1024))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return vector_codes.with_label_error(codes).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(books and books.sha256()).alias("codebooks_sha256"))


LLM_QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_training_order": op4_training_order,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_source_mix": op8_source_mix,
    "op9_toxicity": op9_toxicity,
    "op10_main_text": op10_main_text,
    "op11_sampled_splitters": op11_sampled_splitters,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_vector_codes": op13_vector_codes,
}
