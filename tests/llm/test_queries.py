"""Registered queries and the pipeline on the smallest tables; SQL where it exists."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import corpus_pipeline  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402
from starload.llm.oracle import LLM_ORACLE  # noqa: E402
from starload.llm.queries import LLM_QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(llm, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    res = con.execute(LLM_ORACLE[name])
    cols = [d[0] for d in res.description]
    df = LLM_QUERIES[name](llm, SF_DIR)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))


def test_pipeline_stages_keep_the_columns(llm, tmp_path):
    docs = llm.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        if name == "mix_to_target_weights":
            order = [r.doc_id for r in out.collect()]
        before, docs = docs, llm.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "byte_level_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert seen[name] <= {r.doc_id for r in before.select("doc_id").collect()}
    assert len(seen["language_id"]) >= 195 and seen["line_dedup"] == seen["language_id"]
    assert seen["ngram_jaccard_join"] < seen["line_dedup"] and docs.count() > 0
    # the training order survives the reading of the files, whatever their splits
    assert [r.doc_id for r in docs.orderBy("order_file", "order_row").collect()] == order
