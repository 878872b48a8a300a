"""Every catalog query against its DuckDB oracle (the driver's correctness gate) at the smallest scale."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from starload.plans.catalog import QUERIES as CATALOG  # noqa: E402
from check_oracle import TABLES, rows_of, type_mismatches  # noqa: E402

SF_DIR = os.environ.get("STARLOAD_TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = E.oracle_sql()
QUERIES = {k: f for k, f in E.queries().items() if k in CATALOG}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(CATALOG) and set(CATALOG) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    otypes = {d[0]: str(d[1]) for d in res.description}
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert not type_mismatches(dict(df.dtypes), otypes)
    assert len(srows) == len(orows)
    assert rows_of(df.columns, srows) == rows_of(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "Season" in df.columns
