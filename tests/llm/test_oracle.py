"""Training-data queries that SQL can express equal their DuckDB oracle on the sf0.01 tables."""

import duckdb
import pytest

from seqweave.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want
