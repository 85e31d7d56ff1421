"""Queries with oracle SQL against DuckDB on the small test tables."""

import duckdb
import pytest

from ordersight.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    want = found.fetchall()
    got = QUERIES[name](spark, SF).select(*names).collect()
    assert want and sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
