"""The queries that have SQL, against DuckDB on sf0.001."""
import duckdb
import pytest

from tools.oracle_check import TABLES, rows_of
from tripflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(columns, want.fetchall())
