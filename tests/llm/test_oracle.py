"""The subpackage's queries that have SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from keyreport.llm.catalog import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, rows as norm_rows

from .conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for tb in TABLES:
        con.execute(f"CREATE VIEW {tb} AS SELECT * FROM read_parquet('{SF}/{tb}.parquet')")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert norm_rows(got) == norm_rows(want)
