"""Every registered query against its DuckDB SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as ep
from keyreport.plans.catalog import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, rows as norm_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for tb in TABLES:
        con.execute(f"CREATE VIEW {tb} AS SELECT * FROM read_parquet('{SF}/{tb}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(ep.queries())


def test_entry_runs(spark):
    df = ep.entry(spark)
    assert df.columns == ["n_nationkey", "n_name", "total_delay", "n_delayed"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert norm_rows(got) == norm_rows(want)
