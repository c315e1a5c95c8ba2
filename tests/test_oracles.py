"""Every query with an SQL oracle equals DuckDB on the sf0.001 tables (columns, rows, values)."""

import duckdb
import pytest

import __spark_entry__ as E
from tilerank.sources.fixtures import BASE_TABLES
from tools.check_oracles import rows_of

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_every_query_key_is_callable():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 100


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, con, key):
    df = QUERIES[key](spark, sf_dir)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[key])
    d_cols, d_rows = [x[0] for x in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
