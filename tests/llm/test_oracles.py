"""Every query with a DuckDB statement, row for row, and the full set of names."""
import duckdb
import pytest

from riskgraph.llm.queries import ORACLES, QUERIES
from tests.conftest import SF0001

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    rel = duck.sql(ORACLES[name])
    columns, found = rel.columns, rel.fetchall()
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(r[columns.index(c)] for c in df.columns) for r in found)
    assert sorted(map(tuple, df.collect())) == want
