"""Every catalog query against its DuckDB statement, and the fixture counts."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from riskgraph.plans.catalog import catalog
from riskgraph.plans.oracle import oracle
from tests.conftest import SF0001

# Expected rows at sf0.001 (FIXTURES.md part D).
COUNTS = {
    "c01_applied": 107, "c02_applied_not_passed": 13, "c03_passed_summary": 95, "c04_passed_no_borrow": 42,
    "c05_whitelist": 8, "c06_whitelist_strict": 4, "c07_whitelist_early": 18, "c08_greylist": 14,
    "c09_blacklist": 21, "c10_blacklist_wide": 39, "c11_third_party": 4, "c12_fraud_history": 32,
    "c13_merged_blacklist": 33, "c14_segments_per_user": 43 + 15 + 21 + 20, "c15_call_edges": 670,
    "c16_call_edges_loose": 1367, "c17_call_edges_owner": 883, "c18_call_edges_passed": 520,
    "c19_incremental_applicants": 37, "c20_incremental_edges": 3, "c20_incremental_edges_all": 21,
    "c21_persons": 107, "c22_rank_edges": 1101, "c23_one_degree": 107, "c24_one_degree_undirected": 107,
    "c25_overdue_info": 538, "c26_score_vs_overdue": 601,
}
TABLES = ["customer", "orders", "lineitem", "supplier", "nation", "region", "part"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return v


def _key(r):
    return tuple((x is None, str(x)) for x in r)


def test_every_query_has_an_oracle():
    assert set(catalog()) == set(oracle())
    assert set(catalog()) <= set(E.queries()) and set(oracle()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog()))
def test_query_matches_duckdb(spark, duck, name):
    df = catalog()[name](spark, SF0001)
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    assert not spark.sparkContext._jsc.getPersistentRDDs()  # nothing stays behind a query
    if name in COUNTS:
        assert len(got) == COUNTS[name]
    sql = oracle().get(name)
    rel = duck.sql(sql)
    assert sorted(rel.columns) == sorted(df.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    want = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert sorted(got, key=_key) == sorted(want, key=_key)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["src", "dst", "calls", "mean_duration", "mean_text"]
    assert df.count() == 670
