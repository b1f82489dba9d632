"""Each logical table bound in Spark equals its DuckDB binding, row for row."""
import duckdb
import pytest

from riskgraph.plans.oracle import BINDINGS
from riskgraph.sources import bindings as B
from tests.conftest import SF0001

TABLES = ["user_contact", "user_profile", "call_detail", "call_detail_year", "repay_plan",
          "collection_record", "third_party_blacklist", "credit_apply", "rank_score"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["customer", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def _text(v):
    return None if v is None else str(v)


@pytest.mark.parametrize("name", TABLES)
def test_binding_matches_duckdb(spark, duck, name):
    df = getattr(B.Bindings(spark, SF0001), name)
    cols = df.columns
    got = sorted((tuple(_text(r[c]) for c in cols) for r in df.collect()), key=str)
    rel = duck.sql(f"WITH {BINDINGS.rstrip().rstrip(',')} SELECT {', '.join(cols)} FROM {name}")
    want = sorted((tuple(_text(v) for v in r) for r in rel.fetchall()), key=str)
    assert got == want
