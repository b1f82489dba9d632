"""Every oracle statement runs in DuckDB with all of the driver's views registered."""
import os

import duckdb

import __spark_entry__ as E
from tests.conftest import SF0001

VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()


def test_oracle_statements_run_with_all_driver_views():
    con = duckdb.connect()
    for t in VIEWS:
        path = f"{SF0001}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    sqls = E.oracle_sql()
    assert set(sqls) <= set(E.queries())
    for name, sql in sqls.items():
        rel = con.sql(sql)
        assert rel.columns, name
        rel.limit(1).fetchall()
