"""Physical plans: pruning, push-down, measured broadcast, one shuffle for the edges."""
import re
import tempfile

import pytest

from riskgraph.operators import edges
from riskgraph.operators.membership import BUDGET_CONF
from riskgraph.plans import catalog as Q
from riskgraph.sources import bindings as B
from tests.conftest import SF0001

PAIRS = 1101  # ranking pairs at sf0.001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    return B.store(spark, SF0001, tempfile.mkdtemp(prefix="rg-test-tables-"))


def test_stored_tables_give_same_results(spark, stored):
    assert Q.bound()["c15_call_edges"](stored).count() == 670
    assert Q.bound()["c22_rank_edges"](stored).count() == PAIRS
    assert Q.bound()["c25_overdue_info"](stored).count() == 538


def test_call_edges_plan(spark, stored):
    df = Q.c15_edges(stored)
    plan = _plan(df)
    # the day bound reaches the scan (row groups are skipped by their dt
    # statistics) and only the call columns are read
    scan = [ln for ln in plan.splitlines() if "call_detail" in ln][0]
    assert "LessThan(dt,2001-08-31)" in scan.split("PushedFilters:")[1]
    assert "ReadSchema: struct<mobile:string,other_mobile:string,call_channel:string,call_time:string,dt:string>" in scan
    # small measured cohort: both membership tests are broadcast semi-joins
    assert plan.count("BroadcastHashJoin") >= 2 and "LeftSemi" in plan
    assert "SortMergeJoin" not in plan
    # partial + final aggregation around the one shuffle on (src, dst)
    assert "partial_sum" in plan and "hashpartitioning(src" in plan


def test_snapshot_prunes_day_partitions(spark, stored):
    df = stored.user_contact.filter("dt = '2001-08-31'").select("mobile")
    plan = _plan(df)
    assert re.search(r"PartitionFilters: \[isnotnull\(dt#\d+\), \(dt#\d+ = 2001-08-31\)\]", plan)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_large_cohort_plan_drops_non_members_first_and_agrees(spark, stored):
    calls, cohort, passed = Q.history_calls(stored), Q.applied_cohort(stored), Q.passed(stored).select("mobile")
    cases = {
        "both": lambda: edges.call_edges(calls, cohort),
        "owner": lambda: edges.call_edges(calls, passed, ends="owner"),
        "any11": lambda: edges.call_edges(calls, passed, pattern=r"[0-9]{11}", min_n=1, check="history"),
        "loose": lambda: edges.call_edges(calls, cohort, pattern=r"p1[0-9]{5,10}", prefix="p"),
        "rank": lambda: edges.rank_edges(calls, cohort),
    }
    small = {k: _rows(f()) for k, f in cases.items()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(BUDGET_CONF, "1000")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        plan = _plan(cases["both"]())
        assert "SortMergeJoin" in plan and "LeftSemi" in plan
        large = {k: _rows(f()) for k, f in cases.items()}
        # between the scan of the calls and their first exchange stand the two bit-table joins
        above = plan[:plan.index("/call_detail")].splitlines()
        first_exchange = max(i for i, ln in enumerate(above) if "Exchange hashpartitioning(mobile" in ln)
        assert sum("BroadcastHashJoin" in ln for ln in above[first_exchange:]) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset(BUDGET_CONF)
    assert len(small["both"]) == 670
    assert large == small


def test_cohort_source_is_scanned_once(spark, stored):
    """The plan reads the written cohort, never the user tables it came from."""
    plan = _plan(Q.c15_edges(stored))
    assert "/user_profile" not in plan and "/user_contact" not in plan
    assert plan.count("Scan ExistingRDD") >= 1


def test_bucketed_calls_are_not_shuffled_before_the_owner_test(spark, stored):
    import uuid
    from riskgraph.sources.tables import store_bucketed
    calls = store_bucketed(Q.history_to_today(stored), f"rg_plan_{uuid.uuid4().hex}", 8,
                           path=tempfile.mkdtemp(prefix="rg-test-bucketed-") + "/t")
    passed = Q.passed(stored).select("mobile")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (edges.owned_by_members(calls, passed, broadcast=False),
                   edges.call_edges(calls, passed, ends="owner", broadcast=False)):
            lines = _plan(df).splitlines()
            scan = next(i for i, ln in enumerate(lines) if "FileScan" in ln and "Bucketed: true" in ln)
            semi = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln and "LeftSemi" in ln)
            indent = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
            # the operators on the way from the semi-join down to the calls
            path = [ln for ln in lines[semi:scan + 1] if len(ln) - len(ln.lstrip(" :+-")) <= indent]
            assert not any("Exchange hashpartitioning" in ln and ":" in ln.split("Exchange")[0] for ln in path), path
        assert _rows(edges.call_edges(calls, passed, ends="owner", broadcast=False)) == _rows(Q.c17_edges(stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_grow_with_the_calls(spark, stored, monkeypatch):
    from riskgraph.sources import tables
    assert [tables.buckets_for(spark.range(n)) for n in (0, 1, 8 * tables.BUCKET_ROWS + 1)] == [8, 8, 16]
    want = _rows(Q.c17_edges(stored))
    used, store = [], tables.store_bucketed
    monkeypatch.setattr(tables, "BUCKET_ROWS", 200)
    monkeypatch.setattr(Q, "store_bucketed", lambda df, name, buckets, **how: used.append(buckets) or store(df, name, buckets, **how))
    got = Q.bound()["c17_call_edges_bucketed"](stored).select("src", "dst", "calls", "mean_duration")
    n = Q.history_to_today(stored).count()
    assert used == [32] and 16 * 200 < n <= 32 * 200
    assert _rows(got) == want


def test_filled_filter_passes_few_non_members(spark):
    from pyspark.sql import functions as F
    from riskgraph.operators import membership as M
    for n in (500, 60_000):
        cohort = M.measured(spark.range(n).select(F.concat(F.lit("m"), "id").alias("mobile")))
        assert n * M.BITS_PER_MEMBER <= cohort.words * 64 or cohort.words == M.CHUNK_WORDS
        assert M.member_bits(cohort).selectExpr("sum(size(__words))").first()[0] == cohort.words
        df = spark.range(2 * n).select(F.concat(F.lit("m"), "id").alias("who"), "id")
        kept = M.maybe_members(df, cohort, "who")
        assert kept.filter(F.col("id") < n).count() == n
        assert kept.filter(F.col("id") >= n).count() < 0.02 * n
    assert M.Cohort(df, 100_000_000, 0).words * 64 >= 16 * 100_000_000
    assert M.Cohort(df, 10**12, 0).words == M.MOST_WORDS


def test_months_replace_their_days(spark, tmp_path):
    from riskgraph.operators import history_totals as H
    root, before = str(tmp_path / "totals"), "2001-03-02"
    days = [f"2001-{m:02d}-{d:02d}" for m, n in ((1, 9), (2, 9), (3, 1)) for d in range(1, n + 1)]
    data = [(f"1380000000{k % 3}", "13800000009", "012001001", str(k), d) for k, d in enumerate(days * 3)]
    calls = spark.createDataFrame(data, "mobile string, other_mobile string, call_channel string, call_time string, dt string")
    assert H.refresh_totals(spark, calls, root, before) == days
    by_day = H.read_totals(spark, calls, root, before)
    want = _rows(H.call_edges_from_totals(by_day, min_n=1))
    assert H.roll_months(spark, root, before) == ["2001-01", "2001-02"]
    assert H.roll_months(spark, root, before) == []
    by_month = H.read_totals(spark, calls, root, before)
    assert _rows(H.call_edges_from_totals(by_month, min_n=1)) == want == _rows(edges.call_edges(calls, min_n=1))
    # the files of two months and of one open day, where all days were read before
    assert {re.search(r"(month|dt)=([0-9-]+)", f).group(2) for f in by_month.inputFiles()
            if "_months/" in f} == {"2001-01", "2001-02"}
    scans = [ln for ln in _plan(by_month).splitlines() if "FileScan" in ln]
    assert len(scans) == 2 and any("dt#" in ln and "2001-03-01" in ln and "2001-02" not in ln.split("PartitionFilters")[1] for ln in scans)
    # a corrected day takes its month out until it is rolled again
    changed = [(*r[:3], "99", r[4]) if r[4] == "2001-02-03" else r for r in data]
    calls = spark.createDataFrame(changed, calls.schema)
    assert H.refresh_totals(spark, calls, root, before) == ["2001-02-03"]
    assert _rows(H.call_edges_from_totals(H.read_totals(spark, calls, root, before), min_n=1)) == _rows(edges.call_edges(calls, min_n=1))
    assert H.roll_months(spark, root, before) == ["2001-02"]
    assert _rows(H.call_edges_from_totals(H.read_totals(spark, calls, root, before), min_n=1)) == _rows(edges.call_edges(calls, min_n=1))


def test_totals_move_the_calls_once(spark, tmp_path, monkeypatch):
    """One shuffle for sums and files, and one reading of the calls for their digests."""
    from riskgraph.operators import history_totals as H
    data = [(f"1380000000{k % 3}", "13800000009", "012001001", str(k), f"2001-01-0{1 + k % 4}") for k in range(30)]
    calls = spark.createDataFrame(data, "mobile string, other_mobile string, call_channel string, call_time string, dt string")
    read, digests = [], H.day_digests
    monkeypatch.setattr(H, "day_digests", lambda df, open_from=None: read.append(open_from) or digests(df, open_from))
    root, before = str(tmp_path / "totals"), "2001-02-01"
    assert len(H.refresh_totals(spark, calls, root, before)) == 4 and len(read) == 1
    assert H.stale_days(spark, calls, root, before) == []
    late = spark.createDataFrame([*data, ("13800000001", None, None, "7", "2001-01-02")], calls.schema)
    assert H.refresh_totals(spark, late, root, before, open_from="2001-01-04") == ["2001-01-02"]
    assert len(read) == 4  # a closed day's digest was not read by the check
    assert H.stale_days(spark, late, root, before) == []
    plan = _plan(H.day_totals(H._ranged(calls, "dt")))
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


@pytest.mark.parametrize("name", ["c23_one_degree", "c24_one_degree_undirected", "c15_call_edges"])
def test_history_scanned_once(spark, stored, name):
    df = Q.bound()[name](stored)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = {re.search(r"FileScan parquet \[([^\]]*)\]", ln).group(1)
             for ln in plan.splitlines() if "FileScan" in ln and "/call_detail" in ln}
    assert len(scans) == 1, scans
