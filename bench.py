"""Benchmark the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3).

Each query is run once to warm up and then BENCH_RUNS times, median reported,
executed in full into the ``noop`` sink.  The cache is cleared before every
run (and no query keeps a table), so each run does all of its work:

* ``queries`` (the headline ``value``): every query derives the logical tables
  from the raw TPC-H parquet itself (lineitem x orders joins inside each
  query), which is how the correctness check and the first measured run of
* ``queries_stored``: the logical tables are first written once as parquet, as
  the production tables are stored (``setup_store_sec``).
* ``queries_shuffle_membership``: C15 and C22 on the stored tables by the plan
  used for a cohort beyond the broadcast budget.
* ``queries_from_totals``: C15 and C22 on the stored tables from the daily and
  monthly totals of the calls (``operators.history_totals``), which are written
  once before (``setup_totals_sec``).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskgraph.operators import edges  # noqa: E402
from riskgraph.operators import history_totals as H  # noqa: E402
from riskgraph.plans.catalog import applied_cohort, bound  # noqa: E402
from riskgraph.session import local_session, scratch_path  # noqa: E402
from riskgraph.sources import bindings as B  # noqa: E402

HEADLINE = ["c15_call_edges", "c22_rank_edges", "c23_one_degree", "c27_graph_lists",
            "c25_overdue_info", "c26_score_vs_overdue"]


def cpu_calibration() -> float:
    """Seconds for a fixed pure-Python loop: a yardstick of the host's speed
    at bench time, so numbers from a slow or contended machine can be told
    apart from a slower plan."""
    t0 = time.perf_counter()
    acc = 0
    for i in range(5_000_000):
        acc += i
    return round(time.perf_counter() - t0, 3)


def run_once(tables, fn) -> float:
    tables().spark.catalog.clearCache()
    t0 = time.perf_counter()
    fn(tables()).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def time_all(tables, runs, names=HEADLINE, queries=None) -> dict:
    """``tables`` makes fresh bindings for every run."""
    queries = queries or bound()
    out = {}
    for name in names:
        run_once(tables, queries[name])
        out[name] = round(statistics.median(run_once(tables, queries[name]) for _ in range(runs)), 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    calibration_before = cpu_calibration()
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app_name="riskgraph-bench")
    results = time_all(lambda: B.Bindings(spark, sf_dir), runs)

    root = scratch_path(spark, "bench-tables")
    t0 = time.perf_counter()
    B.store(spark, sf_dir, root)
    setup = round(time.perf_counter() - t0, 3)

    def stored():
        return B.Bindings(spark, sf_dir, stored=root)
    on_stored = time_all(stored, runs)
    shuffled = time_all(stored, runs, ["c15_call_edges_shuffled", "c22_rank_edges_shuffled"])

    totals = scratch_path(spark, "bench-totals")
    t0 = time.perf_counter()
    H.refresh_totals(spark, stored().call_detail, totals, B.HISTORY_TO_TODAY)
    H.roll_months(spark, totals, B.HISTORY_TO_TODAY)
    totals_setup = round(time.perf_counter() - t0, 3)
    from_totals = time_all(stored, runs, ["c15_call_edges", "c22_rank_edges"], {
        "c15_call_edges": lambda b: edges.with_mean_text(H.call_edges_from_totals(
            H.read_totals(spark, None, totals, B.HISTORY_BEFORE), applied_cohort(b))),
        "c22_rank_edges": lambda b: H.rank_edges_from_totals(
            H.read_totals(spark, None, totals, B.HISTORY_TO_TODAY), applied_cohort(b))})

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "queries_stored": on_stored,
        "stored_total": round(sum(on_stored.values()), 3),
        "setup_store_sec": setup,
        "queries_shuffle_membership": shuffled,
        "queries_from_totals": from_totals,
        "setup_totals_sec": totals_setup,
        "cpu_calibration_sec": [calibration_before, cpu_calibration()],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
