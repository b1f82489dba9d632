"""Job entry point for ``spark-submit``: bind catalog tables, run one export.

    spark-submit riskgraph/plans/jobs.py graph --base /shared/out --as-of 2001-09-01 \\
        --table user_profile=db.profile --table user_contact=db.contact --table call_detail=db.calls

Tables are named by their logical role (``--table role=catalog.table``); days
are explicit (``--as-of``), never read from the clock.  The session is the
cluster's (``getOrCreate``), so its checkpoint folder and settings apply.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskgraph.functions.exprs import ANY11, FRAUD_CHANNELS, FRAUD_LABEL, LOOSE, PREFIX, days  # noqa: E402
from riskgraph.operators import cohorts, edges, segments  # noqa: E402
from riskgraph.operators.history_totals import refresh_totals, roll_months  # noqa: E402
from riskgraph.plans import exports  # noqa: E402
from riskgraph.session import prepare  # noqa: E402
from riskgraph.sources.tables import history, snapshot  # noqa: E402


def _decoder(name: str | None):
    """V1: a catalog function applied to the encoded mobile, if named."""
    if not name:
        return None
    return lambda c: F.call_function(name, c)


def run(spark: SparkSession, job: str, base: str, as_of: str, tables: dict, *, before: str | None = None,
        label: str = FRAUD_LABEL, channels=FRAUD_CHANNELS, since: str | None = None,
        decode: str | None = None, after: str | None = None, out: str | None = None,
        overdue_path: str | None = None, scores_path: str | None = None,
        totals: str | None = None, open_from: str | None = None) -> None:
    t = {k: spark.table(v) for k, v in tables.items()}
    today, yesterday = days(as_of)
    if job == "graph":
        exports.export_graph(t["user_profile"], t["user_contact"], t["call_detail"], base, as_of, before,
                             totals_root=totals)
    elif job == "ranking":
        exports.export_ranking(t["user_profile"], t["user_contact"], t["call_detail"],
                               t["third_party_blacklist"], t["repay_plan"], t["collection_record"],
                               base, as_of, label, channels, before, totals_root=totals)
    elif job == "day":
        exports.export_day(t["user_profile"], t["user_contact"], t["call_detail"], t["third_party_blacklist"],
                           t["repay_plan"], t["collection_record"], f"{base}/graph", f"{base}/ranking",
                           as_of, label, channels, totals or f"{base}/call_totals", open_from=open_from)
    elif job == "totals":
        root = totals or f"{base}/call_totals"
        refresh_totals(spark, t["call_detail"], root, today, open_from)
        roll_months(spark, root, today)
    elif job == "ranking-snapshot":
        exports.export_ranking_snapshot(t["user_profile"], t["user_contact"], t["call_detail"], base,
                                        yesterday, before or today, totals_root=totals)
    elif job == "lists":
        labelled = segments.segments_per_user(t["user_profile"], t["user_contact"], yesterday)
        exports.export_lists(labelled, base, yesterday, exports.USER_LISTS)
    elif job == "call-graph":
        members = cohorts.applied(t["user_profile"], t["user_contact"], yesterday)
        graph = edges.call_edges(history(t["call_detail"], before or yesterday), members)
        exports.export_call_graph(graph, base, today)
    elif job == "call-graph-loose":
        graph = edges.call_edges(history(t["call_detail"], before or today), pattern=LOOSE, prefix=PREFIX)
        exports.export_call_graph(graph, base, today)
    elif job == "call-graph-owner":
        exports.export_owner_graph(t["user_profile"], t["user_contact"], t["call_detail"], base, yesterday, before or today)
    elif job == "call-graph-passed":
        members = cohorts.passed_summary(t["user_profile"], t["user_contact"], yesterday).select("mobile")
        graph = edges.call_edges(history(t["call_detail"], before or today), members, pattern=ANY11, check="history")
        exports.export_call_graph(graph, base, yesterday)
    elif job in ("increment", "increment-mixed"):
        others = (cohorts.applied(t["user_profile"], t["user_contact"], yesterday)
                  if job == "increment-mixed" else None)
        graph = exports.daily_call_graph(t["credit_apply"], t["user_contact"], t["call_detail"], yesterday, after,
                                         others=others)
        exports.export_call_graph(graph, base, yesterday)
    elif job == "increment-loose":
        graph = edges.call_edges(snapshot(t["call_detail"], yesterday), pattern=LOOSE, prefix=PREFIX, min_n=1)
        exports.export_call_graph(graph, base, yesterday)
    elif job == "overdue":
        if not since:
            raise ValueError("the overdue job needs --since, the day from which loans count")
        exports.export_overdue_info(t["repay_plan"], t["user_profile"], out or f"{base}/overdue", as_of,
                                    since, _decoder(decode))
    elif job == "scores":
        exports.export_score_vs_overdue(spark, overdue_path, scores_path, out or f"{base}/scores")
    else:
        raise ValueError(f"unknown job {job}")


JOBS = ("graph", "ranking", "ranking-snapshot", "lists", "call-graph", "call-graph-loose", "call-graph-owner",
        "call-graph-passed", "increment", "increment-mixed", "increment-loose", "overdue", "scores", "totals", "day")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("job", choices=JOBS)
    ap.add_argument("--base", required=True, help="output folder")
    ap.add_argument("--as-of", required=True, help="today, YYYY-MM-DD; the snapshot day is the day before")
    ap.add_argument("--table", action="append", default=[], help="role=catalog_table")
    ap.add_argument("--before", help="read call history with dt < this day")
    ap.add_argument("--label", default=FRAUD_LABEL)
    ap.add_argument("--channels", help="comma-separated fraud channels")
    ap.add_argument("--since", help="overdue: loans created on or after this day (required there)")
    ap.add_argument("--decode", help="catalog function that decodes mobile_encode")
    ap.add_argument("--after", help="new applicants apply after this day")
    ap.add_argument("--out")
    ap.add_argument("--overdue-path")
    ap.add_argument("--scores-path")
    ap.add_argument("--open-from", help="totals and day: days before this one are closed, so only their number of calls is compared")
    ap.add_argument("--totals", help="root of the daily call totals (read by graph/ranking, brought up to date by totals and day)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"riskgraph-{a.job}").getOrCreate()
    prepare(spark)
    tables = dict(t.split("=", 1) for t in a.table)
    channels = tuple(a.channels.split(",")) if a.channels else FRAUD_CHANNELS
    run(spark, a.job, a.base, a.as_of, tables, before=a.before, label=a.label, channels=channels,
        since=a.since, decode=a.decode, after=a.after, out=a.out, overdue_path=a.overdue_path,
        scores_path=a.scores_path, totals=a.totals, open_from=a.open_from)


if __name__ == "__main__":
    main()
