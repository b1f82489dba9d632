"""Query catalog: every named operator and pipeline over the bound tables.

Each entry is a function of the bindings; ``catalog()`` makes it one of
``(spark, sf_dir)``.  It returns a DataFrame; nothing is
collected but the counts that size a broadcast.  Parameters (days, labels, channels) are the fixed test arguments
from ``riskgraph.sources.bindings``.  Keys follow the inventory IDs.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.functions import exprs as X
from riskgraph.operators import cohorts, edges, neighbours, repayment, segments
from riskgraph.operators import history_totals as H
from riskgraph.plans import exports
from riskgraph.session import scratch_path
from riskgraph.sources import bindings as B
from riskgraph.sources.tables import buckets_for, history, snapshot, store_bucketed

Query = Callable[[SparkSession, str], DataFrame]
BOUND: dict[str, Callable[[B.Bindings], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        BOUND[name] = fn
        return fn
    return deco


def _ts_text(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as ``YYYY-MM-DD HH:MM:SS`` text for engine-neutral comparison."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c) for c in df.columns])


# --- shared pieces ------------------------------------------------------------

def applied_cohort(b: B.Bindings) -> DataFrame:
    return cohorts.applied(b.user_profile, b.user_contact, B.DAY)


def passed(b: B.Bindings) -> DataFrame:
    return cohorts.passed_summary(b.user_profile, b.user_contact, B.DAY)


def history_calls(b: B.Bindings) -> DataFrame:
    """Call history before the snapshot day (the person graph)."""
    return history(b.call_detail, B.HISTORY_BEFORE)


def history_to_today(b: B.Bindings) -> DataFrame:
    """Call history before today (all other graphs)."""
    return history(b.call_detail, B.HISTORY_TO_TODAY)


def c15_edges(b: B.Bindings) -> DataFrame:
    return edges.call_edges(history_calls(b), applied_cohort(b))


def c15_edges_to_today(b: B.Bindings) -> DataFrame:
    return edges.call_edges(history_to_today(b), applied_cohort(b))


def c22_edges(b: B.Bindings) -> DataFrame:
    return edges.rank_edges(history_to_today(b), applied_cohort(b))


def c19_cohort(b: B.Bindings) -> DataFrame:
    return cohorts.incremental_applicants(b.credit_apply, b.user_contact, B.INCREMENT_DAY, B.INCREMENT_AFTER)


def c25_facts(b: B.Bindings) -> DataFrame:
    return repayment.overdue_info(b.repay_plan, b.user_profile, B.DAY, B.LOANS_SINCE, decode=B.decode_mobile)


def _adjacency_text(adj: DataFrame) -> DataFrame:
    return adj.select("mobile", F.concat_ws("\t", "neighbours").alias("neighbours"))


# --- C: pipelines ---------------------------------------------------------------

@query("c01_applied")
def q_c01(b):
    return applied_cohort(b)


@query("c02_applied_not_passed")
def q_c02(b):
    return cohorts.applied_not_passed(b.user_profile, b.user_contact, B.DAY)


@query("c03_passed_summary")
def q_c03(b):
    return _ts_text(passed(b), "first_apply_loan_succ_time")


@query("c04_passed_no_borrow")
def q_c04(b):
    return segments.passed_no_borrow(passed(b))


@query("c05_whitelist")
def q_c05(b):
    return segments.whitelist(passed(b))


@query("c06_whitelist_strict")
def q_c06(b):
    return segments.whitelist(passed(b), max_prepay=3)


@query("c07_whitelist_early")
def q_c07(b):
    return segments.whitelist(passed(b), require_no_inloan=False)


@query("c08_greylist")
def q_c08(b):
    return segments.greylist(passed(b))


@query("c09_blacklist")
def q_c09(b):
    return segments.blacklist(passed(b))


@query("c10_blacklist_wide")
def q_c10(b):
    return segments.blacklist(passed(b), min_overdue=7)


@query("c11_third_party")
def q_c11(b):
    return segments.third_party(b.third_party_blacklist, B.DAY)


def _fraud(b):
    return segments.fraud_history_mobiles(b.repay_plan, b.collection_record, b.user_contact, B.DAY,
                                          B.FRAUD, B.FRAUD_SEGMENTS)


@query("c12_fraud_history")
def q_c12(b):
    return _fraud(b)


@query("c13_merged_blacklist")
def q_c13(b):
    return segments.merged_blacklist(passed(b), b.third_party_blacklist, b.repay_plan,
                                     b.collection_record, b.user_contact, B.DAY,
                                     B.FRAUD, B.FRAUD_SEGMENTS)


@query("c14_segments_per_user")
def q_c14(b):
    return segments.segments_per_user(b.user_profile, b.user_contact, B.DAY)


@query("c15_call_edges")
def q_c15(b):
    return edges.with_mean_text(c15_edges(b))


@query("c15_call_edges_to_today")
def q_c15_to_today(b):
    """C15 as the graph export reads it: calls up to today."""
    return edges.with_mean_text(c15_edges_to_today(b))


def c16_edges(b):
    return edges.call_edges(history_to_today(b), pattern=X.LOOSE, prefix=X.PREFIX)


def c17_edges(b):
    return edges.call_edges(history_to_today(b), passed(b).select("mobile"), ends="owner")


def c18_edges(b):
    return edges.call_edges(history_to_today(b), passed(b).select("mobile"), pattern=X.ANY11, check="history")


@query("c16_call_edges_loose")
def q_c16(b):
    return edges.with_mean_text(c16_edges(b))


@query("c16_call_edges_loose_drop")
def q_c16_drop(b):
    """C16 on records with unknown channels and short numbers, which it drops and keeps."""
    calls = history(b.call_detail_dirty, B.HISTORY_TO_TODAY)
    return edges.with_mean_text(edges.call_edges(calls, pattern=X.LOOSE, prefix=X.PREFIX, on_unknown="drop"))


@query("c17_call_edges_owner")
def q_c17(b):
    return edges.with_mean_text(c17_edges(b))


@query("c18_call_edges_passed")
def q_c18(b):
    return edges.with_mean_text(c18_edges(b))


@query("c15_call_edges_shuffled")
def q_c15_shuffled(b):
    """C15 by the plan for a cohort beyond the broadcast budget."""
    return edges.with_mean_text(edges.call_edges(history_calls(b), applied_cohort(b), broadcast=False))


@query("c22_rank_edges_shuffled")
def q_c22_shuffled(b):
    """C22 by the plan for a cohort beyond the broadcast budget."""
    return edges.rank_edges(history_to_today(b), applied_cohort(b), broadcast=False)


@query("c19_incremental_applicants")
def q_c19(b):
    return c19_cohort(b)


@query("c20_incremental_edges")
def q_c20(b):
    calls = snapshot(b.call_detail_year, B.YEAR_DAY)
    return edges.with_mean_text(edges.call_edges(calls, c19_cohort(b)))


@query("c20_incremental_edges_all")
def q_c20_all(b):
    calls = snapshot(b.call_detail_year, B.YEAR_DAY)
    return edges.with_mean_text(edges.call_edges(calls, c19_cohort(b), min_n=1))


@query("c20_incremental_edges_mixed")
def q_c20_mixed(b):
    """The other reading of the increment job: the record owner is a new
    applicant of the day, the other end any applicant."""
    calls = snapshot(b.call_detail_year, B.YEAR_DAY)
    return edges.with_mean_text(edges.call_edges(calls, c19_cohort(b), dst_members=applied_cohort(b), min_n=1))


@query("c20_incremental_edges_loose")
def q_c20_loose(b):
    calls = snapshot(b.call_detail_year, B.YEAR_DAY)
    return edges.with_mean_text(edges.call_edges(calls, None, pattern=X.LOOSE, prefix=X.PREFIX, min_n=1))


@query("c21_persons")
def q_c21(b):
    return edges.persons(c15_edges(b))


@query("c22_rank_edges")
def q_c22(b):
    return c22_edges(b)


@query("c23_one_degree")
def q_c23(b):
    return _adjacency_text(neighbours.one_degree(c22_edges(b), distinct_pairs=True))


@query("c24_one_degree_undirected")
def q_c24(b):
    return _adjacency_text(neighbours.one_degree(c22_edges(b), directed=False))


@query("c25_overdue_info")
def q_c25(b):
    return c25_facts(b)


@query("c26_score_vs_overdue")
def q_c26(b):
    return repayment.score_vs_overdue(c25_facts(b), b.rank_score)


def _stored_totals(b, calls, before):
    """Totals of the calls, written, rolled up and read back.  The calls are
    stamped with their month's first day, so that there is a folder a month."""
    calls = calls.withColumn("dt", F.concat(F.substring("dt", 1, 7), F.lit("-01")))
    root = scratch_path(b.spark, "call-totals")
    H.refresh_totals(b.spark, calls, root, before)
    H.roll_months(b.spark, root, before)
    return H.read_totals(b.spark, None, root, before)


@query("c15_call_edges_from_totals")
def q_c15_totals(b):
    """C15 from stored totals of the calls instead of the calls."""
    totals = _stored_totals(b, history_calls(b), B.HISTORY_BEFORE)
    return edges.with_mean_text(H.call_edges_from_totals(totals, applied_cohort(b)))


@query("c22_rank_edges_from_totals")
def q_c22_totals(b):
    """C22 from stored totals of the calls."""
    return H.rank_edges_from_totals(_stored_totals(b, history_to_today(b), B.HISTORY_TO_TODAY), applied_cohort(b))


@query("c17_call_edges_bucketed")
def q_c17_bucketed(b):
    """C17 on calls stored in buckets of the record owner, which no step up to
    the owner's semi-join shuffles."""
    name = f"rg_calls_{uuid.uuid4().hex}"
    found = history_to_today(b)
    calls = store_bucketed(found, name, buckets_for(found), path=scratch_path(b.spark, "bucketed-calls"))
    return edges.with_mean_text(edges.call_edges(calls, passed(b).select("mobile"), ends="owner", broadcast=False))


@query("c26_score_vs_overdue_split")
def q_c26_split(b):
    """C26 by the join that splits mobiles of many rows (here of more than two)."""
    return repayment.scored_facts_split(c25_facts(b), b.rank_score, hot_rows=2).select("score", "overdue_day")


@query("c27_graph_lists")
def q_c27_lists(b):
    return segments.graph_lists_from(cohorts.day_users(b.user_profile, b.user_contact, B.DAY))


@query("c27_graph_lines")
def q_c27_lines(b):
    return exports.as_rows(exports.graph_parts(b.user_profile, b.user_contact, b.call_detail, B.AS_OF))


@query("c28_ranking_lines")
def q_c28_lines(b):
    return exports.as_rows(exports.ranking_parts(
        b.user_profile, b.user_contact, b.call_detail, b.third_party_blacklist, b.repay_plan, b.collection_record,
        B.AS_OF, B.FRAUD, B.FRAUD_SEGMENTS))


@query("c29_snapshot_lines")
def q_c29_lines(b):
    return exports.as_rows(exports.snapshot_parts(b.user_profile, b.user_contact, b.call_detail, B.DAY,
                                                  B.HISTORY_TO_TODAY))


@query("c30_call_graph_lines")
def q_c30_lines(b):
    return exports.as_rows(exports.call_graph_parts(c15_edges(b)))


def _unbound(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(B.Bindings(spark, sf_dir))
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def bound() -> dict[str, Callable[[B.Bindings], DataFrame]]:
    from riskgraph.plans import operator_queries  # noqa: F401  (registers the operator entries)
    return dict(BOUND)


def catalog() -> dict[str, Query]:
    return {name: _unbound(fn) for name, fn in bound().items()}
