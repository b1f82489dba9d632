"""Catalog entries for single operators (S, P, F, J, A, U, X, O, K rows).

Each runs one operator over the bound tables, whole, so its oracle checks that
operator alone.  The pipelines in ``catalog`` compose the same functions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskgraph.functions import exprs as X
from riskgraph.operators import cohorts, edges, neighbours, repayment, segments
from riskgraph.plans.catalog import applied_cohort, c15_edges, c22_edges, c25_facts, history_calls, passed, query
from riskgraph.session import scratch_path
from riskgraph.sinks import lines
from riskgraph.sources import bindings as B
from riskgraph.sources.tables import OVERDUE_LINE, history, parse_delimited, read_delimited, register, snapshot

CALLS = ["mobile", "other_mobile", "call_channel", "call_time"]


def _valid_oriented(b):
    """History oriented, both ends strict numbers, with the duration."""
    c = edges.valid_pairs(history_calls(b).select(*CALLS), X.MOBILE, "mobile", "other_mobile")
    return edges.orient_calls(c).select("src", "dst", X.digits_or_zero("call_time").alias("duration"))


# --- S: sources -------------------------------------------------------------------

@query("s1_snapshot")
def q_s1(b):
    return snapshot(b.user_contact, B.DAY).select("user_id", "ds", "mobile")


@query("s2_history")
def q_s2(b):
    return history_calls(b).select(*CALLS, "dt")


@query("s3_day_increment")
def q_s3(b):
    return snapshot(b.call_detail_year, B.YEAR_DAY).select(*CALLS)


@query("s4_read_delimited")
def q_s4(b):
    """Loan lines written as text files, then read back as typed columns."""
    path = scratch_path(b.spark, "loan-lines")
    lines.write_lines(lines.format_overdue_line(c25_facts(b)), path)
    return read_delimited(b.spark, path, OVERDUE_LINE)


@query("s6_registered_view")
def q_s6(b):
    register(applied_cohort(b), "rg_applied_cohort")
    return b.spark.sql("SELECT mobile FROM rg_applied_cohort")


# --- P / F: projections and filters ------------------------------------------------

@query("p1_projection")
def q_p1(b):
    return snapshot(b.user_profile, B.DAY).select(
        F.col("user_id").alias("uid"), F.col("ds").alias("channel"),
        F.col("max_overdue_day_cnt").alias("overdue"))


@query("p2_orient_calls")
def q_p2(b):
    return edges.orient_calls(history_calls(b).select(*CALLS))


@query("p2_orient_calls_drop")
def q_p2_drop(b):
    """Records with an unknown channel among them, dropped."""
    calls = history(b.call_detail_dirty, B.HISTORY_BEFORE).select(*CALLS)
    return edges.orient_calls(calls, on_unknown="drop")


@query("p3_reverse_edges")
def q_p3(b):
    return edges.reverse_edges(c22_edges(b))


@query("p4_split_pair")
def q_p4(b):
    return edges.split_pair(lines.format_pair_line(c22_edges(b)), col="line")


@query("p5_edge_nodes")
def q_p5(b):
    return edges.edge_nodes(c22_edges(b))


@query("f1_lifecycle_nulls")
def q_f1(b):
    return cohorts.applied_unpassed(snapshot(b.user_profile, B.DAY)).select("user_id", "ds")


@query("f2_null_as_zero_threshold")
def q_f2(b):
    p = passed(b)
    return p.filter(X.nz("max_overdue_day_cnt") <= 7).select("mobile", "max_overdue_day_cnt")


@query("f3_due_or_settled")
def q_f3(b):
    r = snapshot(b.repay_plan, B.DAY)
    return repayment.due_or_settled(r, B.LOANS_SINCE, B.DAY).select(
        "loan_id", "user_id", "ds", "early_day", "overdue_day")


@query("f4_fraud_loans")
def q_f4(b):
    return segments.fraud_loans(b.collection_record, B.DAY, B.FRAUD, B.FRAUD_SEGMENTS)


@query("f5_later_than_day")
def q_f5(b):
    a = snapshot(b.credit_apply, B.DAY)
    return a.filter(X.later_than_day("apply_time", B.INCREMENT_AFTER)).select("user_id", "ds")


def _ends(b):
    """Both numbers of records that hold short numbers and numbers that begin with 0."""
    return history(b.call_detail_dirty, B.HISTORY_BEFORE).select("mobile", "other_mobile")


@query("f6_valid_pairs")
def q_f6(b):
    return edges.valid_pairs(_ends(b), X.MOBILE, "mobile", "other_mobile")


@query("f7_valid_pairs_loose")
def q_f7(b):
    c = _ends(b).select(X.prefixed("mobile").alias("mobile"), X.prefixed("other_mobile").alias("other_mobile"))
    return edges.valid_pairs(c, X.LOOSE, "mobile", "other_mobile")


@query("f8_valid_pairs_any11")
def q_f8(b):
    return edges.valid_pairs(_ends(b), X.ANY11, "mobile", "other_mobile")


@query("f9_min_calls")
def q_f9(b):
    return edges.min_calls(edges.edge_stats(_valid_oriented(b)), 2).select("src", "dst", "calls")


# --- J: joins -------------------------------------------------------------------------

@query("j1_with_contact")
def q_j1(b):
    users = snapshot(b.user_profile, B.DAY).select("user_id", "ds")
    return cohorts.with_contact(users, snapshot(b.user_contact, B.DAY).select("user_id", "ds", "mobile"))


@query("j2_left_join_day_in_on")
def q_j2(b):
    r = snapshot(b.repay_plan, B.DAY).select("loan_id", "user_id", "ds")
    return segments.with_day_contact(r, b.user_contact, B.DAY).select("loan_id", "user_id", "mobile")


@query("j3_in_subquery")
def q_j3(b):
    fraud = segments.fraud_loans(b.collection_record, B.DAY, B.FRAUD, B.FRAUD_SEGMENTS)
    return segments.loans_in(b.repay_plan, fraud, B.DAY).select("loan_id", "user_id", "ds")


@query("j4_between_members")
def q_j4(b):
    return edges.between_members(history_calls(b).select(*CALLS), applied_cohort(b), broadcast=False)


@query("j5_between_members_broadcast")
def q_j5(b):
    return edges.between_members(history_calls(b).select(*CALLS), applied_cohort(b), broadcast="auto")


@query("j6_between_passed")
def q_j6(b):
    return edges.between_members(history_calls(b).select(*CALLS), passed(b).select("mobile"))


@query("j7_owned_by_members")
def q_j7(b):
    return edges.owned_by_members(history_calls(b).select(*CALLS), passed(b).select("mobile"))


@query("j8_scores_by_mobile")
def q_j8(b):
    return repayment.scored_facts(c25_facts(b), b.rank_score).select("mobile", "loan_id", "score")


# --- A / U: aggregates and unions ---------------------------------------------------

@query("a1_max_per_mobile")
def q_a1(b):
    return passed(b).select("mobile", "max_overdue_day_cnt", "curr_inloan_cnt")


@query("a2_loan_extremes")
def q_a2(b):
    return repayment.loan_extremes(snapshot(b.repay_plan, B.DAY))


@query("a3_edge_stats")
def q_a3(b):
    return edges.with_mean_text(edges.edge_stats(_valid_oriented(b)))


@query("a4_edge_pairs")
def q_a4(b):
    return edges.edge_pairs(_valid_oriented(b))


@query("a5_distinct")
def q_a5(b):
    return snapshot(b.user_contact, B.DAY).select("mobile").distinct()


@query("a6_out_neighbours")
def q_a6(b):
    return neighbours.out_neighbours(c22_edges(b))


@query("a7_in_neighbours")
def q_a7(b):
    return neighbours.in_neighbours(c22_edges(b))


@query("a8_all_neighbours")
def q_a8(b):
    return neighbours.all_neighbours(c22_edges(b))


@query("u1_merge_lists")
def q_u1(b):
    """Lists that overlap: early white, strict white and wide black."""
    p = passed(b)
    return segments.merge_lists(segments.whitelist(p, require_no_inloan=False), segments.whitelist(p, max_prepay=3),
                                segments.blacklist(p, min_overdue=7))


@query("u2_union_adjacency")
def q_u2(b):
    return neighbours.both_directions(c22_edges(b))


# --- X: scalar functions ---------------------------------------------------------------

@query("x1_digits_or_zero")
def q_x1(b):
    c = history_calls(b)
    return c.select("call_time", X.digits_or_zero("call_time").alias("duration"))


@query("x2_two_decimals")
def q_x2(b):
    e = edges.edge_stats(_valid_oriented(b))
    return e.select("src", "dst", X.two_decimals("mean_duration").alias("mean_text"))


@query("x3_concat")
def q_x3(b):
    u = snapshot(b.user_contact, B.DAY)
    return u.select(F.concat_ws(",", F.col("user_id").cast("string"), "ds", "mobile").alias("line"))


@query("x4_prefixed")
def q_x4(b):
    c = snapshot(b.user_contact, B.DAY)
    return c.select("user_id", X.prefixed("mobile").alias("mobile"))


def _dirty_numbers(b):
    """Call-record numbers in the loader's ``p`` form with the country code and
    carrier tag forms the clean-up rules target, derived row by row."""
    c = history_calls(b)
    k = F.substring("other_mobile", 11, 1)
    dirty = (F.when(k == "1", F.concat(F.lit("p0086"), "other_mobile", F.lit(";cpc")))
             .when(k == "2", F.concat(F.lit("p86"), "other_mobile"))
             .when(k == "3", F.concat(F.lit("p"), "other_mobile", F.lit(";cpc")))
             .when(k == "4", F.concat(F.lit("p(86)"), "other_mobile"))
             .when(k == "5", F.concat(F.lit("p86"), "other_mobile", F.lit(";cpc")))
             .otherwise(F.concat(F.lit("p"), "other_mobile")))
    return c.select(dirty.alias("raw"))


@query("x5_clean_phone_a")
def q_x5(b):
    d = _dirty_numbers(b)
    return d.select("raw", X.clean_phone_a("raw").alias("clean"))


@query("x6_clean_phone_b")
def q_x6(b):
    d = _dirty_numbers(b)
    return d.select("raw", X.clean_phone_b("raw").alias("clean"))


@query("x7_day_of")
def q_x7(b):
    r = snapshot(b.repay_plan, B.DAY)
    return r.select("loan_id", X.to_day("create_time").cast("string").alias("create_day"),
                    X.to_day("due_day").cast("string").alias("due_day"))


@query("x8_split_cast")
def q_x8(b):
    return parse_delimited(lines.format_overdue_line(c25_facts(b)), OVERDUE_LINE, col="line")


# --- O: orders --------------------------------------------------------------------------

@query("o1_order_by_score")
def q_o1(b):
    return repayment.order_by_score(repayment.scored_facts(c25_facts(b), b.rank_score)).select("score", "overdue_day")


@query("o2_order_by_text_key")
def q_o2(b):
    c = snapshot(b.user_contact, B.DAY).select(F.col("user_id").cast("string").alias("k"), "mobile")
    return repayment.order_by_text_key(c, "k")


# --- K: sinks and line formats ----------------------------------------------------------

@query("k1_write_lines")
def q_k1(b):
    """A list written under its dated folder (K3) and read back."""
    base = scratch_path(b.spark, "lists")
    path = lines.dated_path(base, B.DAY, "whitelist")
    lines.write_lines(lines.format_mobile_line(segments.whitelist(passed(b))), path)
    return b.spark.read.text(f"{base}/{B.DAY}/whitelist")


@query("k2_one_file")
def q_k2(b):
    """The same list as one file: number of files and lines."""
    path = scratch_path(b.spark, "list")
    lines.write_lines(lines.format_mobile_line(segments.whitelist(passed(b))), path, single_file=True)
    one = b.spark.read.text(path).select("value", F.input_file_name().alias("file"))
    return one.agg(F.count_distinct("file").alias("files"), F.count("value").alias("lines"))


@query("k4_edge_lines")
def q_k4(b):
    return lines.format_edge_line(c15_edges(b))


@query("k5_pair_lines")
def q_k5(b):
    return lines.format_pair_line(c22_edges(b))


@query("k6_adjacency_lines")
def q_k6(b):
    return lines.format_adjacency_line(neighbours.one_degree(c22_edges(b)))


@query("k7_overdue_lines")
def q_k7(b):
    return lines.format_overdue_line(c25_facts(b))


@query("k8_score_lines")
def q_k8(b):
    return lines.format_score_line(repayment.score_vs_overdue(c25_facts(b), b.rank_score))

