"""Risk-list rules: null as zero, overlaps, inclusions."""
import datetime as dt

from riskgraph.operators import cohorts, segments
from riskgraph.plans import catalog as Q
from riskgraph.sources import bindings as B
from tests.conftest import SF0001, rows

T0 = dt.datetime(2001, 1, 1)
PROFILE = ("user_id bigint, ds string, dt string, first_apply_credit_time timestamp_ntz, "
           "first_apply_credit_succ_time timestamp_ntz, first_apply_loan_succ_time timestamp_ntz, "
           "max_overdue_day_cnt int, curr_inloan_cnt int, max_prepayment_day_cnt int, mobile_encode string")
CONTACT = "user_id bigint, ds string, dt string, mobile string"
D = "2001-08-31"


def _tables(spark):
    profile = spark.createDataFrame([
        (1, "w", D, T0, T0, T0, None, None, None, None),     # nulls read as 0 -> white
        (2, "w", D, T0, T0, T0, 7, 1, 0, None),              # in loan -> no list
        (3, "w", D, T0, T0, T0, 7, 0, 5, None),              # white, not strict white
        (4, "w", D, T0, T0, T0, 14, 0, 0, None),             # grey
        (5, "w", D, T0, T0, T0, 15, 0, 0, None),             # black
        (6, "w", D, T0, T0, None, 30, 0, 0, None),           # passed, no loan
        (7, "w", D, T0, None, None, 30, 0, 0, None),         # applied, not passed
        (8, "w", D, T0, T0, T0, 3, 0, 0, None),              # same mobile as 7: passed and not passed
        (9, "w", "2001-08-30", T0, T0, T0, 0, 0, 0, None),   # stale snapshot: ignored
    ], PROFILE)
    contact = spark.createDataFrame(
        [(i, "w", D, f"m{i}") for i in range(1, 7)] + [(7, "w", D, "m7"), (8, "w", D, "m7"), (9, "w", D, "m9")],
        CONTACT)
    return profile, contact


def test_list_rules(spark):
    profile, contact = _tables(spark)
    passed = cohorts.passed_summary(profile, contact, D)
    m = lambda df: [r[0] for r in rows(df)]
    assert m(segments.whitelist(passed)) == ["m1", "m3", "m7"]
    assert m(segments.whitelist(passed, max_prepay=3)) == ["m1", "m7"]
    assert m(segments.whitelist(passed, require_no_inloan=False)) == ["m1", "m2", "m3", "m7"]
    assert m(segments.greylist(passed)) == ["m4"]
    assert m(segments.blacklist(passed)) == ["m5"]
    assert m(segments.blacklist(passed, min_overdue=7)) == ["m2", "m3", "m4", "m5"]
    assert m(segments.passed_no_borrow(passed)) == ["m6"]
    assert m(cohorts.applied_not_passed(profile, contact, D)) == ["m7"]
    assert m(cohorts.applied(profile, contact, D)) == ["m1", "m2", "m3", "m4", "m5", "m6", "m7"]
    per_user = rows(segments.segments_per_user(profile, contact, D))
    assert ("whitelist", "pm2") in per_user and ("blacklist", "pm7") not in per_user


def test_fraud_history_matches_loan_id_only_and_keeps_misses(spark):
    repay = spark.createDataFrame(
        [(10, 1, "a", D), (10, 2, "b", D), (11, 3, "a", D), (12, 4, "a", D)],
        "loan_id bigint, user_id bigint, ds string, dt string")
    collection = spark.createDataFrame(
        [(10, "a", "FRAUD", D), (11, "zz", "FRAUD", D), (12, "a", "OTHER", D)],
        "loan_id bigint, ds string, loan_name string, dt string")
    contact = spark.createDataFrame([(1, "a", D, "m1"), (2, "b", "2001-08-30", "m2")], CONTACT)
    got = rows(segments.fraud_history_mobiles(repay, collection, contact, D, "FRAUD", ["a", "b"]))
    # loan 10 of channel b matches by id alone; user 2's contact is stale -> null mobile kept
    assert got == [("m1",), (None,)]
    merged = segments.merge_lists(segments.fraud_history_mobiles(repay, collection, contact, D, "FRAUD", ["a"]))
    assert rows(merged) == [("m1",)]


def test_list_properties_on_bound_tables(spark):
    b = B.Bindings(spark, SF0001)
    p = Q.passed(b)
    s = lambda df: {r[0] for r in df.collect()}
    white, strict, early = s(segments.whitelist(p)), s(segments.whitelist(p, max_prepay=3)), \
        s(segments.whitelist(p, require_no_inloan=False))
    black, wide = s(segments.blacklist(p)), s(segments.blacklist(p, min_overdue=7))
    assert not (black & white)
    assert black <= wide
    assert strict <= white <= early


def test_day_users_derivations_equal_direct_cohorts(spark):
    b = B.Bindings(spark, SF0001)
    rows_ = cohorts.day_users(b.user_profile, b.user_contact, D)
    assert rows(cohorts.applied_from(rows_)) == rows(cohorts.applied(b.user_profile, b.user_contact, D))
    assert rows(cohorts.applied_not_passed_from(rows_)) == \
        rows(cohorts.applied_not_passed(b.user_profile, b.user_contact, D))
    assert rows(cohorts.passed_summary_from(rows_)) == rows(cohorts.passed_summary(b.user_profile, b.user_contact, D))


def test_graph_properties_on_bound_tables(spark):
    from riskgraph.operators import edges, neighbours
    b = B.Bindings(spark, SF0001)
    c15 = Q.c15_edges(b)
    ends = {r["src"] for r in c15.collect()} | {r["dst"] for r in c15.collect()}
    assert {r[0] for r in edges.persons(c15).collect()} == ends            # C21 = ends of C15
    und = {(r["mobile"], r["neighbour"]) for r in neighbours.all_neighbours(Q.c22_edges(b)).collect()}
    assert und and all((n, m) in und for m, n in und)                       # C24 is symmetric
    c22 = {(r["src"], r["dst"]) for r in Q.c22_edges(b).collect()}
    assert {(s, d) for s, d, *_ in c15.collect()} <= c22                    # C15 pairs are ranking pairs
