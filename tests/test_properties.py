"""Random call tables against a brute-force Python model of the call graph."""
import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskgraph.functions.exprs import CHANNEL_IN, CHANNEL_OUT
from riskgraph.operators import edges
from riskgraph.operators.membership import BUDGET_CONF

NUMBERS = ["13800000001", "13800000002", "13800000003", "03800000004", "1380000005", "p13800000006", None]
DURATIONS = ["0", "7", "60", "12a", "", None, "12\n", "300"]
SCHEMA = "mobile string, other_mobile string, call_channel string, call_time string, dt string"
STRICT = re.compile(r"1[0-9]{10}")

call = st.tuples(st.sampled_from(NUMBERS), st.sampled_from(NUMBERS),
                 st.sampled_from([CHANNEL_OUT, CHANNEL_IN]), st.sampled_from(DURATIONS))


def model(rows, members, min_n):
    acc = defaultdict(lambda: [0, 0.0])
    for m, o, ch, t in rows:
        if members is not None and not (m in members and o in members):
            continue
        if not (m and o and STRICT.fullmatch(m) and STRICT.fullmatch(o)):
            continue
        src, dst = (m, o) if ch == CHANNEL_OUT else (o, m)
        d = float(t) if t is not None and re.fullmatch(r"[0-9]+", t) else 0.0
        acc[(src, dst)][0] += 1
        acc[(src, dst)][1] += d
    return {k: (n, s / n) for k, (n, s) in acc.items() if n >= min_n}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(call, min_size=0, max_size=40),
       members=st.one_of(st.none(), st.sets(st.sampled_from([n for n in NUMBERS if n]), max_size=5)),
       min_n=st.sampled_from([1, 2, 3]))
def test_call_edges_match_model(spark, rows, members, min_n):
    df = spark.createDataFrame([(m, o, c, t, "d") for m, o, c, t in rows], SCHEMA)
    cohort = None if members is None else spark.createDataFrame([(x,) for x in sorted(members)], "mobile string")
    got = {(r["src"], r["dst"]): (r["calls"], r["mean_duration"])
           for r in edges.call_edges(df, cohort, min_n=min_n).collect()}
    assert got == model(rows, members, min_n)
    if cohort is not None:
        pairs = {(r["src"], r["dst"]) for r in edges.rank_edges(df, cohort).collect()}
        assert pairs == set(model(rows, members, 1))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(call, min_size=0, max_size=40),
       members=st.sets(st.sampled_from([n for n in NUMBERS if n]), max_size=5),
       min_n=st.sampled_from([1, 2]), owner=st.booleans())
def test_shuffle_membership_plan_matches_model(spark, rows, members, min_n, owner):
    spark.conf.set(BUDGET_CONF, "-1")   # cohort never broadcast
    try:
        df = spark.createDataFrame([(m, o, c, t, "d") for m, o, c, t in rows], SCHEMA)
        cohort = spark.createDataFrame([(x,) for x in sorted(members)], "mobile string")
        got = {(r["src"], r["dst"]): (r["calls"], r["mean_duration"])
               for r in edges.call_edges(df, cohort, min_n=min_n, ends="owner" if owner else "both").collect()}
        if owner:
            want = model([r for r in rows if r[0] in members], None, min_n)
        else:
            want = model(rows, members, min_n)
        assert got == want
        pairs = {(r["src"], r["dst"]) for r in edges.rank_edges(df, cohort).collect()}
        assert pairs == set(model(rows, members, 1))
    finally:
        spark.conf.unset(BUDGET_CONF)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(call, st.sampled_from(["d1", "d2", "d3"])), min_size=0, max_size=40),
       members=st.one_of(st.none(), st.sets(st.sampled_from([n for n in NUMBERS if n]), max_size=5)),
       min_n=st.sampled_from([1, 2]), owner=st.booleans(), shuffle_plan=st.booleans())
def test_rolled_totals_match_model(spark, rows, members, min_n, owner, shuffle_plan):
    from riskgraph.operators import history_totals as H
    flat = [c for c, _ in rows]
    df = spark.createDataFrame([(m, o, c, t, d) for (m, o, c, t), d in rows], SCHEMA)
    totals = H.day_totals(df)
    cohort = None if members is None else spark.createDataFrame([(x,) for x in sorted(members)], "mobile string")
    if shuffle_plan:
        spark.conf.set(BUDGET_CONF, "-1")
    try:
        ends = "owner" if owner and cohort is not None else "both"
        got = {(r["src"], r["dst"]): (r["calls"], r["mean_duration"])
               for r in H.call_edges_from_totals(totals, cohort, min_n=min_n, ends=ends).collect()}
        if ends == "owner":
            want = model([r for r in flat if r[0] in members], None, min_n)
        else:
            want = model(flat, members, min_n)
        assert got == want
        if cohort is not None:
            pairs = {(r["src"], r["dst"]) for r in H.rank_edges_from_totals(totals, cohort).collect()}
            assert pairs == set(model(flat, members, 1))
    finally:
        spark.conf.unset(BUDGET_CONF)


def test_daily_totals_follow_the_raw_calls(spark, tmp_path):
    import os
    import pytest
    from riskgraph.operators import history_totals as H
    first = [("13800000001", "13800000002", CHANNEL_OUT, "60", "2001-01-01"),
             ("13800000001", "13800000002", CHANNEL_OUT, "x", "2001-01-02"),
             ("13800000003", "13800000002", CHANNEL_IN, "5", "2001-01-02")]
    root, before = str(tmp_path / "totals"), "2001-01-04"

    def raw(data):
        return spark.createDataFrame(data, SCHEMA)

    def graph(data):
        return sorted(map(tuple, H.call_edges_from_totals(H.read_totals(spark, raw(data), root, before), min_n=1).collect()))

    with pytest.raises(ValueError, match="2001-01-01, 2001-01-02"):   # nothing stored yet
        H.read_totals(spark, raw(first), root, before)
    assert H.refresh_totals(spark, raw(first), root, before) == ["2001-01-01", "2001-01-02"]
    assert H.refresh_totals(spark, raw(first), root, before) == []
    assert graph(first) == sorted(map(tuple, edges.call_edges(raw(first), min_n=1).collect()))
    # a call that lands late in a day that is stored, and a new day
    late = first + [("13800000001", "13800000002", CHANNEL_OUT, "7", "2001-01-01"),
                    ("13800000004", "13800000002", CHANNEL_OUT, "1", "2001-01-03")]
    with pytest.raises(ValueError, match="2001-01-01, 2001-01-03"):
        H.read_totals(spark, raw(late), root, before)
    assert H.refresh_totals(spark, raw(late), root, before) == ["2001-01-01", "2001-01-03"]
    assert graph(late) == sorted(map(tuple, edges.call_edges(raw(late), min_n=1).collect()))
    # an empty folder is found, not read as zero calls
    folder = f"{root}/dt=2001-01-02"
    for f in os.listdir(folder):
        os.remove(f"{folder}/{f}")
    with pytest.raises(ValueError, match="2001-01-02"):
        H.read_totals(spark, raw(late), root, before)


def test_corrected_and_emptied_days_are_seen(spark, tmp_path):
    import pytest
    from riskgraph.operators import history_totals as H
    root, before = str(tmp_path / "totals"), "2001-01-04"
    first = [("13800000001", "13800000002", CHANNEL_OUT, "60", "2001-01-01"),
             ("13800000001", "13800000002", CHANNEL_OUT, "60", "2001-01-01"),
             ("13800000003", "13800000002", CHANNEL_OUT, None, "2001-01-02")]

    def raw(data):
        return spark.createDataFrame(data, SCHEMA)

    def graph(data, **how):
        return sorted(map(tuple, H.call_edges_from_totals(H.read_totals(spark, raw(data), root, before, **how), min_n=1).collect()))

    def check(data, days):
        with pytest.raises(ValueError, match=days[0]):
            H.read_totals(spark, raw(data), root, before)
        assert H.refresh_totals(spark, raw(data), root, before) == days
        assert graph(data) == sorted(map(tuple, edges.call_edges(raw(data), min_n=1).collect()))

    check(first, ["2001-01-01", "2001-01-02"])
    # one duration corrected, the number of calls unchanged
    corrected = [first[0], (*first[1][:3], "600", "2001-01-01"), first[2]]
    check(corrected, ["2001-01-01"])
    # a closed day is compared by its number of calls only
    again = [first[0], first[0], first[2]]
    assert H.stale_days(spark, raw(again), root, before) == ["2001-01-01"]
    assert H.stale_days(spark, raw(again), root, before, open_from="2001-01-02") == []
    # a day that loses all its calls goes, for good
    emptied = corrected[:2]
    check(emptied, ["2001-01-02"])
    assert H.refresh_totals(spark, raw(emptied), root, before) == []
    # and may come back
    check(corrected, ["2001-01-02"])


def test_hot_mobile_is_split_in_the_score_join(spark):
    from collections import Counter
    from riskgraph.operators import repayment
    facts = [(i, "w", "hot" if i % 3 == 0 else f"m{i % 400}", i % 2, i % 5) for i in range(6000)] + [(1, "w", None, 0, 0)]
    scores = [("hot", float(k)) for k in range(4)] + [(f"m{k}", 1.0) for k in range(400)] + [("m7", 2.0)] * 700
    o = spark.createDataFrame(facts, "loan_id bigint, ds string, mobile string, early_day int, overdue_day int")
    s = spark.createDataFrame(scores, "mobile string, score double")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        split = repayment.scored_facts_split(o, s, hot_rows=50)
        tasks = Counter(r[0] for r in split.selectExpr("spark_partition_id()").collect())
        counts = sorted(tasks.values())
        assert counts[-1] <= 3 * counts[len(counts) // 2]
        plain = repayment.scored_facts(o, s)
        whole = Counter(r[0] for r in plain.selectExpr("spark_partition_id()").collect())
        assert max(whole.values()) > 3 * sorted(whole.values())[len(whole) // 2]
        assert Counter(map(tuple, split.select(plain.columns).collect())) == Counter(map(tuple, plain.collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _nz(v):
    return 0 if v is None else v


small_int = st.one_of(st.none(), st.integers(min_value=0, max_value=20))
passed_row = st.tuples(st.sampled_from(["m1", "m2", "m3", "m4", "m5", "m6"]), st.booleans(),
                       small_int, st.one_of(st.none(), st.integers(0, 2)), small_int)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(passed_row, min_size=0, max_size=12, unique_by=lambda r: r[0]))
def test_lists_match_model(spark, rows):
    import datetime as dt
    from riskgraph.operators import segments
    t0 = dt.datetime(2001, 1, 1)
    df = spark.createDataFrame(
        [(m, t0 if loan else None, od, il, pp) for m, loan, od, il, pp in rows],
        "mobile string, first_apply_loan_succ_time timestamp_ntz, max_overdue_day_cnt int, "
        "curr_inloan_cnt int, max_prepayment_day_cnt int")
    got = lambda d: {r[0] for r in d.collect()}
    loaned = [r for r in rows if r[1]]
    assert got(segments.passed_no_borrow(df)) == {r[0] for r in rows if not r[1]}
    assert got(segments.whitelist(df)) == {m for m, _, od, il, _ in loaned if _nz(od) <= 7 and _nz(il) == 0}
    assert got(segments.whitelist(df, max_prepay=3)) == \
        {m for m, _, od, il, pp in loaned if _nz(od) <= 7 and _nz(il) == 0 and _nz(pp) <= 3}
    assert got(segments.whitelist(df, require_no_inloan=False)) == {m for m, _, od, _, _ in loaned if _nz(od) <= 7}
    assert got(segments.greylist(df)) == {m for m, _, od, _, _ in loaned if 7 < _nz(od) <= 14}
    assert got(segments.blacklist(df)) == {m for m, _, od, _, _ in loaned if _nz(od) > 14}
    assert got(segments.blacklist(df, min_overdue=7)) == {m for m, _, od, _, _ in loaned if _nz(od) >= 7}
    labels = {(r["list"], r["mobile"]) for r in segments.list_labels(df).collect()}
    assert {m for lst, m in labels if lst == segments.WHITE} == got(segments.whitelist(df))
    assert {m for lst, m in labels if lst == segments.BLACK} == got(segments.blacklist(df))
