"""Loan facts, scores against overdue days, orders and the line formats."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from riskgraph.operators import repayment
from riskgraph.sinks import lines
from riskgraph.sources.tables import OVERDUE_LINE, RANK_SCORE, read_delimited
from tests.conftest import rows

# Invented lines, one case each: a loan repeated five times that differs only in
# a field that is not read, two mobiles of equal score, a negative score, a
# mobile without a score, and a mobile with two scores.
LOAN_LINES = (
    [f"501,north,10000000001,3,0,2001-02-0{d} 08:00:00,ignored" for d in range(1, 6)]
    + ["502,north,10000000002,0,12,x,y", "503,south,10000000003,1,6,x,y", "504,south,10000000004,7,0,x,y",
       "505,south,10000000005,9,9,x,y", "506,east,10000000006,0,2,x,y"])
SCORE_LINES = ["10000000001,4.5", "10000000002,7.25", "10000000003,7.25", "10000000004,-3.0",
               "10000000006,0.5", "10000000006,20.0"]
GOLDEN = ["20.0,2", "7.25,6", "7.25,12", "4.5,0", "0.5,2", "-3.0,0"]


def _write(path, lines_):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines_) + "\n")


def test_score_vs_overdue_golden(spark, outdir):
    _write(f"{outdir}/loans/part-0", LOAN_LINES)
    _write(f"{outdir}/scores/part-0", SCORE_LINES)
    facts = read_delimited(spark, f"{outdir}/loans", OVERDUE_LINE)
    scores = read_delimited(spark, f"{outdir}/scores", RANK_SCORE)
    ranked = repayment.order_by_score(repayment.scored_facts(facts, scores))
    got = [r[0] for r in lines.format_score_line(ranked).collect()]
    assert got == GOLDEN
    lines.write_lines(lines.format_score_line(ranked), f"{outdir}/out")
    written = spark.read.text(f"{outdir}/out").collect()
    assert sorted(r[0] for r in written) == sorted(GOLDEN)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("line", ["1,north,1000,x,0", "1,north,1000,4"])
def test_read_delimited_fails_on_bad_text(spark, outdir, ansi, line):
    _write(f"{outdir}/bad/part-0", [line])
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="cannot be read"):
            read_delimited(spark, f"{outdir}/bad", OVERDUE_LINE).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_order_by_text_key_golden(spark):
    keys = ["40", "4", "100", "9", "31", "3", "10", "22"]
    df = spark.createDataFrame([(k, "v") for k in keys], "k string, v string").repartition(4)
    assert [r[0] for r in repayment.order_by_text_key(df, "k").collect()] == \
        ["10", "100", "22", "3", "31", "4", "40", "9"]


def test_overdue_info_rules(spark):
    D = "2001-08-31"
    T = lambda s: dt.datetime.fromisoformat(s)
    repay = spark.createDataFrame([
        (1, 10, "a", 3, 0, "002005001", T("2001-01-05 10:00:00"), T("2001-08-31 23:00:00"), D),  # due by as-of
        (1, 10, "a", 0, 9, "002005001", T("2001-01-05 10:00:00"), T("2001-08-20 00:00:00"), D),
        (2, 10, "a", 1, 0, "002005002", T("2001-02-01 00:00:00"), T("2001-12-01 00:00:00"), D),  # settled
        (3, 10, "a", 1, 0, "002005001", T("2001-02-01 00:00:00"), T("2001-12-01 00:00:00"), D),  # not due
        (4, 10, "a", 1, 0, "002005002", T("2000-12-31 23:59:59"), T("2001-01-01 00:00:00"), D),  # too old
        (5, 11, "a", 1, 1, "002005002", T("2001-02-01 00:00:00"), T("2001-02-01 00:00:00"), D),  # no profile
    ], "loan_id bigint, user_id bigint, ds string, early_day int, overdue_day int, repay_status string, "
       "create_time timestamp_ntz, due_day timestamp_ntz, dt string")
    profile = spark.createDataFrame([(10, "a", D, "4321")], "user_id bigint, ds string, dt string, mobile_encode string")
    got = rows(repayment.overdue_info(repay, profile, D, "2001-01-01", decode=F.reverse))
    assert got == [(1, "a", "1234", 3, 9), (2, "a", "1234", 1, 0)]


def test_line_formats(spark):
    e = spark.createDataFrame([("a", "b", 3, 0.125)], "src string, dst string, calls bigint, mean_duration double")
    assert lines.format_edge_line(e).first()[0] == "a,b,CALL_OUT,3,0.13"
    assert lines.format_pair_line(e).first()[0] == "a,b"
    adj = spark.createDataFrame([("a", ["b", "c"])], "mobile string, neighbours array<string>")
    assert lines.format_adjacency_line(adj).first()[0] == "a\tb\tc"
    od = spark.createDataFrame([(None, "weibo", None, None, 4)],
                               "loan_id bigint, ds string, mobile string, early_day int, overdue_day int")
    assert lines.format_overdue_line(od).first()[0] == "0,weibo,null,0,4"
    sc = spark.createDataFrame([(1.0e10, 3), (2.5, None)], "score double, overdue_day int")
    assert sorted(r[0] for r in lines.format_score_line(sc).collect()) == ["1.0E10,3", "2.5,0"]
    assert lines.dated_path("/x/", "2001-08-31", "whitelist") == "/x/2001-08-31/whitelist"


def test_literal_table_and_registered_view(spark):
    from riskgraph.sources.tables import literal_table, register
    df = literal_table(spark, [("13800000001", 1.5)], RANK_SCORE)
    register(df, "rg_scores_literal")
    assert spark.sql("SELECT mobile, score FROM rg_scores_literal").collect()[0]["score"] == 1.5
