"""File exports: layout, one-file lists, refusal of existing paths, round trips."""
import os

import pytest
from pyspark.sql import functions as F

from riskgraph.functions.exprs import FRAUD_LABEL
from riskgraph.plans import exports
from riskgraph.sources import bindings as B
from riskgraph.sources.tables import snapshot
from tests.conftest import SF0001

PAIRS = 1101  # ranking pairs at sf0.001


def _lines(spark, path):
    return sorted(r[0] for r in spark.read.text(path).collect())


def _catalog_tables(spark, mark):
    """The bound tables as catalog views, by role."""
    b = B.Bindings(spark, SF0001)
    tables = {}
    for role in ("user_profile", "user_contact", "call_detail", "repay_plan", "credit_apply", "third_party_blacklist",
                 "collection_record"):
        getattr(b, role).createOrReplaceTempView(f"rg_{mark}_{role}")
        tables[role] = f"rg_{mark}_{role}"
    return tables


def _files(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_export_graph(spark, outdir):
    b = B.Bindings(spark, SF0001)
    exports.export_graph(b.user_profile, b.user_contact, b.call_detail, outdir, B.AS_OF,
                         history_before=B.HISTORY_BEFORE, single_file=True)
    day = f"{outdir}/{B.DAY}"
    assert sorted(os.listdir(day)) == sorted(list(exports.GRAPH_LISTS) + ["relationship"])
    assert len(_lines(spark, f"{day}/whitelist")) == 8
    assert len(_lines(spark, f"{day}/blacklist")) == 21
    assert len(_lines(spark, f"{day}/borrowNotwb")) == 14
    assert len(_lines(spark, f"{day}/applycreditNoBorrow")) == 42
    assert len(_lines(spark, f"{day}/applyNotPass")) == 13
    for name in exports.GRAPH_LISTS:
        assert len(_files(f"{day}/{name}")) == 1
    rel = _lines(spark, f"{day}/relationship")
    assert len(rel) == 670
    src, dst, label, n, mean = rel[0].split(",")
    assert label == "CALL_OUT" and int(n) > 1 and len(mean.split(".")[1]) == 2
    with pytest.raises(Exception):
        exports.export_graph(b.user_profile, b.user_contact, b.call_detail, outdir, B.AS_OF)


def test_export_ranking(spark, outdir):
    b = B.Bindings(spark, SF0001)
    exports.export_ranking(b.user_profile, b.user_contact, b.call_detail, b.third_party_blacklist,
                           b.repay_plan, b.collection_record, outdir, B.AS_OF, B.FRAUD, B.FRAUD_SEGMENTS)
    day = f"{outdir}/{B.DAY}"
    assert len(_lines(spark, f"{day}/whitelist")) == 8
    assert len(_lines(spark, f"{day}/blacklist")) == 33
    rel = _lines(spark, f"{day}/relationship")
    assert len(rel) == PAIRS and all(len(x.split(",")) == 2 for x in rel)
    one = _lines(spark, f"{day}/onedegree")
    assert len(one) == 107
    # the one-degree lines hold exactly the relationship pairs
    pairs = {tuple(x.split(",")) for x in rel}
    from_lines = {(p[0], n) for p in (x.split("\t") for x in one) for n in p[1:]}
    assert pairs == from_lines


def test_export_ranking_snapshot_and_call_graph(spark, outdir):
    b = B.Bindings(spark, SF0001)
    exports.export_ranking_snapshot(b.user_profile, b.user_contact, b.call_detail, f"{outdir}/snap", B.DAY,
                                    history_before=B.HISTORY_TO_TODAY)
    assert len(_lines(spark, f"{outdir}/snap/whitelist")) == 4
    assert len(_lines(spark, f"{outdir}/snap/blacklist")) == 39
    assert len(_lines(spark, f"{outdir}/snap/relationship")) == PAIRS
    # the year's calls relabelled as the increment day
    calls = snapshot(b.call_detail_year, B.YEAR_DAY).withColumn("dt", F.lit(B.INCREMENT_DAY))
    graph = exports.daily_call_graph(b.credit_apply, b.user_contact, calls, B.INCREMENT_DAY,
                                     B.INCREMENT_AFTER, min_n=1)
    exports.export_call_graph(graph, f"{outdir}/inc", B.INCREMENT_DAY)
    rel = _lines(spark, f"{outdir}/inc/{B.INCREMENT_DAY}/relationship")
    persons = _lines(spark, f"{outdir}/inc/{B.INCREMENT_DAY}/person")
    assert len(rel) == 21
    assert set(persons) == {e for x in rel for e in x.split(",")[:2]}


def test_default_fraud_values():
    assert FRAUD_LABEL and len(exports.GRAPH_LISTS) == 5


def test_jobs_entry_point_with_catalog_tables(spark, outdir):
    from riskgraph.plans import jobs
    b = B.Bindings(spark, SF0001)
    roles = {"user_profile": b.user_profile, "user_contact": b.user_contact, "call_detail": b.call_detail,
             "repay_plan": b.repay_plan, "credit_apply": b.credit_apply}
    tables = {}
    for role, df in roles.items():
        df.createOrReplaceTempView(f"rg_job_{role}")
        tables[role] = f"rg_job_{role}"
    jobs.run(spark, "call-graph", outdir, B.AS_OF, tables)
    assert len(_lines(spark, f"{outdir}/{B.AS_OF}/relationship")) == 670
    assert len(_lines(spark, f"{outdir}/{B.AS_OF}/person")) == 107
    jobs.run(spark, "overdue", outdir, B.AS_OF, tables, since=B.LOANS_SINCE, decode="reverse")
    loans = _lines(spark, f"{outdir}/overdue")
    assert len(loans) == 538
    with open(f"{outdir}/scores.txt", "w") as f:
        f.write("\n".join(f"{r['mobile']},{r['score']}" for r in b.rank_score.collect()) + "\n")
    jobs.run(spark, "scores", outdir, B.AS_OF, {}, overdue_path=f"{outdir}/overdue",
             scores_path=f"{outdir}/scores.txt", out=f"{outdir}/ranked")
    parts = sorted(f for f in os.listdir(f"{outdir}/ranked") if f.startswith("part-"))
    ranked = [ln for p in parts for ln in open(f"{outdir}/ranked/{p}").read().splitlines()]
    assert len(ranked) == 601
    scores = [float(x.split(",")[0]) for x in ranked]
    assert scores == sorted(scores, reverse=True)


def test_export_per_user_lists(spark, outdir):
    from riskgraph.operators import segments
    b = B.Bindings(spark, SF0001)
    names = (segments.NO_BORROW, segments.GREY, segments.WHITE, segments.BLACK)
    exports.export_lists(segments.segments_per_user(b.user_profile, b.user_contact, B.DAY), outdir, B.DAY, names)
    got = [len(_lines(spark, f"{outdir}/{B.DAY}/{n}")) for n in names]
    assert got == [43, 15, 21, 20]
    assert all(x.startswith("p1") for x in _lines(spark, f"{outdir}/{B.DAY}/{segments.WHITE}"))


def test_jobs_entry_point_all_exports(spark, outdir):
    from riskgraph.plans import jobs
    b = B.Bindings(spark, SF0001)
    roles = {"user_profile": b.user_profile, "user_contact": b.user_contact, "call_detail": b.call_detail,
             "repay_plan": b.repay_plan, "credit_apply": b.credit_apply,
             "third_party_blacklist": b.third_party_blacklist, "collection_record": b.collection_record}
    tables = {}
    for role, df in roles.items():
        df.createOrReplaceTempView(f"rg_all_{role}")
        tables[role] = f"rg_all_{role}"
    jobs.run(spark, "graph", f"{outdir}/g", B.AS_OF, tables, before=B.HISTORY_BEFORE)
    assert len(_lines(spark, f"{outdir}/g/{B.DAY}/relationship")) == 670
    assert len(_lines(spark, f"{outdir}/g/{B.DAY}/whitelist")) == 8
    jobs.run(spark, "ranking", f"{outdir}/r", B.AS_OF, tables,
             label=B.FRAUD, channels=B.FRAUD_SEGMENTS)
    assert len(_lines(spark, f"{outdir}/r/{B.DAY}/blacklist")) == 33
    assert len(_lines(spark, f"{outdir}/r/{B.DAY}/onedegree")) == 107
    jobs.run(spark, "ranking-snapshot", f"{outdir}/s", B.AS_OF, tables)
    assert len(_lines(spark, f"{outdir}/s/relationship")) == PAIRS
    jobs.run(spark, "increment", f"{outdir}/i", "2001-09-01", tables, after=B.INCREMENT_AFTER)
    # the bound call table has no calls dated on the increment day
    assert not _lines(spark, f"{outdir}/i/{B.DAY}/relationship")
    jobs.main(["call-graph", "--base", f"{outdir}/m", "--as-of", B.AS_OF,
               "--table", "user_profile=rg_all_user_profile", "--table", "user_contact=rg_all_user_contact",
               "--table", "call_detail=rg_all_call_detail"])
    assert len(_lines(spark, f"{outdir}/m/{B.AS_OF}/relationship")) == 670


def test_totals_job_feeds_graph_export(spark, outdir):
    from riskgraph.plans import jobs
    tables = _catalog_tables(spark, "totals")
    root = f"{outdir}/totals"
    jobs.run(spark, "totals", outdir, B.AS_OF, tables, totals=root)
    jobs.run(spark, "graph", f"{outdir}/g", B.AS_OF, tables, totals=root)
    from_totals = _lines(spark, f"{outdir}/g/{B.DAY}/relationship")
    jobs.run(spark, "graph", f"{outdir}/raw", B.AS_OF, tables)
    assert from_totals == _lines(spark, f"{outdir}/raw/{B.DAY}/relationship") and from_totals
    jobs.run(spark, "ranking", f"{outdir}/r", B.AS_OF, tables, totals=root,
             label=B.FRAUD, channels=B.FRAUD_SEGMENTS)
    assert len(_lines(spark, f"{outdir}/r/{B.DAY}/relationship")) == PAIRS


JOB_QUERIES = {"call-graph": ("c15_call_edges", B.AS_OF), "call-graph-loose": ("c16_call_edges_loose", B.AS_OF),
               "call-graph-owner": ("c17_call_edges_owner", B.DAY), "call-graph-passed": ("c18_call_edges_passed", B.DAY)}


@pytest.mark.parametrize("job", sorted(JOB_QUERIES))
def test_graph_jobs_equal_their_queries(spark, outdir, job):
    from riskgraph.plans import jobs
    from riskgraph.plans.catalog import bound
    from riskgraph.sinks.lines import format_edge_line
    name, day = JOB_QUERIES[job]
    jobs.run(spark, job, outdir, B.AS_OF, _catalog_tables(spark, "graphs"))
    want = sorted(r[0] for r in format_edge_line(bound()[name](B.Bindings(spark, SF0001))).collect())
    assert _lines(spark, f"{outdir}/{day}/relationship") == want and want


def test_graph_jobs_write_persons_and_lists(spark, outdir):
    from riskgraph.plans import jobs
    from riskgraph.plans.catalog import bound
    b, queries = B.Bindings(spark, SF0001), bound()
    tables = _catalog_tables(spark, "graphs2")
    jobs.run(spark, "call-graph-passed", f"{outdir}/p", B.AS_OF, tables)
    ends = {m for r in queries["c18_call_edges_passed"](b).collect() for m in (r["src"], r["dst"])}
    assert _lines(spark, f"{outdir}/p/{B.DAY}/person") == sorted(ends) and ends
    jobs.run(spark, "call-graph-owner", f"{outdir}/o", B.AS_OF, tables)
    want = {exports.segments.NO_BORROW: "c04_passed_no_borrow", exports.segments.GREY: "c08_greylist",
            exports.segments.WHITE: "c07_whitelist_early", exports.segments.BLACK: "c09_blacklist"}
    for folder, name in want.items():
        assert _lines(spark, f"{outdir}/o/{B.DAY}/{folder}") == sorted(r["mobile"] for r in queries[name](b).collect())


def test_export_that_fails_midway_is_finished_by_the_next_run(spark, outdir, monkeypatch):
    def parts(bad=False):
        out = {n: spark.createDataFrame([(f"{n}{k}",) for k in range(5)], "line string") for n in ("a", "b", "c")}
        if bad:
            out["c"] = out["c"].select(F.raise_error(F.lit("no part c")).cast("string").alias("line"))
        return out

    def folder(name):
        return f"{outdir}/day/{name}"
    mark = exports.mark_path(outdir, "test", "2001-01-01")
    with pytest.raises(Exception, match="no part c"):     # a part that cannot be computed: nothing is written
        exports.write_parts(parts(bad=True), folder, mark)
    assert not os.path.exists(f"{outdir}/day") and not exports.is_whole(spark, mark)

    real, written = exports.write_lines, []

    def dying(df, path, **how):
        if len(written) == 2:
            raise RuntimeError("lost")
        written.append(path)
        real(df, path, **how)
    monkeypatch.setattr(exports, "write_lines", dying)
    with pytest.raises(RuntimeError, match="lost"):       # the third part is not put in place
        exports.write_parts(parts(), folder, mark)
    assert sorted(os.listdir(f"{outdir}/day")) == ["a", "b"] and not exports.is_whole(spark, mark)
    monkeypatch.undo()
    exports.write_parts(parts(), folder, mark)
    assert exports.is_whole(spark, mark)
    for n in ("a", "b", "c"):
        assert _lines(spark, folder(n)) == [f"{n}{k}" for k in range(5)]
    assert _lines(spark, f"{mark}/done") == ["a\t5", "b\t5", "c\t5"]
    with pytest.raises(FileExistsError, match="already"):  # a whole export stays
        exports.write_parts(parts(), folder, mark)
    with pytest.raises(FileExistsError, match="unfinished"):  # and so do folders that are not ours
        exports.write_parts(parts(), folder, exports.mark_path(outdir, "other"))


def test_one_file_is_measured_first(spark, outdir):
    from riskgraph.sinks import lines
    df = spark.range(1000).selectExpr("cast(id + 1000 as string) as line").repartition(4)   # 5 bytes a line
    spark.conf.set(lines.ONE_FILE_CONF, "4999")
    try:
        with pytest.raises(ValueError, match="5000 bytes.*many files"):
            lines.write_lines(df, f"{outdir}/big", single_file=True)
        assert not os.path.exists(f"{outdir}/big")
        lines.write_lines(df, f"{outdir}/many")
        spark.conf.set(lines.ONE_FILE_CONF, "5000")
        lines.write_lines(df, f"{outdir}/one", single_file=True)
    finally:
        spark.conf.unset(lines.ONE_FILE_CONF)
    assert len(_files(f"{outdir}/one")) == 1 and _lines(spark, f"{outdir}/one") == _lines(spark, f"{outdir}/many")


def test_increment_and_list_jobs_equal_their_queries(spark, outdir):
    from riskgraph.plans import jobs
    from riskgraph.plans.catalog import bound
    from riskgraph.sinks.lines import format_edge_line
    b = B.Bindings(spark, SF0001)
    tables = _catalog_tables(spark, "inc")
    calls = snapshot(b.call_detail_year, B.YEAR_DAY).withColumn("dt", F.lit(B.INCREMENT_DAY))
    calls.createOrReplaceTempView("rg_inc_call_detail")
    for job, name in (("increment", "c20_incremental_edges"), ("increment-loose", "c20_incremental_edges_loose")):
        jobs.run(spark, job, f"{outdir}/{job}", B.AS_OF, tables, after=B.INCREMENT_AFTER)
        want = sorted(r[0] for r in format_edge_line(bound()[name](b)).collect())
        assert _lines(spark, f"{outdir}/{job}/{B.DAY}/relationship") == want
    jobs.run(spark, "increment-mixed", f"{outdir}/mixed", B.AS_OF, tables, after=B.INCREMENT_AFTER)
    mixed = bound()["c20_incremental_edges_mixed"](b).filter("calls > 1")
    assert _lines(spark, f"{outdir}/mixed/{B.DAY}/relationship") == sorted(r[0] for r in format_edge_line(mixed).collect())
    jobs.run(spark, "lists", f"{outdir}/lists", B.AS_OF, tables)
    got = {(n, x) for n in exports.USER_LISTS for x in _lines(spark, f"{outdir}/lists/{B.DAY}/{n}")}
    assert got == {(r["list"], r["mobile"]) for r in bound()["c14_segments_per_user"](b).collect()}
    with pytest.raises(ValueError, match="since"):
        jobs.run(spark, "overdue", outdir, B.AS_OF, tables)


def test_export_day_equals_separate_exports(spark, outdir):
    b = B.Bindings(spark, SF0001)
    args = (b.user_profile, b.user_contact, b.call_detail)
    exports.export_day(*args, b.third_party_blacklist, b.repay_plan, b.collection_record,
                       f"{outdir}/dg", f"{outdir}/dr", B.AS_OF, B.FRAUD, B.FRAUD_SEGMENTS,
                       totals_root=f"{outdir}/totals")
    exports.export_graph(*args, f"{outdir}/g", B.AS_OF)
    exports.export_ranking(*args, b.third_party_blacklist, b.repay_plan, b.collection_record,
                           f"{outdir}/r", B.AS_OF, B.FRAUD, B.FRAUD_SEGMENTS)
    for name in list(exports.GRAPH_LISTS) + ["relationship"]:
        assert _lines(spark, f"{outdir}/dg/{B.DAY}/{name}") == _lines(spark, f"{outdir}/g/{B.DAY}/{name}"), name
    for name in ("whitelist", "blacklist", "relationship", "onedegree"):
        assert _lines(spark, f"{outdir}/dr/{B.DAY}/{name}") == _lines(spark, f"{outdir}/r/{B.DAY}/{name}"), name


def test_day_job(spark, outdir):
    from riskgraph.plans import jobs
    b = B.Bindings(spark, SF0001)
    roles = {"user_profile": b.user_profile, "user_contact": b.user_contact, "call_detail": b.call_detail,
             "repay_plan": b.repay_plan, "third_party_blacklist": b.third_party_blacklist,
             "collection_record": b.collection_record}
    tables = {}
    for role, df in roles.items():
        df.createOrReplaceTempView(f"rg_day_{role}")
        tables[role] = f"rg_day_{role}"
    jobs.run(spark, "day", outdir, B.AS_OF, tables, label=B.FRAUD, channels=B.FRAUD_SEGMENTS)
    assert len(_lines(spark, f"{outdir}/ranking/{B.DAY}/blacklist")) == 33
    assert len(_lines(spark, f"{outdir}/graph/{B.DAY}/whitelist")) == 8
