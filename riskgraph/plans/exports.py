"""File exports for the graph loader and the ranking step.

An export is a set of parts, folder name to lines (``*_parts``).  The writers
below put each part in its folder; ``as_rows`` returns the same lines as
(folder, line) rows.  Writers cut the lineage of what several parts share into
the reliable checkpoint folder (``spark.checkpoint.dir``), so a lost executor
never forces the history scan to be redone for the second output.  Days are
parameters; nothing reads the clock, and nothing is kept after a run.

An export is all or nothing (``write_parts``): every part is staged before the
first is put in place, and a mark under ``<base>/_exports`` says whether an
export has begun and whether it is whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.functions.exprs import day_text, days
from riskgraph.operators import cohorts, edges, neighbours, repayment, segments
from riskgraph.operators import history_totals as H
from riskgraph.session import cut_lineage
from riskgraph.sinks.lines import (
    dated_path, format_adjacency_line, format_edge_line, format_mobile_line, format_overdue_line, format_pair_line,
    format_score_line, write_lines,
)
from riskgraph.sources.tables import OVERDUE_LINE, RANK_SCORE, history, read_delimited, snapshot

APPLY_NOT_PASS = segments.APPLY_NOT_PASS
USER_LISTS = (segments.NO_BORROW, segments.GREY, segments.WHITE, segments.BLACK)
GRAPH_LISTS = (APPLY_NOT_PASS, *USER_LISTS)

Parts = dict[str, DataFrame]


def _same(df: DataFrame) -> DataFrame:
    return df


def as_rows(parts: Parts) -> DataFrame:
    """The lines of all parts as rows (folder, line), as a writer would write them."""
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("folder"), "line").filter(F.col("line").isNotNull()) for name, df in parts.items()])


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def mark_path(base: str, name: str, day=None) -> str:
    """Where the marks of export ``name`` (of a day) stand."""
    return "/".join([base.rstrip("/"), "_exports", *([] if day is None else [day_text(day)]), name])


def is_whole(spark: SparkSession, mark: str) -> bool:
    """Whether the export of ``mark`` has been written whole."""
    return _exists(spark, f"{mark}/done")


def write_parts(parts: Parts, folder, mark: str, single_file: bool = False, lists=()) -> None:
    """Write each part to ``folder(name)``; with ``single_file`` the parts
    named in ``lists`` become one file each.

    All parts are computed and staged in the checkpoint folder first, so a
    failure there leaves no output.  Then ``<mark>/begun`` is written, the
    staged lines are put in place, and ``<mark>/done`` (parts and their number
    of lines) is written last.  A whole export is refused, and so are folders
    that no begun export explains; an export that began and did not finish is
    written anew by the next run, part by part.
    """
    spark = next(iter(parts.values())).sparkSession
    if is_whole(spark, mark):
        raise FileExistsError(f"this export has been written already: {mark}/done")
    begun = _exists(spark, f"{mark}/begun")
    if not begun:
        for name in parts:
            if _exists(spark, folder(name)):
                raise FileExistsError(f"{folder(name)} exists and is not part of an unfinished export")
    staged = {name: cut_lineage(df.select("line").filter(F.col("line").isNotNull())) for name, df in parts.items()}
    counts = [(f"{name}\t{df.count()}",) for name, df in staged.items()]
    if not begun:
        spark.createDataFrame([(name,) for name in parts], "value string").coalesce(1).write.text(f"{mark}/begun")
    for name, df in staged.items():
        write_lines(df, folder(name), single_file=single_file and name in lists, mode="overwrite" if begun else "errorifexists")
    spark.createDataFrame(counts, "value string").coalesce(1).write.text(f"{mark}/done")


def list_parts(labelled: DataFrame, names) -> Parts:
    """A (list, mobile) table as one part per list name."""
    return {name: format_mobile_line(labelled.filter(F.col("list") == name)) for name in names}


def _graph(calls, members, before, totals_root):
    """``calls`` of None: the totals have just been brought up to date."""
    if totals_root:
        return H.call_edges_from_totals(H.read_totals(members.sparkSession, calls, totals_root, before), members)
    return edges.call_edges(history(calls, before), members)


def _pairs(calls, members, before, totals_root):
    if totals_root:
        return H.rank_edges_from_totals(H.read_totals(members.sparkSession, calls, totals_root, before), members)
    return edges.rank_edges(history(calls, before), members)


def graph_parts(profile: DataFrame, contact: DataFrame, calls: DataFrame, as_of, history_before=None,
                totals_root: str | None = None, cut=_same) -> Parts:
    """Applied-not-passed, no-loan, grey, white and black lists and the
    call graph between applicants.  The call history is read with
    ``dt < history_before`` (default today), or, with ``totals_root``, the
    daily call totals before that day are read instead
    (``operators.history_totals``)."""
    today, yesterday = days(as_of)
    rows = cut(cohorts.day_users(profile, contact, yesterday))
    graph = _graph(calls, cohorts.applied_from(rows), history_before or today, totals_root)
    return {**list_parts(cut(segments.graph_lists_from(rows)), GRAPH_LISTS), "relationship": format_edge_line(graph)}


def ranking_parts(profile: DataFrame, contact: DataFrame, calls: DataFrame, blacklisted: DataFrame, repay: DataFrame,
                  collection: DataFrame, as_of, label: str, channels, history_before=None,
                  totals_root: str | None = None, cut=_same) -> Parts:
    """White list, merged black list, ranking pairs and the one-degree
    contact list; ``totals_root`` as in ``graph_parts``."""
    today, yesterday = days(as_of)
    rows = cut(cohorts.day_users(profile, contact, yesterday))
    passed = cut(cohorts.passed_summary_from(rows))
    black = segments.merged_blacklist(passed, blacklisted, repay, collection, contact, yesterday, label, channels)
    pairs = cut(_pairs(calls, cohorts.applied_from(rows), history_before or today, totals_root))
    return {"whitelist": format_mobile_line(segments.whitelist(passed)), "blacklist": format_mobile_line(black),
            "relationship": format_pair_line(pairs),
            "onedegree": format_adjacency_line(neighbours.one_degree(pairs, distinct_pairs=True))}


def snapshot_parts(profile: DataFrame, contact: DataFrame, calls: DataFrame, day, history_before,
                   totals_root: str | None = None, cut=_same) -> Parts:
    """Strict white list, wide black list and ranking pairs for a fixed past ``day``."""
    rows = cut(cohorts.day_users(profile, contact, day))
    passed = cut(cohorts.passed_summary_from(rows))
    pairs = _pairs(calls, cohorts.applied_from(rows), history_before, totals_root)
    return {"whitelist": format_mobile_line(segments.whitelist(passed, max_prepay=3)),
            "blacklist": format_mobile_line(segments.blacklist(passed, min_overdue=7)),
            "relationship": format_pair_line(pairs)}


def call_graph_parts(graph: DataFrame, cut=_same) -> Parts:
    """Edge lines and the node list of a call graph."""
    graph = cut(graph)
    return {"relationship": format_edge_line(graph), "person": format_mobile_line(edges.persons(graph))}


def export_lists(labelled: DataFrame, base: str, day, names, single_file: bool = False) -> None:
    """Write a (list, mobile) table as one folder per list name under
    ``<base>/<day>/<name>``, e.g. the per-user lists of C14."""
    kept = cut_lineage(labelled.select("list", "mobile"))
    write_parts(list_parts(kept, names), lambda n: dated_path(base, day, n), mark_path(base, "lists", day), single_file, names)


def export_graph(profile: DataFrame, contact: DataFrame, calls: DataFrame, base: str, as_of, history_before=None,
                 single_file: bool = False, totals_root: str | None = None) -> None:
    """C27 under ``<base>/<yesterday>``.  ``single_file=True`` writes each list
    as one file (the lists are computed in parallel, only the finished lines
    meet in one task); keep it for lists known to be small."""
    _, yesterday = days(as_of)
    write_parts(graph_parts(profile, contact, calls, as_of, history_before, totals_root, cut_lineage),
                lambda n: dated_path(base, yesterday, n), mark_path(base, "graph", yesterday), single_file, GRAPH_LISTS)


def export_ranking(profile: DataFrame, contact: DataFrame, calls: DataFrame, blacklisted: DataFrame,
                   repay: DataFrame, collection: DataFrame, base: str, as_of, label: str,
                   channels, history_before=None, totals_root: str | None = None) -> None:
    """C28 under ``<base>/<yesterday>``."""
    _, yesterday = days(as_of)
    write_parts(ranking_parts(profile, contact, calls, blacklisted, repay, collection, as_of, label, channels,
                              history_before, totals_root, cut_lineage), lambda n: dated_path(base, yesterday, n),
                mark_path(base, "ranking", yesterday))


def export_ranking_snapshot(profile: DataFrame, contact: DataFrame, calls: DataFrame, base: str, day,
                            history_before, totals_root: str | None = None) -> None:
    """C29 under ``<base>/<name>``."""
    write_parts(snapshot_parts(profile, contact, calls, day, history_before, totals_root, cut_lineage),
                lambda n: f"{base}/{n}", mark_path(base, "snapshot"))


def export_call_graph(graph: DataFrame, base: str, day) -> None:
    """C30 under ``<base>/<day>``."""
    write_parts(call_graph_parts(graph, cut_lineage), lambda n: dated_path(base, day, n), mark_path(base, "call-graph", day))


def export_owner_graph(profile: DataFrame, contact: DataFrame, calls: DataFrame, base: str, day, before) -> None:
    """C17 with its lists under ``<base>/<day>``: the no-loan, grey, white (the
    in-loan count is not looked at, C7) and black lists of the passed users'
    mobiles, and the graph of the calls that they own."""
    summary = cut_lineage(cohorts.passed_summary(profile, contact, day))
    graph = edges.call_edges(history(calls, before), summary.select("mobile"), ends="owner")
    lists = list_parts(cut_lineage(segments.list_labels(summary, require_no_inloan=False)), USER_LISTS)
    write_parts({**lists, "relationship": format_edge_line(graph)}, lambda n: dated_path(base, day, n),
                mark_path(base, "owner-graph", day))


def daily_call_graph(apply: DataFrame, contact: DataFrame, calls: DataFrame, day,
                     after=None, min_n: int = 2, others: DataFrame | None = None) -> DataFrame:
    """C19 + C20: the call graph of one day's calls between that day's new
    applicants.  With ``others`` the record owner is a new applicant and the
    other end one of ``others`` (the second reading of the increment job)."""
    new = cohorts.incremental_applicants(apply, contact, day, after)
    return edges.call_edges(snapshot(calls, day), new, dst_members=others, min_n=min_n)


def export_overdue_info(repay: DataFrame, profile: DataFrame, out: str, as_of, since, decode=None) -> None:
    """C25 + K7: loan overdue lines ``loan_id,ds,mobile,early_day,overdue_day``
    of loans created since ``since``, for the snapshot of the day before ``as_of``."""
    _, yesterday = days(as_of)
    facts = repayment.overdue_info(repay, profile, yesterday, since, decode=decode)
    write_lines(format_overdue_line(facts), out)


def export_score_vs_overdue(spark, overdue_path: str, scores_path: str, out: str) -> None:
    """C26 + S4 + O1 + K8: read loan lines and ``mobile,score`` lines, join on
    mobile and write ``score,overdue`` lines, best score first (the part
    files are range-partitioned in that order)."""
    facts = read_delimited(spark, overdue_path, OVERDUE_LINE)
    scores = read_delimited(spark, scores_path, RANK_SCORE)
    write_lines(format_score_line(repayment.order_by_score(repayment.scored_facts_split(facts, scores))), out)


def export_day(profile: DataFrame, contact: DataFrame, calls: DataFrame, blacklisted: DataFrame,
               repay: DataFrame, collection: DataFrame, graph_base: str, ranking_base: str, as_of,
               label: str, channels, totals_root: str, single_file: bool = False, open_from=None) -> None:
    """One daily run of the graph (C27) and ranking (C28) exports.  The daily
    call totals are brought up to today first (yesterday's calls and any day
    that changed), and both graphs are computed from them.  Writes the same
    files as the two exports with the history read before today."""
    today, _ = days(as_of)
    H.refresh_totals(profile.sparkSession, calls, totals_root, today)
    export_graph(profile, contact, calls, graph_base, as_of, single_file=single_file, totals_root=totals_root)
    export_ranking(profile, contact, calls, blacklisted, repay, collection, ranking_base, as_of, label, channels,
                   totals_root=totals_root)
