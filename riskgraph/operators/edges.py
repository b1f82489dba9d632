"""Call graph: check channels, keep valid numbers and members, orient, aggregate.

Plan shape of ``call_edges`` on the call history::

    scan(mobile, other_mobile, call_channel, call_time; dt < before)   pruned, pushed
      -> semi-join owner / other end with the cohort                    broadcast when measured small
      -> channel check, number pattern, orientation                     codegen
      -> partial aggregate (src, dst): count, sum                       map-side combine
      -> exchange hashpartitioning(src, dst)                            the only big shuffle
      -> final aggregate, filter calls >= n

A hub number spreads over partitions because the shuffle key is the pair,
and one hot pair costs one partial row per map task.

When the cohort is measured too large to broadcast, the plan becomes::

    scan -> Bloom filter sized by the cohort drops non-members          broadcast, no shuffle
      -> partial aggregate per (mobile, other_mobile, channel)
      -> exchange on the record key -> final aggregate                 (none on calls bucketed by mobile)
      -> shuffle semi-join on mobile, then on other_mobile             (on records, not calls)
      -> channel check, pattern, orientation -> aggregate on (src, dst)

``edges_from_records`` runs the same rules on daily totals
(``operators.history_totals``) instead of raw calls.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.functions.exprs import (
    MOBILE, digits_or_zero, full_match, known_channel, oriented, prefixed, two_decimals,
)
from riskgraph.operators.membership import Cohort, measured, restricted

RECORD_KEY = ["mobile", "other_mobile", "call_channel"]


def checked_channels(calls: DataFrame, on_unknown: str = "error") -> DataFrame:
    """``calls`` with known channels only.  ``'error'`` fails the job on any
    other channel (null included) among the rows that reach this step,
    whichever columns are read later: the check is a filter, and the observed
    count below it keeps the optimizer from moving it before the step in front.
    ``'drop'`` drops such rows."""
    known = F.coalesce(known_channel("call_channel"), F.lit(False))
    if on_unknown == "drop":
        return calls.filter(known)
    if on_unknown != "error":
        raise ValueError("on_unknown must be 'error' or 'drop'")
    fail = F.raise_error(F.concat(F.lit("unknown call_channel: "), F.coalesce(F.col("call_channel"), F.lit("null"))))
    seen = calls.observe(f"unknown_channels_{uuid.uuid4().hex}", F.count_if(~known).alias("n"))
    return seen.filter(F.when(known, F.lit(True)).otherwise(fail.cast("boolean")))


def orient_calls(calls: DataFrame, on_unknown: str = "error", keep=("call_time",)) -> DataFrame:
    """(src, dst) from (mobile, other_mobile, call_channel), after
    ``checked_channels``."""
    src, dst = oriented("mobile", "other_mobile", "call_channel")
    extra = [c for c in keep if c in calls.columns]
    return checked_channels(calls, on_unknown).select(src.alias("src"), dst.alias("dst"), *extra)


def reverse_edges(edges: DataFrame) -> DataFrame:
    """Swap the ends of every edge."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest)


def split_pair(lines: DataFrame, col: str = "value", sep: str = ",") -> DataFrame:
    """``a,b`` text back into (src, dst)."""
    parts = F.split(F.col(col), sep, -1)
    return lines.select(parts.getItem(0).alias("src"), parts.getItem(1).alias("dst"))


def edge_nodes(edges: DataFrame) -> DataFrame:
    """P5: every end of every edge as a row ``mobile`` (not distinct)."""
    return edges.select(F.explode(F.array("src", "dst")).alias("mobile"))


def persons(edges: DataFrame) -> DataFrame:
    """Distinct nodes of a call graph."""
    return edge_nodes(edges).distinct()


def valid_pairs(df: DataFrame, pattern: str = MOBILE, a: str = "src", b: str = "dst") -> DataFrame:
    """Keep rows whose two ends fully match ``pattern``."""
    return df.filter(full_match(a, pattern) & full_match(b, pattern))


def between_members(calls: DataFrame, src_members: DataFrame | Cohort, dst_members: DataFrame | Cohort | None = None,
                    a: str = "mobile", b: str = "other_mobile", broadcast="auto", combine=None) -> DataFrame:
    """Keep calls whose end ``a`` is in ``src_members`` and end ``b``
    in ``dst_members`` (default the same cohort).  With one cohort the test
    is direction-free, so it may run before or after orientation.  Modes as in
    ``membership.restricted``."""
    first = measured(src_members)
    second = first if dst_members is None or dst_members is src_members else measured(dst_members)
    return restricted(calls, [(a, first), (b, second)], broadcast, combine)


def owned_by_members(calls: DataFrame, members: DataFrame | Cohort, owner: str = "mobile",
                     broadcast="auto", combine=None) -> DataFrame:
    """Keep calls whose record owner (``mobile``, before orientation) is a
    member.  Calls stored bucketed by ``owner`` (``tables.store_bucketed``) are
    not shuffled in either plan."""
    return restricted(calls, [(owner, measured(members))], broadcast, combine)


def edge_stats(edges: DataFrame, duration: str = "duration") -> DataFrame:
    """A3: calls and mean duration per directed pair (count, sum, divide)."""
    return (edges.groupBy("src", "dst")
            .agg(F.count(F.lit(1)).alias("calls"), F.sum(duration).alias("total_duration"))
            .select("src", "dst", "calls",
                    (F.col("total_duration") / F.col("calls")).alias("mean_duration")))


def edge_pairs(edges: DataFrame) -> DataFrame:
    """A4: distinct directed pairs."""
    return edges.select("src", "dst").distinct()


def min_calls(edges: DataFrame, n: int = 2) -> DataFrame:
    """keep pairs with at least ``n`` calls (the source jobs keep ``> 1``)."""
    return edges.filter(F.col("calls") >= n) if n and n > 1 else edges


def call_edges(calls: DataFrame, members: DataFrame | None = None, **rules) -> DataFrame:
    """Directed call graph with call count and mean duration.

    Durations that are not digit strings count as a call of 0.0 seconds;
    self-calls are kept.  ``rules`` as in ``edges_from_records``, of which
    this is the case of one record per call.

    Output: src, dst, calls (bigint), mean_duration (double).
    """
    return edges_from_records(as_records(calls), members, **rules)


def as_records(calls: DataFrame) -> DataFrame:
    """Every call as a record of one call: (mobile, other_mobile, call_channel, n, total)."""
    return calls.select(*RECORD_KEY, F.lit(1).cast("long").alias("n"), digits_or_zero("call_time").alias("total"))


def edges_from_records(records: DataFrame, members: DataFrame | None = None, *, min_n: int = 2, **rules) -> DataFrame:
    """Call graph from records (mobile, other_mobile, call_channel, n, total)
    where ``n`` counts calls and ``total`` sums their durations, in any number
    of rows per record.  ``min_n``: minimum number of calls per pair (2 means
    "more than one").  Other ``rules`` as in ``kept_records``."""
    e = (kept_records(records, members, **rules).groupBy("src", "dst")
         .agg(F.sum("n").alias("calls"), F.sum("total").alias("total_duration"))
         .select("src", "dst", "calls", (F.col("total_duration") / F.col("calls")).alias("mean_duration")))
    return min_calls(e, min_n)


def kept_records(records: DataFrame, members: DataFrame | None = None, *, dst_members: DataFrame | None = None,
                 ends: str = "both", pattern: str = MOBILE, prefix: str | None = None, on_unknown: str = "error",
                 check: str = "members", broadcast="auto") -> DataFrame:
    """Oriented rows (src, dst, n, total) of the records between members with
    valid numbers.

    * ``members``: cohort of mobiles; ``ends='both'`` keeps records with both
      ends in it (``dst_members`` for the other end if given), ``'owner'``
      only tests the record owner; ``None`` keeps every record.
    * ``pattern``: full-match pattern for both ends (after ``prefix``), tested
      after the channel.
    * ``on_unknown``: ``'error'`` fails the job on an unknown channel,
      ``'drop'`` drops such records.  ``check='members'`` looks at the records
      of members (the source jobs that join the cohort first), ``'history'``
      at every record read (those that match the channel first).
    * ``broadcast='auto'``: cohorts measured within the budget are broadcast
      and filter the records inside the scan stage.  Else, and with ``False``,
      a Bloom filter drops almost all non-members there, records are summed
      per key with a map-side combine, and the exact shuffle semi-joins run
      on those sums.  Membership depends only on the two numbers, so both
      plans give the same rows.
    """
    if ends not in ("both", "owner"):
        raise ValueError("ends must be 'both' or 'owner'")
    if check not in ("members", "history"):
        raise ValueError("check must be 'members' or 'history'")
    r = records.select(*RECORD_KEY, "n", "total")
    if check == "history":
        r = checked_channels(r, on_unknown)
    if members is not None:
        r = (between_members(r, members, dst_members, broadcast=broadcast, combine=_summed) if ends == "both"
             else owned_by_members(r, members, broadcast=broadcast, combine=_summed))
    if check == "members":
        r = checked_channels(r, on_unknown)
    if prefix:
        r = r.select(prefixed("mobile", prefix).alias("mobile"), prefixed("other_mobile", prefix).alias("other_mobile"),
                     "call_channel", "n", "total")
    # Direction-free, so tested on the raw ends.
    r = valid_pairs(r, pattern, "mobile", "other_mobile")
    src, dst = oriented("mobile", "other_mobile", "call_channel")
    return r.select(src.alias("src"), dst.alias("dst"), "n", "total")


def _summed(records: DataFrame) -> DataFrame:
    return records.groupBy(*RECORD_KEY).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def with_mean_text(edges: DataFrame) -> DataFrame:
    """Adds ``mean_text``: the mean duration as two-decimal text."""
    return edges.withColumn("mean_text", two_decimals("mean_duration"))


def rank_edges(calls: DataFrame, members: DataFrame, pattern: str = MOBILE,
               on_unknown: str = "error", broadcast="auto") -> DataFrame:
    """Distinct directed pairs between cohort members (ranking input).

    With ``on_unknown='error'`` any call with a bad channel in the scanned
    history fails the job, as in the source job."""
    rows = calls.select(*RECORD_KEY, F.lit(1).cast("long").alias("n"), F.lit(0.0).alias("total"))
    return edge_pairs(kept_records(rows, members, pattern=pattern, on_unknown=on_unknown, check="history",
                                   broadcast=broadcast))
