"""Cohort membership joins with a measured broadcast decision.

A cohort (a one-column table of mobiles) filters the call history, which is
the largest input by far.  Broadcasting the cohort lets every scan task drop
non-members before any shuffle.  The cohort grows with the user base, so it is
written once to the checkpoint folder, its rows and key bytes are counted on
that copy, and the count is compared with a budget of its own
(``riskgraph.broadcastBytes``; Spark's general threshold is meant for unmeasured
sides and is far smaller).  Both the count and the joins read the copy, so the
cohort's source is scanned once.

Above the budget a blocked Bloom filter of the counted size drops almost all
non-members in the scan stage, and exact shuffle semi-joins run on what is
left (after aggregation, where the caller can aggregate).

Nothing is kept between calls: a cohort is read anew by every query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.session import cut_lineage

BUDGET_CONF = "riskgraph.broadcastBytes"
BUDGET_BYTES = 256 << 20
# Bytes a broadcast hash relation spends per row besides the key text itself
# (UnsafeRow header and offsets, hash-map slot).
ROW_OVERHEAD_BYTES = 48
# The filter: a member sets PROBES bits of one 64-bit word, so a lookup reads
# one word.  Words stand in arrays of CHUNK_WORDS, one broadcast row each.
BITS_PER_MEMBER = 16
PROBES = 5
CHUNK_WORDS = 1024
MOST_WORDS = 1 << 25  # 2^31 bits, 256 MB: 16 bits for each of 134 million members, fewer beyond


def broadcast_budget(spark: SparkSession) -> int:
    return int(spark.conf.get(BUDGET_CONF, str(BUDGET_BYTES)))


@dataclass(frozen=True, eq=False)
class Cohort:
    """A cohort written once (column ``mobile``), with its size."""

    members: DataFrame
    rows: int
    key_bytes: int

    @property
    def fits(self) -> bool:
        """Whether ``rows * 48 + key bytes`` is within the broadcast budget."""
        limit = broadcast_budget(self.members.sparkSession)
        return limit > 0 and self.rows * ROW_OVERHEAD_BYTES + self.key_bytes <= limit

    @property
    def words(self) -> int:
        """Words of the filter: a power of two that gives every member
        ``BITS_PER_MEMBER`` bits, up to ``MOST_WORDS``."""
        need = max(1, -(-self.rows * BITS_PER_MEMBER // 64))
        return min(MOST_WORDS, max(CHUNK_WORDS, 1 << (need - 1).bit_length()))


def measured(members: DataFrame | Cohort, key: str = "mobile") -> Cohort:
    """``members`` written to the checkpoint folder and counted there (two
    small jobs, run now).  A ``Cohort`` is returned as it is."""
    if isinstance(members, Cohort):
        return members
    copy = cut_lineage(members.select(F.col(key).alias("mobile")).filter(F.col(key).isNotNull()))
    rows, key_bytes = copy.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("mobile")), F.lit(0))).first()
    return Cohort(copy, rows, key_bytes)


def sized(side: DataFrame, broadcast="auto") -> DataFrame:
    """A join side written to the checkpoint folder, with a broadcast hint if
    its rows, counted there, fit the budget; any other mode than ``'auto'``
    leaves the choice to the optimizer and AQE."""
    if broadcast != "auto":
        return side
    copy = cut_lineage(side)
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in copy.columns), F.lit(0))
    rows, octets = copy.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return F.broadcast(copy) if Cohort(copy, rows, octets).fits else copy


def member_filter(df: DataFrame, members: DataFrame, on: str, key: str = "mobile") -> DataFrame:
    """Keep rows of ``df`` whose ``on`` column is in ``members.key``
    (``left_semi``: no columns or duplicates leak from the cohort).  The
    column order of ``df`` is kept."""
    m = members.select(F.col(key).alias(on))
    return df.join(m, on, "left_semi").select(*df.columns)


def _place(key: str, words: int) -> tuple[Column, Column]:
    """(word, mask) of a key: low hash bits name the word, five fields of the
    high ones its bits."""
    h = F.xxhash64(key)
    mask = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(__h, {64 - 6 * (p + 1)}) & 63 as int))" for p in range(PROBES))
    return h.bitwiseAND(F.lit(words - 1).cast("long")), F.expr(mask)


def member_bits(cohort: Cohort) -> DataFrame:
    """The filter as rows (chunk, words: array of ``CHUNK_WORDS`` longs),
    ``cohort.words`` words in all.  Built by a shuffle on the word number; a
    range of empty words fills the gaps."""
    spark = cohort.members.sparkSession
    word, mask = _place("mobile", cohort.words)
    hashed = cohort.members.select("mobile", F.xxhash64("mobile").alias("__h"))
    bits = hashed.select(word.alias("word"), mask.alias("bits"))
    empty = spark.range(cohort.words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    whole = bits.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return (whole.groupBy(F.floor(F.col("word") / CHUNK_WORDS).alias("__chunk"))
            .agg(ordered.getField("bits").alias("__words")))


def maybe_members(df: DataFrame, cohort: Cohort, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` may be a member: no member is lost, and
    about one non-member in a hundred passes.  The filter has a bounded size,
    so it is always broadcast and the rows are not shuffled."""
    word, mask = _place(on, cohort.words)
    hashed = df.withColumn("__h", F.xxhash64(on)).withColumn("__word", word).withColumn("__mask", mask)
    hashed = hashed.withColumn("__chunk", F.floor(F.col("__word") / CHUNK_WORDS))
    found = F.get("__words", (F.col("__word") % CHUNK_WORDS).cast("int"))
    return (hashed.join(F.broadcast(member_bits(cohort)), "__chunk")
            .filter(found.bitwiseAND(F.col("__mask")) == F.col("__mask")).select(*df.columns))


def restricted(df: DataFrame, tests: list[tuple[str, Cohort]], broadcast="auto",
               combine: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows of ``df`` that pass every (column, cohort) test.

    With ``'auto'`` and cohorts that all fit the budget the tests are broadcast
    semi-joins.  Else Bloom filters come first, then ``combine`` (an aggregation
    that keeps the tested columns), then shuffle semi-joins.
    """
    if broadcast == "auto" and all(c.fits for _, c in tests):
        for on, c in tests:
            df = member_filter(df, F.broadcast(c.members), on)
        return df
    for on, c in tests:
        df = maybe_members(df, c, on)
    if combine is not None:
        df = combine(df)
    for on, c in tests:
        df = member_filter(df, c.members, on)
    return df
