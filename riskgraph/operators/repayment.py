"""Loan repayment facts and scores against overdue days."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph.functions.exprs import SETTLED, day_text, to_day
from riskgraph.operators.cohorts import USER_KEY
from riskgraph.operators.membership import sized
from riskgraph.session import cut_lineage
from riskgraph.sources.tables import snapshot

LOAN_KEY = ["loan_id", "user_id", "ds"]
OVERDUE_COLS = ["loan_id", "ds", "mobile", "early_day", "overdue_day"]


def due_or_settled(repay: DataFrame, since, as_of, settled_code: str = SETTLED) -> DataFrame:
    """instalments created on or after ``since`` that are settled or due
    on or before ``as_of``."""
    return repay.filter(
        (to_day("create_time") >= F.lit(day_text(since)).cast("date"))
        & ((F.col("repay_status") == settled_code)
           | (to_day("due_day") <= F.lit(day_text(as_of)).cast("date"))))


def loan_extremes(repay: DataFrame) -> DataFrame:
    """A2: max early and overdue days per (loan, user, channel)."""
    return repay.groupBy(*LOAN_KEY).agg(F.max("early_day").alias("early_day"),
                                        F.max("overdue_day").alias("overdue_day"))


def overdue_info(repay: DataFrame, profile: DataFrame, day, since,
                 decode: Callable[[Column], Column] | None = None, as_of=None) -> DataFrame:
    """Per loan of ``day``'s repayment snapshot (created since ``since``,
    settled or due by ``as_of``, default ``day``): max early and overdue days
    with the user's mobile decoded from the profile (V1: ``decode`` is any
    column function, identity by default).

    Output: loan_id, ds, mobile, early_day, overdue_day.
    """
    as_of = day if as_of is None else as_of
    decode = decode or (lambda c: c)
    loans = loan_extremes(due_or_settled(snapshot(repay, day), since, as_of))
    users = snapshot(profile, day).select(*USER_KEY, decode(F.col("mobile_encode")).alias("mobile"))
    return loans.join(users, USER_KEY).select(*OVERDUE_COLS)


def scored_facts(overdue: DataFrame, scores: DataFrame) -> DataFrame:
    """Distinct loan facts joined with scores on mobile (many to many),
    one row per matching (fact, score) pair."""
    facts = overdue.select(*OVERDUE_COLS).dropDuplicates()
    return facts.join(scores.select("mobile", "score"), "mobile")


# Rows of one mobile on one side beyond which ``scored_facts_split`` splits it.
HOT_ROWS = 100_000


def split_join(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join on ``key`` where heavy keys meet in many tasks.

    Both sides are written to the checkpoint folder and counted per key.  A key
    with more than ``hot_rows`` on its larger side is dealt there, row by row
    (repeated rows as well), into parts of about ``hot_rows``, and the rows of
    its smaller side are copied to every part; all other keys have one part.
    The written rows have a fixed order, so a repeated task deals them alike.
    The rows are those of the plain join.
    """
    left, right = cut_lineage(left), cut_lineage(right)

    def counted(df, name):
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))

    heavy = (counted(left, "l").join(counted(right, "r"), key)
             .filter(F.greatest("l", "r") > hot_rows)
             .select(key, (F.col("l") >= F.col("r")).alias("__left_split"),
                     F.ceil(F.greatest("l", "r") / hot_rows).cast("int").alias("__parts")))
    heavy = sized(heavy)

    def dealt(df, splits):
        rows = df.withColumn("__row", F.monotonically_increasing_id()).join(heavy, key, "left")
        one = F.pmod(F.col("__row"), F.coalesce("__parts", F.lit(1))).cast("int")
        copied = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
        part = F.when(F.coalesce(splits, F.lit(True)), F.array(one)).otherwise(copied)
        return rows.withColumn("__part", F.explode(part)).select(*df.columns, "__part")

    a, b = dealt(left, F.col("__left_split")), dealt(right, ~F.col("__left_split"))
    return a.join(b, [key, "__part"]).drop("__part")


def scored_facts_split(overdue: DataFrame, scores: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """J8 by ``split_join``: the same rows as ``scored_facts`` where a mobile
    holds a large share of the facts or scores."""
    return split_join(overdue.select(*OVERDUE_COLS).dropDuplicates(), scores.select("mobile", "score"), "mobile", hot_rows)


def score_vs_overdue(overdue: DataFrame, scores: DataFrame) -> DataFrame:
    """(score, overdue_day) of ``scored_facts``."""
    return scored_facts(overdue, scores).select("score", "overdue_day")


TIES = ["overdue_day", "loan_id", "mobile"]


def order_by_score(df: DataFrame, col: str = "score", ties=TIES) -> DataFrame:
    """O1: total order by a double, highest first (range-partitioned sort).
    Equal scores may come in any order; the ``ties`` columns that ``df`` has
    order them, so the rows of one common score spread over range partitions."""
    return df.orderBy(F.col(col).desc(), *[F.col(c) for c in ties if c in df.columns])


def order_by_text_key(df: DataFrame, key: str) -> DataFrame:
    """O2: total order by a text key, ascending, so ``"12"`` sorts before ``"2"``."""
    return df.orderBy(F.col(key).cast("string").asc())
