"""Applicant cohorts: who applied, who passed, who applied on a given day.

A user is (user_id, ds); the contact table maps a user to a mobile.  All
cohorts are keyed by mobile.  Joins here are between per-user tables of the
same day, so both sides are bounded by the user count and hash-partition on
(user_id, ds) with no skew; AQE turns them into broadcast joins when one side
is measured small at runtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.functions.exprs import later_than_day
from riskgraph.sources.tables import snapshot

USER_KEY = ["user_id", "ds"]


def with_contact(users: DataFrame, contact: DataFrame) -> DataFrame:
    """Inner join on (user_id, ds); every matching pair of rows is kept."""
    return users.join(contact, USER_KEY, "inner")


LIFECYCLE = ["first_apply_credit_time", "first_apply_credit_succ_time", "first_apply_loan_succ_time",
             "max_overdue_day_cnt", "curr_inloan_cnt", "max_prepayment_day_cnt"]


def day_users(profile: DataFrame, contact: DataFrame, day) -> DataFrame:
    """J1 once for a day: every user row of the day's profile with its
    contact mobile and life-cycle columns.  Jobs that need several cohorts
    of the same day join once, cut the lineage and derive them all with the
    ``*_from`` functions below."""
    users = snapshot(profile, day).select(*USER_KEY, *LIFECYCLE)
    c = snapshot(contact, day).select(*USER_KEY, "mobile")
    return with_contact(users, c)


def has_applied():
    return F.col("first_apply_credit_time").isNotNull()


def has_passed():
    return F.col("first_apply_credit_succ_time").isNotNull()


def applied_unpassed(rows: DataFrame) -> DataFrame:
    """user rows with an apply time and no pass time."""
    return rows.filter(has_applied() & ~has_passed())


def _mobiles(rows: DataFrame) -> DataFrame:
    return rows.select("mobile").filter(F.col("mobile").isNotNull()).distinct()


def applied_from(rows: DataFrame) -> DataFrame:
    """C1 from ``day_users`` rows."""
    return _mobiles(rows.filter(has_applied()))


def applied_not_passed_from(rows: DataFrame) -> DataFrame:
    """C2 from ``day_users`` rows.  Decided per user row, so a mobile with one
    passed and one failed user is here and in ``passed_summary`` too."""
    return _mobiles(applied_unpassed(rows))


def passed_rows(rows: DataFrame) -> DataFrame:
    """Passed user rows of ``day_users`` with a mobile."""
    return rows.filter(has_passed() & F.col("mobile").isNotNull())


def passed_summary_from(rows: DataFrame) -> DataFrame:
    """C3 from ``day_users`` rows."""
    return passed_rows(rows).groupBy("mobile").agg(*[F.max(c).alias(c) for c in LIFECYCLE[2:]])


def applied(profile: DataFrame, contact: DataFrame, day) -> DataFrame:
    """Distinct mobiles of users with an apply time on ``day``'s snapshot."""
    return applied_from(day_users(profile, contact, day))


def applied_not_passed(profile: DataFrame, contact: DataFrame, day) -> DataFrame:
    """Distinct mobiles of user rows that applied and never passed."""
    return applied_not_passed_from(day_users(profile, contact, day))


def passed_summary(profile: DataFrame, contact: DataFrame, day) -> DataFrame:
    """Per mobile of passed users, the max loan-success time, overdue
    days, in-loan count and prepayment days.  Null mobiles are dropped."""
    return passed_summary_from(day_users(profile, contact, day))


def incremental_applicants(apply: DataFrame, contact: DataFrame, day, after=None) -> DataFrame:
    """Distinct mobiles of users whose apply time on ``day``'s snapshot is
    later than ``after`` (default ``day``), compared as text (F5)."""
    after = day if after is None else after
    users = (snapshot(apply, day).filter(later_than_day("apply_time", after))
             .select(*USER_KEY))
    c = snapshot(contact, day).select(*USER_KEY, "mobile")
    return _mobiles(with_contact(users, c))
