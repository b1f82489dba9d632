"""Risk lists of mobiles: white, grey and black lists and their merges.

Day counts are read with null as 0 (the source jobs unboxed a null to 0), while
the "borrowed" test is a true null test on the loan-success time.  The lists
are not a partition: a borrowed mobile with in-loan > 0 and few overdue days is
in no list, and the wide black list overlaps the strict white list at 7.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.functions.exprs import nz, prefixed
from riskgraph.operators import cohorts
from riskgraph.operators.membership import sized
from riskgraph.sources.tables import snapshot


# The rules of the lists, on the columns of a passed summary (or of one user row).

def no_borrow_rule():
    """C4: no loan."""
    return F.col("first_apply_loan_succ_time").isNull()


def white_rule(max_overdue: int = 7, require_no_inloan: bool = True, max_prepay: int | None = None):
    """C5 (default), C6 (``max_prepay=3``), C7 (``require_no_inloan=False``):
    borrowed, overdue days <= ``max_overdue``."""
    cond = ~no_borrow_rule() & (nz("max_overdue_day_cnt") <= max_overdue)
    if require_no_inloan:
        cond = cond & (nz("curr_inloan_cnt") == 0)
    if max_prepay is not None:
        cond = cond & (nz("max_prepayment_day_cnt") <= max_prepay)
    return cond


def grey_rule(above: int = 7, upto: int = 14):
    """Borrowed, ``above`` < overdue days <= ``upto``."""
    return ~no_borrow_rule() & (nz("max_overdue_day_cnt") > above) & (nz("max_overdue_day_cnt") <= upto)


def black_rule(min_overdue: int = 15):
    """C9 (default, overdue > 14) and C10 (``min_overdue=7``): borrowed,
    overdue days >= ``min_overdue``."""
    return ~no_borrow_rule() & (nz("max_overdue_day_cnt") >= min_overdue)


def _mobiles(df: DataFrame, cond) -> DataFrame:
    return df.filter(cond).select("mobile").filter(F.col("mobile").isNotNull()).distinct()


def passed_no_borrow(passed: DataFrame) -> DataFrame:
    """C4: passed mobiles with no loan."""
    return _mobiles(passed, no_borrow_rule())


def whitelist(passed: DataFrame, **rule) -> DataFrame:
    """Mobiles under ``white_rule``."""
    return _mobiles(passed, white_rule(**rule))


def greylist(passed: DataFrame, **rule) -> DataFrame:
    """Mobiles under ``grey_rule``."""
    return _mobiles(passed, grey_rule(**rule))


def blacklist(passed: DataFrame, **rule) -> DataFrame:
    """Mobiles under ``black_rule``."""
    return _mobiles(passed, black_rule(**rule))


def third_party(blacklisted: DataFrame, day) -> DataFrame:
    """C11: the third-party black list of ``day``."""
    return snapshot(blacklisted, day).select("mobile")


def fraud_loans(collection: DataFrame, day, label: str, channels) -> DataFrame:
    """loan ids of ``day``'s collection records with the fraud label in
    the given channels."""
    return (snapshot(collection, day)
            .filter((F.col("loan_name") == label) & F.col("ds").isin(list(channels)))
            .select("loan_id"))


def loans_in(repay: DataFrame, loans: DataFrame, day, broadcast="auto") -> DataFrame:
    """``day``'s repayment rows whose loan id is among ``loans``.  The
    match is on loan_id only; the channel of the loan is not compared."""
    rows = snapshot(repay, day).select("user_id", "ds", "loan_id")
    return rows.join(sized(loans, broadcast), "loan_id", "left_semi")


def with_day_contact(rows: DataFrame, contact: DataFrame, day) -> DataFrame:
    """Left join with the contacts of ``day``.  The day belongs to the
    join, so a user without a contact row that day yields a null mobile."""
    return rows.join(snapshot(contact, day).select("user_id", "ds", "mobile"), ["user_id", "ds"], "left")


def fraud_history_mobiles(repay: DataFrame, collection: DataFrame, contact: DataFrame, day,
                          label: str, channels, broadcast="auto") -> DataFrame:
    """One row per repayment row of a fraud loan, with the user's mobile
    (J3, then J2).  Rows and nulls are kept as a bag; sinks drop nulls and
    duplicates."""
    loans = loans_in(repay, fraud_loans(collection, day, label, channels), day, broadcast)
    return with_day_contact(loans, contact, day).select("mobile")


def merge_lists(*lists: DataFrame) -> DataFrame:
    """Bag union of mobile lists, then distinct, nulls dropped."""
    merged = reduce(lambda a, b: a.unionByName(b), [d.select("mobile") for d in lists])
    return merged.filter(F.col("mobile").isNotNull()).distinct()


def merged_blacklist(passed: DataFrame, blacklisted: DataFrame, repay: DataFrame,
                     collection: DataFrame, contact: DataFrame, day, label: str,
                     channels) -> DataFrame:
    """Own black list, third-party list and fraud history, merged."""
    return merge_lists(blacklist(passed), third_party(blacklisted, day),
                       fraud_history_mobiles(repay, collection, contact, day, label, channels))


# Names of the list folders in the graph export.
NO_BORROW, GREY, WHITE, BLACK = "applycreditNoBorrow", "borrowNotwb", "whitelist", "blacklist"


APPLY_NOT_PASS = "applyNotPass"


def _labels(white, extra=None):
    rules = [(NO_BORROW, no_borrow_rule()), (GREY, grey_rule()), (WHITE, white), (BLACK, black_rule())]
    if extra is not None:
        name, first, rest = extra
        return F.array_compact(F.array(F.when(first, F.lit(name)), *[F.when(rest & c, F.lit(n)) for n, c in rules]))
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))


def list_labels(passed: DataFrame, **white) -> DataFrame:
    """All four per-mobile lists of C27 in one pass: (list, mobile) rows; the
    white list under ``white_rule(**white)``."""
    return (passed.filter(F.col("mobile").isNotNull())
            .select(F.explode(_labels(white_rule(**white))).alias("list"), "mobile").distinct())


def graph_lists_from(rows: DataFrame) -> DataFrame:
    """The five lists of the graph export (list, mobile) from ``day_users``
    rows in one aggregate per mobile: the maxima of its passed rows, whether
    it has one, and whether some user of it applied and did not pass."""
    passed = cohorts.has_passed()
    per = (rows.filter(F.col("mobile").isNotNull()).groupBy("mobile").agg(
        *[F.max(F.when(passed, F.col(c))).alias(c) for c in cohorts.LIFECYCLE[2:]],
        F.max(passed).alias("passed"), F.max(cohorts.has_applied() & ~passed).alias("not_passed")))
    labels = _labels(white_rule(), (APPLY_NOT_PASS, F.col("not_passed"), F.col("passed")))
    return per.select(F.explode(labels).alias("list"), "mobile")


def segments_per_user(profile: DataFrame, contact: DataFrame, day, prefix: str | None = "p") -> DataFrame:
    """C14: the no-loan, grey, white and black rules applied per passed *user
    row* (not per mobile), so one mobile can land in several lists.  The white
    rule here ignores the in-loan count.  Output (list, mobile), mobile
    prefixed with ``prefix``, distinct per list."""
    rows = cohorts.passed_rows(cohorts.day_users(profile, contact, day))
    m = prefixed("mobile", prefix) if prefix else F.col("mobile")
    return rows.select(F.explode(_labels(white_rule(require_no_inloan=False))).alias("list"), m.alias("mobile")).distinct()
