"""Daily and monthly totals of the call history.

The call graph jobs read every call before a day (``dt < day``).  Everything
they need from a call record is additive: the number of calls and the duration
sum per (mobile, other_mobile, call_channel).  So each day's calls are stored
once as totals, one folder per day, and the graph is computed from the folders
of all days by ``edges.edges_from_records`` with the same rules as on raw
calls: the sums are exact because durations are whole numbers.

A manifest beside the totals holds, for every good day, its number of calls and
an order-free digest of them (the sum of the row hashes).  A day is stale when
the raw day's count or digest differs from the manifest, or when its folder
does not hold that number of calls: so missing, empty or half-written folders,
late calls, corrected calls and days that lost all their calls all show.
``refresh_totals`` rebuilds just those days and writes the manifest last;
``read_totals`` reads the days of the manifest only, and refuses while any day
is stale.  The digest reads every column of the raw calls it covers.  A job that
knows its old days closed names the first open day (``open_from``): days before
it are compared by their number of calls, which reads no column.

Months that lie whole before the day are rolled up in the same way
(``roll_months``): a month's totals are good while the digests of its days are
those it was made of, so a run reads good months and the days of all others.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgraph.functions.exprs import day_text, digits_or_zero
from riskgraph.operators.edges import RECORD_KEY, edges_from_records, rank_edges
from riskgraph.sources.tables import history

_RECORD = [
    T.StructField("mobile", T.StringType()),
    T.StructField("other_mobile", T.StringType()),
    T.StructField("call_channel", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("total", T.DoubleType()),
]
TOTALS = T.StructType([*_RECORD, T.StructField("dt", T.StringType())])
MONTHS = T.StructType([*_RECORD, T.StructField("month", T.StringType())])
# dt (a day or a month), calls, digest
MANIFEST = T.StructType([
    T.StructField("dt", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("digest", T.StringType()),
])

Manifest = dict[str, tuple[int, str]]


def day_totals(calls: DataFrame) -> DataFrame:
    """Calls and duration sum per day and record key."""
    return (calls.groupBy("dt", *RECORD_KEY)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(digits_or_zero("call_time")).alias("total"))
            .select(*[f.name for f in TOTALS.fields]))


def _ranged(rows: DataFrame, folder: str) -> DataFrame:
    """Rows in ranges of the folder and the record key: a small folder goes to
    one task and a large one to many.  A sum per folder and key needs no further
    shuffle, so the rows are moved once for the sum and the files."""
    return rows.repartitionByRange(_tasks(rows.sparkSession), folder, *RECORD_KEY)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _months_root(root: str) -> str:
    return f"{root.rstrip('/')}_months"


def _tasks(spark: SparkSession) -> int:
    """Writing tasks; folders are many and small, so they are not coalesced by size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _manifest(spark: SparkSession, root: str) -> Manifest:
    """Good days (or months) under ``root``; bounded by the days of the history."""
    rows = _stored(spark, f"{root.rstrip('/')}_manifest", MANIFEST).collect()
    return {r["dt"]: (r["n"], r["digest"]) for r in rows}


def _write_manifest(spark: SparkSession, root: str, good: Manifest) -> None:
    rows = [(d, n, digest) for d, (n, digest) in sorted(good.items())]
    (spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}_manifest"))


def day_digests(calls: DataFrame, open_from=None) -> DataFrame:
    """(dt, n, digest) per day of the calls.  The digest is the sum of the
    hashes of all rows, so it does not depend on their order and counts repeats;
    it is null for days before ``open_from``."""
    parts = [x for c in (*RECORD_KEY, "call_time") for x in (F.col(c), F.col(c).isNull())]  # a hash skips nulls
    row = F.xxhash64(*parts).cast("decimal(20,0)")
    if open_from is not None:
        row = F.when(F.col("dt") >= F.lit(day_text(open_from)), row)
    return calls.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum(row).cast("string").alias("digest"))


def _check(spark: SparkSession, calls: DataFrame, root: str, before, open_from) -> tuple[Manifest, Manifest, list[str]]:
    """(raw days, good days of the manifest before ``before``, stale days)."""
    raw = {r["dt"]: (r["n"], r["digest"]) for r in day_digests(history(calls, before), open_from).collect()}
    held = {r["dt"]: r["n"] for r in history(_stored(spark, root, TOTALS), before).groupBy("dt").agg(F.sum("n").alias("n")).collect()}
    written = {d: v for d, v in _manifest(spark, root).items() if d < day_text(before)}

    def good(d):
        if d not in raw or d not in written:
            return False
        (n, digest), (m, known) = raw[d], written[d]
        return n == m == held.get(d) and (digest == known or digest is None)

    return raw, written, sorted(d for d in {*raw, *written} if not good(d))


def stale_days(spark: SparkSession, calls: DataFrame, root: str, before, open_from=None) -> list[str]:
    """Days before ``before`` whose stored totals are not those of the raw
    calls; days of the manifest that have no calls any more are among them."""
    return _check(spark, calls, root, before, open_from)[2]


def refresh_totals(spark: SparkSession, calls: DataFrame, root: str, before, open_from=None) -> list[str]:
    """Write the totals of every stale day before ``before`` (each day's folder
    is replaced whole), drop days without calls from the manifest, and return
    the days that changed."""
    raw, written, days = _check(spark, calls, root, before, open_from)
    if not days:
        return days
    rebuilt = [d for d in days if d in raw]
    kept = {d: v for d, v in _manifest(spark, root).items() if d not in days}
    if rebuilt:
        due = calls.filter(F.col("dt").isin(rebuilt))
        # The check has read the digests of all days but those before open_from.
        kept.update({d: raw[d] for d in rebuilt})
        unread = [d for d in rebuilt if raw[d][1] is None]
        if unread:
            kept.update({r["dt"]: (r["n"], r["digest"]) for r in day_digests(calls.filter(F.col("dt").isin(unread))).collect()})
        (day_totals(_ranged(due.select("dt", *RECORD_KEY, "call_time"), "dt")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(root))
    _write_manifest(spark, root, kept)
    return days


def _months(good: Manifest, before) -> dict[str, Manifest]:
    """Good days by month, for months that end before ``before``."""
    out: dict[str, Manifest] = {}
    for d, v in good.items():
        if d[:7] < day_text(before)[:7]:
            out.setdefault(d[:7], {})[d] = v
    return out


def _month_mark(days: Manifest) -> tuple[int, str]:
    """Calls and digest of a month: those of its days, day by day."""
    return sum(n for n, _ in days.values()), ";".join(f"{d}={n}:{digest}" for d, (n, digest) in sorted(days.items()))


def _good_months(spark: SparkSession, root: str, good: Manifest, before) -> tuple[dict[str, Manifest], list[str]]:
    """(months before ``before`` with their days, those whose totals are good)."""
    months, top = _months(good, before), _months_root(root)
    marks = _manifest(spark, top)
    held = {r["month"]: r["n"] for r in _stored(spark, top, MONTHS).groupBy("month").agg(F.sum("n").alias("n")).collect()}
    return months, [m for m, days in months.items() if marks.get(m) == _month_mark(days) and held.get(m) == marks[m][0]]


def roll_months(spark: SparkSession, root: str, before) -> list[str]:
    """Write the totals of every month that ends before ``before`` and whose
    good days are not those its totals were made of; returns these months.
    Reads the stored days only."""
    good = {d: v for d, v in _manifest(spark, root).items() if d < day_text(before)}
    months, fine = _good_months(spark, root, good, before)
    due = sorted(set(months) - set(fine))
    top = _months_root(root)
    kept = {m: v for m, v in _manifest(spark, top).items() if m not in due and m in months}
    if due:
        days = [d for m in due for d in months[m]]
        rows = _stored(spark, root, TOTALS).filter(F.col("dt").isin(days)).withColumn("month", F.substring("dt", 1, 7))
        (_ranged(rows.drop("dt"), "month").groupBy("month", *RECORD_KEY).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
         .select(*[f.name for f in MONTHS.fields]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(top))
        _write_manifest(spark, top, kept | {m: _month_mark(months[m]) for m in due})
    return due


def read_totals(spark: SparkSession, calls: DataFrame | None, root: str, before, open_from=None) -> DataFrame:
    """The stored totals before ``before``: good months (their rows under the
    month's first day) and the days of all other months.  Fails, naming the
    days, if any day does not match the raw calls.  ``calls`` of None skips that
    check: for a run that has just refreshed the totals itself."""
    if calls is None:
        good = {d: v for d, v in _manifest(spark, root).items() if d < day_text(before)}
    else:
        _, good, days = _check(spark, calls, root, before, open_from)
        if days:
            raise ValueError(f"totals under {root} do not match the calls of {len(days)} day(s): {', '.join(days[:10])}")
    months, fine = _good_months(spark, root, good, before)
    single = sorted(d for d in good if d[:7] not in fine)
    out = _stored(spark, root, TOTALS).filter(F.col("dt").isin(single))
    if fine:
        rolled = _stored(spark, _months_root(root), MONTHS).filter(F.col("month").isin(sorted(fine)))
        out = out.unionByName(rolled.select(*RECORD_KEY, "n", "total", F.concat("month", F.lit("-01")).alias("dt")))
    return out


def call_edges_from_totals(totals: DataFrame, members: DataFrame | None = None, **rules) -> DataFrame:
    """C15-C18 from totals (keywords as ``edges.edges_from_records``)."""
    return edges_from_records(totals, members, **rules)


def rank_edges_from_totals(totals: DataFrame, members: DataFrame, **rules) -> DataFrame:
    """C22 from totals: every row stands for at least one call."""
    return rank_edges(totals, members, **rules)
