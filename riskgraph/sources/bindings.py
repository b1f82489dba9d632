"""Logical tables derived from the driver's TPC-H style parquet tables.

The production jobs read daily Hive tables (user profile, contact, call
records, repayment plans, ...).  For tests and the bench those tables are
derived here, in Spark, from ``customer``, ``orders`` and ``lineitem`` by fixed
rules, so every query's work grows with the scale factor.  The same rules are
written in DuckDB SQL in ``riskgraph.plans.oracle`` for the correctness check.

Rules, with ``m(k) = '1' || lpad(k, 10, '0')`` and ``u(k) = m(k - 1)`` when
``k % 20 = 1`` else ``m(k)`` (so some mobiles belong to two users):

* user_contact: one row per customer; dt is the day before for custkey % 8 = 7.
* user_profile: one row per customer with first order dates (all, urgent,
  urgent and finished) as the apply / pass / loan times (null for a negative
  balance), day counts from the key, in-loan count from open orders.
* call_detail: one row per line item; owner = m(o_custkey), other =
  m(l_suppkey) with a leading 0 on line 7, incoming when returned, duration
  quantity * 60 as text (``n/a`` on line 6, null on line 5), dt = ship day.
* repay_plan, collection_record, third_party_blacklist, credit_apply,
  rank_score: see the functions below.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-09-01"          # today; yesterday is 2001-08-31
DAY = "2001-08-31"
STALE_DAY = "2001-08-30"
FRAUD = "FRAUD"
FRAUD_SEGMENTS = ("BUILDING", "AUTOMOBILE")
INCREMENT_DAY = "2001-08-31"
INCREMENT_AFTER = "2001-06-01"
YEAR_DAY = "2001-01-01"
HISTORY_BEFORE = DAY          # call history of the person graph is read with dt < this day
HISTORY_TO_TODAY = AS_OF      # that of all other graphs with dt < this day
LOANS_SINCE = "1998-10-01"


def mobile_of(k) -> Column:
    k = F.col(k) if isinstance(k, str) else k
    return F.concat(F.lit("1"), F.lpad(k.cast("string"), 10, "0"))


def user_mobile(k) -> Column:
    k = F.col(k) if isinstance(k, str) else k
    return mobile_of(F.when(k % 20 == 1, k - 1).otherwise(k))


def _day_unless(cond: Column) -> Column:
    return F.when(cond, F.lit(STALE_DAY)).otherwise(F.lit(DAY))


def user_contact(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("user_id"), F.col("c_mktsegment").alias("ds"),
        _day_unless(k % 8 == 7).alias("dt"), user_mobile(k).alias("mobile"))


def user_profile(customer: DataFrame, orders: DataFrame) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    per_cust = orders.groupBy(F.col("o_custkey")).agg(
        F.min("o_orderdate").alias("t_all"),
        F.min(F.when(urgent, F.col("o_orderdate"))).alias("t_urgent"),
        F.min(F.when(urgent & (F.col("o_orderstatus") == "F"), F.col("o_orderdate"))).alias("t_urgent_f"),
        F.count(F.when(F.col("o_orderstatus") == "O", F.lit(1))).alias("n_open"))
    k = F.col("c_custkey")
    neg = F.col("c_acctbal") < 0

    def unless_negative(c):
        return F.when(neg, F.lit(None)).otherwise(F.col(c))

    return (customer.join(per_cust, customer["c_custkey"] == per_cust["o_custkey"], "left")
            .select(
                k.alias("user_id"), F.col("c_mktsegment").alias("ds"),
                _day_unless(k % 10 == 9).alias("dt"),
                unless_negative("t_all").alias("first_apply_credit_time"),
                unless_negative("t_urgent").alias("first_apply_credit_succ_time"),
                unless_negative("t_urgent_f").alias("first_apply_loan_succ_time"),
                F.when(k % 11 == 0, F.lit(None)).otherwise(k * 7 % 25).cast("int").alias("max_overdue_day_cnt"),
                F.when(k % 17 == 0, F.lit(None)).otherwise(F.coalesce(F.col("n_open"), F.lit(0)) % 3)
                .cast("int").alias("curr_inloan_cnt"),
                (k % 7).cast("int").alias("max_prepayment_day_cnt"),
                F.reverse(user_mobile(k)).alias("mobile_encode")))


def _calls(orders: DataFrame, lineitem: DataFrame, dt: Column, *extra: str) -> DataFrame:
    ln = F.col("l_linenumber")
    return (lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
            .select(
                mobile_of("o_custkey").alias("mobile"),
                F.when(ln == 7, F.concat(F.lit("0"), F.lpad(F.col("l_suppkey").cast("string"), 10, "0")))
                .otherwise(mobile_of("l_suppkey")).alias("other_mobile"),
                F.when(F.col("l_returnflag") == "R", F.lit("012001002"))
                .otherwise(F.lit("012001001")).alias("call_channel"),
                F.when(ln == 5, F.lit(None).cast("string")).when(ln == 6, F.lit("n/a"))
                .otherwise((F.col("l_quantity").cast("int") * 60).cast("string")).alias("call_time"),
                dt.alias("dt"), *extra))


def call_detail(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    return _calls(orders, lineitem, F.to_date("l_shipdate").cast("string"))


def call_detail_year(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Same calls with ``dt`` = first day of the ship year (one big day)."""
    return _calls(orders, lineitem, F.trunc("l_shipdate", "year").cast("string"))


def call_detail_dirty(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The same calls with the traps real records hold: on line 6 the other
    number has eight digits, and finished lines 4 that were not returned carry
    an unknown channel."""
    ln = F.col("l_linenumber")
    calls = _calls(orders, lineitem, F.to_date("l_shipdate").cast("string"),
                   "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus")
    short = F.concat(F.lit("1"), F.lpad(F.col("l_suppkey").cast("string"), 7, "0"))
    unknown = (ln == 4) & (F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "R")
    return calls.select("mobile", F.when(ln == 6, short).otherwise(F.col("other_mobile")).alias("other_mobile"),
                        F.when(unknown, F.lit("012001009")).otherwise(F.col("call_channel")).alias("call_channel"),
                        "call_time", "dt")


def repay_plan(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    d = F.datediff(F.col("l_shipdate"), F.col("o_orderdate"))
    return (lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").alias("loan_id"), F.col("o_custkey").alias("user_id"),
                F.col("c_mktsegment").alias("ds"),
                F.greatest(F.lit(0), 30 - d).cast("int").alias("early_day"),
                F.greatest(F.lit(0), d - 30).cast("int").alias("overdue_day"),
                F.when(F.col("l_linestatus") == "F", F.lit("002005002"))
                .otherwise(F.lit("002005001")).alias("repay_status"),
                F.col("o_orderdate").alias("create_time"), F.col("l_shipdate").alias("due_day"),
                F.lit(DAY).alias("dt")))


def collection_record(orders: DataFrame, customer: DataFrame) -> DataFrame:
    fraud = (F.col("o_totalprice") > 450000) & (F.col("o_orderpriority") == "5-LOW")
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").alias("loan_id"), F.col("c_mktsegment").alias("ds"),
                F.when(fraud, F.lit(FRAUD))
                .otherwise(F.lit("OTHER")).alias("loan_name"),
                F.lit(DAY).alias("dt")))


def third_party_blacklist(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    stale = (F.col("c_nationkey") != 3) | (k % 5 == 4)
    return customer.select(mobile_of(k).alias("mobile"), _day_unless(stale).alias("dt"))


def credit_apply(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_custkey").alias("user_id"), F.col("c_mktsegment").alias("ds"),
                    F.col("o_orderdate").alias("apply_time"), F.lit(DAY).alias("dt")))


def rank_score(customer: DataFrame, contact: DataFrame) -> DataFrame:
    return (customer.join(contact, customer["c_custkey"] == contact["user_id"])
            .select(F.col("mobile"), F.col("c_acctbal").alias("score")))


def decode_mobile(c: Column) -> Column:
    """The bindings encode a mobile by reversing its text."""
    return F.reverse(c)


# Logical tables and whether they are stored partitioned by day.
TABLES = {
    "user_contact": True, "user_profile": True, "call_detail": False, "call_detail_year": True,
    "repay_plan": True, "collection_record": True, "third_party_blacklist": True,
    "credit_apply": True, "rank_score": False,
}


def _schemas():
    from riskgraph.sources import tables as T
    return {"user_contact": T.USER_CONTACT, "user_profile": T.USER_PROFILE, "call_detail": T.CALL_DETAIL,
            "call_detail_year": T.CALL_DETAIL, "repay_plan": T.REPAY_PLAN,
            "collection_record": T.COLLECTION_RECORD, "third_party_blacklist": T.THIRD_PARTY_BLACKLIST,
            "credit_apply": T.CREDIT_APPLY, "rank_score": T.RANK_SCORE}


@dataclass
class Bindings:
    """Lazily built logical tables over one scale-factor folder.

    By default each table is derived from the raw parquet inside the query.
    The bindings ``store(...)`` returns read the same tables back from parquet
    written once, partitioned by ``dt`` like the production tables, so day filters
    prune folders and scans read only the columns a query uses.
    """

    spark: SparkSession
    sf_dir: str
    stored: str | None = None
    _cache: dict = field(default_factory=dict)

    def raw(self, name: str) -> DataFrame:
        key = ("raw", name)
        if key not in self._cache:
            self._cache[key] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[key]

    def _get(self, name, build):
        if name not in self._cache:
            if self.stored:
                self._cache[name] = self.spark.read.schema(_schemas()[name]).parquet(f"{self.stored}/{name}")
            else:
                self._cache[name] = build()
        return self._cache[name]

    @property
    def user_contact(self):
        return self._get("user_contact", lambda: user_contact(self.raw("customer")))

    @property
    def user_profile(self):
        return self._get("user_profile", lambda: user_profile(self.raw("customer"), self.raw("orders")))

    @property
    def call_detail(self):
        return self._get("call_detail", lambda: call_detail(self.raw("orders"), self.raw("lineitem")))

    @property
    def call_detail_year(self):
        return self._get("call_detail_year", lambda: call_detail_year(self.raw("orders"), self.raw("lineitem")))

    @property
    def call_detail_dirty(self):
        return call_detail_dirty(self.raw("orders"), self.raw("lineitem"))

    @property
    def repay_plan(self):
        return self._get("repay_plan", lambda: repay_plan(
            self.raw("orders"), self.raw("lineitem"), self.raw("customer")))

    @property
    def collection_record(self):
        return self._get("collection_record", lambda: collection_record(self.raw("orders"), self.raw("customer")))

    @property
    def third_party_blacklist(self):
        return self._get("third_party_blacklist", lambda: third_party_blacklist(self.raw("customer")))

    @property
    def credit_apply(self):
        return self._get("credit_apply", lambda: credit_apply(self.raw("orders"), self.raw("customer")))

    @property
    def rank_score(self):
        return self._get("rank_score", lambda: rank_score(self.raw("customer"), self.user_contact))


def store(spark: SparkSession, sf_dir: str, root: str) -> Bindings:
    """Write every logical table of ``sf_dir`` once under ``root`` and return
    bindings that read them.  Day-partitioned tables are written with one
    folder per ``dt``; the call history, which has one day per ship date, is
    range-partitioned and sorted on ``dt`` so the day filter skips row groups
    by their statistics instead."""
    derived = Bindings(spark, sf_dir)
    for name, by_day in TABLES.items():
        df = getattr(derived, name)
        path = f"{root}/{name}"
        if by_day:
            df.repartition("dt").write.mode("errorifexists").partitionBy("dt").parquet(path)
        elif "dt" in df.columns:
            df.repartitionByRange("dt").sortWithinPartitions("dt").write.mode("errorifexists").parquet(path)
        else:
            df.write.mode("errorifexists").parquet(path)
    return Bindings(spark, sf_dir, stored=root)
