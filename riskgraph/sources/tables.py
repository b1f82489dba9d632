"""Sources: day snapshots of partitioned tables, delimited text, literal tables.

The daily tables are partitioned by the day text column ``dt``; an equality or
range filter on it with a literal bound is pruned to the matching partitions
by Spark's file index, so a snapshot reads one folder, not the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgraph.functions.exprs import day_text

DAY_COL = "dt"

# Logical table schemas (all columns nullable).
USER_PROFILE = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ds", T.StringType()),
    T.StructField("dt", T.StringType()),
    T.StructField("first_apply_credit_time", T.TimestampNTZType()),
    T.StructField("first_apply_credit_succ_time", T.TimestampNTZType()),
    T.StructField("first_apply_loan_succ_time", T.TimestampNTZType()),
    T.StructField("max_overdue_day_cnt", T.IntegerType()),
    T.StructField("curr_inloan_cnt", T.IntegerType()),
    T.StructField("max_prepayment_day_cnt", T.IntegerType()),
    T.StructField("mobile_encode", T.StringType()),
])
USER_CONTACT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ds", T.StringType()),
    T.StructField("dt", T.StringType()),
    T.StructField("mobile", T.StringType()),
])
CALL_DETAIL = T.StructType([
    T.StructField("mobile", T.StringType()),
    T.StructField("other_mobile", T.StringType()),
    T.StructField("call_channel", T.StringType()),
    T.StructField("call_time", T.StringType()),
    T.StructField("dt", T.StringType()),
])
CREDIT_APPLY = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ds", T.StringType()),
    T.StructField("apply_time", T.TimestampNTZType()),
    T.StructField("dt", T.StringType()),
])
REPAY_PLAN = T.StructType([
    T.StructField("loan_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("ds", T.StringType()),
    T.StructField("early_day", T.IntegerType()),
    T.StructField("overdue_day", T.IntegerType()),
    T.StructField("repay_status", T.StringType()),
    T.StructField("create_time", T.TimestampNTZType()),
    T.StructField("due_day", T.TimestampNTZType()),
    T.StructField("dt", T.StringType()),
])
COLLECTION_RECORD = T.StructType([
    T.StructField("loan_id", T.LongType()),
    T.StructField("ds", T.StringType()),
    T.StructField("loan_name", T.StringType()),
    T.StructField("dt", T.StringType()),
])
THIRD_PARTY_BLACKLIST = T.StructType([
    T.StructField("mobile", T.StringType()),
    T.StructField("dt", T.StringType()),
])
RANK_SCORE = T.StructType([
    T.StructField("mobile", T.StringType()),
    T.StructField("score", T.DoubleType()),
])
# Loan lines written by the overdue job: the first five fields are used.
OVERDUE_LINE = T.StructType([
    T.StructField("loan_id", T.LongType()),
    T.StructField("ds", T.StringType()),
    T.StructField("mobile", T.StringType()),
    T.StructField("early_day", T.IntegerType()),
    T.StructField("overdue_day", T.IntegerType()),
])


def snapshot(df: DataFrame, day, col: str = DAY_COL) -> DataFrame:
    """The rows of one day (``dt = day``)."""
    return df.filter(F.col(col) == F.lit(day_text(day)))


def history(df: DataFrame, before, col: str = DAY_COL) -> DataFrame:
    """Every day strictly before ``before`` (``dt < before``, as text)."""
    return df.filter(F.col(col) < F.lit(day_text(before)))


BUCKET_ROWS = 1 << 20  # rows a bucket holds on average, at most


def buckets_for(df: DataFrame, least: int = 8) -> int:
    """Buckets for the counted rows of ``df``: one task writes, sums and joins a
    whole bucket, so their number grows with the rows.  A power of two, so that
    tables of the same key stay alike."""
    return max(least, 1 << max(0, -(-df.count() // BUCKET_ROWS) - 1).bit_length())


def store_bucketed(df: DataFrame, table: str, buckets: int, by: str = "mobile", path: str | None = None,
                   partition_by=()) -> DataFrame:
    """Store ``df`` as catalog table ``table`` in ``buckets`` buckets of ``by``
    and read it back.  Joins and aggregations on ``by`` (and on more columns
    with it) then run without a shuffle of these rows.  Each bucket is written
    by one task, one file per value of ``partition_by`` (e.g. the month)."""
    writer = (df.repartition(buckets, by).write.format("parquet").mode("errorifexists")
              .bucketBy(buckets, by).sortBy(by))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def parse_delimited(df: DataFrame, schema: T.StructType, col: str = "value", sep: str = ",") -> DataFrame:
    """Text column split by position into typed columns.

    Field ``i`` of each line becomes column ``i`` of ``schema``; later fields
    are ignored.  A short line or a field that is not of its type fails the
    job, whatever the session's ANSI setting.  No quoting is interpreted: the
    separator always splits.
    """
    parts = F.split(F.col(col), sep, -1)

    def bad(i):
        return F.raise_error(F.concat(F.lit(f"field {i + 1} of a line cannot be read: "), F.col(col)))

    def field(i, kind):
        text = F.get(parts, F.lit(i))
        value = text if isinstance(kind, T.StringType) else text.try_cast(kind)
        return F.when(value.isNull(), bad(i).cast(kind)).otherwise(value)

    whole = df.filter(F.col(col).isNotNull())
    return whole.select(*[field(i, f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def read_delimited(spark: SparkSession, path, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Delimited text files as typed columns (see ``parse_delimited``)."""
    return parse_delimited(spark.read.text(path), schema, sep=sep)


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """An in-memory table (tests and small parameters only)."""
    return spark.createDataFrame(list(rows), schema)


def register(df: DataFrame, name: str) -> DataFrame:
    """Name an intermediate result for later SQL."""
    df.createOrReplaceTempView(name)
    return df
