"""Shared helpers of the operators: tables, stored intermediates, sized broadcasts."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgraph.session import ensure_checkpoint_dir

# Largest side that is broadcast, in bytes of its rows as counted by
# ``small_side``; beyond it the same join runs as a shuffle join.
BROADCAST_BYTES = 32 << 20


def ship(module_name: str) -> None:
    """Send a module's functions to Python workers by value, so that tasks do
    not depend on the workers' import path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: small Arrow batches keep Python
    workers to a few tens of MB whatever the row width."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Stored tables of this process that have not been emptied: path and schema.
_STORED: dict[str, T.StructType] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it
    back: lineage is cut, and the rows outlive the executors that made them."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    _STORED[path] = df.schema
    return out


def _empty(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], _STORED.pop(path)).write.mode("overwrite").parquet(path)


def discard(*tables: DataFrame) -> None:
    """Empty stored tables that nothing reads any more: every table made from
    them is itself stored, so no lost executor can ask for them again."""
    for df in tables:
        _empty(df.sparkSession, df.stored_path)


def cleanup(spark: SparkSession) -> int:
    """Empty all stored tables of this process that are left, such as those a
    result still reads; for callers that have used their results.  Returns
    their number."""
    paths = list(_STORED)
    for path in paths:
        _empty(spark, path)
    return len(paths)


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is within ``limit``.
    ``df`` must be cheap to count (a stored table)."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def _octets(c: Column, kind: T.DataType) -> Column:
    """Bytes a value takes in a broadcast, null as none."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c).cast("long"), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
            one = F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + _octets(x, kind.elementType))
            return F.coalesce(one, F.lit(0)) + 16
        return F.coalesce(F.size(c), F.lit(0)).cast("long") * 8 + 16
    if isinstance(kind, T.StructType):
        return sum((_octets(c.getField(f.name), f.dataType) for f in kind.fields), F.lit(8).cast("long"))
    return F.lit(8).cast("long")


def measured_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if the bytes of its rows, summed over all
    of them, are within ``limit``; beyond it the join shuffles.  ``df`` must
    be cheap to read (a stored table)."""
    width = sum((_octets(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(32).cast("long"))
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= limit else df


def measured_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join of ``left`` with ``right`` (a stored table), broadcast if its
    measured size allows and merged beyond it.  The hint is needed: Spark's own
    estimate is the size of compressed files, which says little of the rows."""
    side = measured_side(right)
    return left.join(side if side is not right else right.hint("merge"), on, how)


SALT = 32


def salted_join(left: DataFrame, right: DataFrame, key: str, by: str, how: str = "inner", parts: int = SALT) -> DataFrame:
    """Join of ``left`` with ``right`` (a stored table with one row a key) on
    ``key``.  A right side of measured size is broadcast; else every key of
    ``left`` is split into ``parts`` by a hash of its column ``by`` and the right
    rows are copied to each, so a key with a third of all rows meets its row in
    many tasks.  Spark's estimate does not count the copies, nor rows that
    ``left`` has exploded, so the merge is asked for."""
    side = measured_side(right)
    if side is not right:
        return left.join(side, key, how)
    x = left.withColumn("__part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    y = right.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return x.join(y.hint("merge"), [key, "__part"], how).drop("__part")
