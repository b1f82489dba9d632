"""Session settings shared by tests, the bench and the query catalog.

On a cluster the session already exists and carries its own settings; the
helpers here only fill in what is missing (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans at runtime: it turns a
# sort-merge join into a broadcast join only after measuring the real size of
# the smaller side, splits skewed shuffle partitions and coalesces tiny ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}
# Of them, those that results depend on or that a running session may set.
RUNTIME_CONF = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
                "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")


def prepare(spark: SparkSession) -> None:
    """Settings that right answers need; a session that refuses them fails here."""
    for k in RUNTIME_CONF:
        spark.conf.set(k, BASE_CONF[k])


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "riskgraph", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests (``local[cores]``)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.driver.memory"] = os.environ.get("RISKGRAPH_DRIVER_MEMORY", "16g")
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    conf["spark.sql.shuffle.partitions"] = str(
        shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores)))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3, ...)
    and is used as is.  Only a local session without one gets a fresh
    temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="riskgraph-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and cut its lineage.

    Used where one intermediate feeds several outputs: the result survives
    the loss of the executors that computed it (unlike a local checkpoint
    or a plain cache).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
