"""Text sinks: line formats of the graph loader and the ranking step.

Every writer takes a DataFrame with one string column ``line``, drops null
lines (a text file cannot hold them) and writes one file per partition.  The
default save mode refuses an existing path, like the source jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.functions.exprs import EDGE_LABEL, day_text, two_decimals
from riskgraph.session import cut_lineage

ONE_FILE_CONF = "riskgraph.oneFileBytes"
ONE_FILE_BYTES = 1 << 30


def dated_path(base: str, day, name: str) -> str:
    """K3: ``<base>/<day>/<name>``."""
    return f"{base.rstrip('/')}/{day_text(day)}/{name}"


def write_lines(df: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists",
                col: str = "line") -> None:
    """K1/K2: write the ``line`` column as text.

    ``single_file=True`` writes one file: everything upstream (including any
    distinct) runs in parallel, the finished lines are written to the checkpoint
    folder and their bytes are summed there, and only then one task gathers
    them.  More than ``riskgraph.oneFileBytes`` (1 GB by default) is refused
    before anything is written to ``path``.
    """
    out = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull())
    if single_file:
        out = one_task(out)
    out.write.mode(mode).text(path)


def one_task(lines: DataFrame) -> DataFrame:
    """A one-column text table in one partition, if its measured size allows."""
    kept = cut_lineage(lines)
    size = kept.agg(F.sum(F.octet_length(kept.columns[0]).cast("long") + 1)).first()[0] or 0
    limit = int(kept.sparkSession.conf.get(ONE_FILE_CONF, str(ONE_FILE_BYTES)))
    if size > limit:
        raise ValueError(f"a single file of {size} bytes is over {ONE_FILE_CONF} ({limit}): "
                         "write many files (single_file=False) or raise the limit")
    return kept.repartition(1)


def format_edge_line(edges: DataFrame) -> DataFrame:
    """K4: ``src,dst,CALL_OUT,calls,mean`` with the mean to two decimals."""
    return edges.select(F.concat_ws(",", "src", "dst", F.lit(EDGE_LABEL), F.col("calls").cast("string"),
                                    two_decimals("mean_duration")).alias("line"))


def format_pair_line(edges: DataFrame) -> DataFrame:
    """K5: ``src,dst``."""
    return edges.select(F.concat_ws(",", "src", "dst").alias("line"))


def format_adjacency_line(adj: DataFrame) -> DataFrame:
    """K6: ``mobile<TAB>n1<TAB>n2...`` from (mobile, neighbours)."""
    return adj.select(F.concat_ws("\t", F.col("mobile"), F.col("neighbours")).alias("line"))


def format_overdue_line(df: DataFrame) -> DataFrame:
    """K7: ``loan_id,ds,mobile,early_day,overdue_day``; a null number is
    written as 0 and a null text as ``null``."""
    def num(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("0"))

    def txt(c):
        return F.coalesce(F.col(c), F.lit("null"))

    return df.select(F.concat_ws(",", num("loan_id"), txt("ds"), txt("mobile"),
                                 num("early_day"), num("overdue_day")).alias("line"))


def format_score_line(df: DataFrame) -> DataFrame:
    """K8: ``score,overdue`` with the score in the JVM's double text form."""
    return df.select(F.concat_ws(",", F.col("score").cast("string"),
                                 F.coalesce(F.col("overdue_day").cast("string"), F.lit("0"))).alias("line"))


def format_mobile_line(df: DataFrame, col: str = "mobile") -> DataFrame:
    """A list of mobiles, one per line."""
    return df.select(F.col(col).alias("line"))
