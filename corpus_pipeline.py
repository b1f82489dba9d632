"""A training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs.  All stages but the last
return the columns of ``documents``; the last returns packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskgraph.llm.common import prepare, stored
from riskgraph.llm.decontaminate import decontamination_stage
from riskgraph.llm.jaccard import near_duplicate_stage
from riskgraph.llm.language import language_stage
from riskgraph.llm.packing import packing_stage
from riskgraph.llm.secretscan import secrets_stage

STAGES = [
    ("language_id", language_stage),
    ("jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("best_fit_packing", packing_stage),
]

# Language scores and best-fit packing have no SQL form; the stages are tested
# one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
