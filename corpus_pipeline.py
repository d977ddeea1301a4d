"""The corpus pipeline: stages over ``documents``, each stored and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayline.llm import stages
from wayline.llm.common import stored, table

STAGES = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("source_mix", stages.source_mix),
]

#: Kernels, signatures and template trees are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
