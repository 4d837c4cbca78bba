"""The corpus pipeline: five operators in a row over the table documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows
as Parquet in the shared folder and reads them again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweave.llm import decontamination, mixing, near_dedup, pii, quality_rules
from logweave.llm.common import read, written

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_dedup", near_dedup.stage),
    ("decontamination", decontamination.stage),
    ("pii", pii.stage),
    ("mixing", mixing.stage),
]

#: Stages such as compression ratios can't be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
