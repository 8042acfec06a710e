"""A training-data pipeline over ``documents``: quality filter, near duplicates, benchmark
decontamination, secret redaction, mixing to target weights.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns
a DataFrame; ``run`` writes each result as Parquet to the shared work folder and reads it
back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loamflow.llm import stages
from loamflow.llm.common import materialize, table

STAGES = [
    ("quality", stages.quality),
    ("near_duplicates", stages.near_duplicates),
    ("decontaminate", stages.decontaminate),
    ("redact_secrets", stages.redact_secrets),
    ("mix", stages.mix),
]

#: Training, tiling and decoding have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
