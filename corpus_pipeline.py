"""The training-data pipeline: a list of stages, each an operator of the llm subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pdloom.llm.common import stored, table
from pdloom.llm.stages import STAGES  # noqa: F401

#: SQL can't express the classifier, the retrieval and the tokenizer; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on what the one before it stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
