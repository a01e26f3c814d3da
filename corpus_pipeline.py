"""The corpus pipeline: documents through language, quality and duplicate filters into packed sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridseries.llm import stages
from gridseries.llm.common import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", stages.keep_known_languages),
    ("quality_classifier", stages.keep_good_quality),
    ("ngram_jaccard_join", stages.keep_one_of_each_group),
    ("best_fit_packing", stages.pack_sequences),
]

#: The trained stages cannot be stated in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
