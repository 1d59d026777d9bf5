"""Corpus pipeline: quality filter, line dedup, n-gram Jaccard join, benchmark
decontamination and mixing, each stage on all that its predecessor kept.

``run(spark, sf_dir)`` applies ``STAGES`` to ``documents``; every stage's rows
are written as Parquet into the shared checkpoint folder and read again, so a
lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vertexrank.llm import stages
from vertexrank.llm.common import read_table, scratch_folder

STAGES = [
    ("quality_filter", stages.quality_filter),
    ("line_dedup", stages.line_dedup),
    ("ngram_join", stages.ngram_join),
    ("decontaminate", stages.decontaminate),
    ("mix", stages.mix),
]

# The classifier, the hashed line dedup and the Newton iterations are beyond SQL;
# tests/llm compares the pipeline with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
