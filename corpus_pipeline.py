"""A corpus pipeline of five stages; each stage's output is a Parquet table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm.frames import table, written
from cadenza.llm.langid import language_stage
from cadenza.llm.mixing import mixing_stage
from cadenza.llm.ngram_join import near_duplicate_stage
from cadenza.llm.secrets import redacted
from cadenza.llm.sentencepieces import sentencepiece_stage


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    return redacted(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: SQL can express neither the profiles of the first stage nor the sampling of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
