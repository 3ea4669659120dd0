"""A corpus pipeline: quality, near duplicates, repeated paragraphs, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and is
written as Parquet and read back before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import stages
from tapeloom.llm.frames import stored, table

STAGES = [
    ("quality", stages.good_quality),
    ("near_duplicates", stages.one_of_near_duplicates),
    ("paragraphs", stages.without_repeated_paragraphs),
    ("decontamination", stages.without_benchmark),
    ("tokens", stages.tokens),
]

#: The stages fit models, verify edit distances and encode, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
