"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join,
benchmark decontamination, packing.

``STAGES`` lists the stages; each takes the documents its predecessor kept and
all but the last return the columns of ``documents``.  :func:`run` writes each
stage's result as Parquet to the shared folder and reads it back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from verdant.llm import decontaminate, line_dedup, ngram_jaccard, packing, quality_rules
from verdant.llm.common import read_table, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of near-duplicate lines stays; a document all of
    whose words went with its lines goes."""
    return line_dedup.dedup_lines(docs, drop_emptied=True, min_chars=0)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a Jaccard of 0.8 over five-word
    shingles stays (op2's own contract of four words and 0.85 binds op2 only)."""
    return ngram_jaccard.keep_one(docs, num=80, den=100, words=5)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_jaccard", near_copies),
          ("decontamination", benchmark), ("packing", packed)]
ORACLE_SQL = None        # SQL cannot express MinHash candidates, CGK walks or the linear program


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
