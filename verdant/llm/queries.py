"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm import (decontaminate, html_main, language_id, lexical_search, license_scan, line_dedup,
                         ngram_jaccard, packing, quality_model, quality_rules, secret_scan, vector_search, whitening)
from verdant.llm.common import read_table
from verdant.llm.sql import ORACLE_SQL  # noqa: F401 - registered beside QUERIES


# the vocabulary of byte_bpe_50k.json as ranks
TOKENIZER = "byte_bpe_50k.tiktoken"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a tree of files: ``source/lang/shard/<doc_id>.txt``.

    A document whose first or last non-blank line is a licence notice is, by a
    hash of its id, the LICENSE file of its source, of its language or of its
    shard, or (one in four) an ordinary file with a notice of its own."""
    docs = read_table(spark, sf_dir, "documents")
    body = F.lower(F.btrim("text", F.lit(" \t\n\r\f\v")))
    notice = F.substring_index(body, "\n", 1).rlike("licen[cs]e") | F.substring_index(body, "\n", -1).rlike("licen[cs]e")
    level = F.when(notice, F.pmod(F.xxhash64("doc_id"), F.lit(4)))
    path = F.concat_ws("/", "source", F.when(level.isNull() | (level != 0), F.col("lang")),
                       F.when(level.isNull() | (level > 1), F.floor(F.col("doc_id") / 500).cast("string")),
                       F.when(level < 3, F.concat(F.lit("LICENSE-"), F.col("doc_id").cast("string")))
                       .otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op5_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(read_table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.duplicate_lines(read_table(spark, sf_dir, "documents"), min_chars=0)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return vector_search.search(rows, rows.where(F.col("vec_id") % 100 == 0))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_ngram_jaccard, op3_decontaminate, op4_quality_rules, op5_html_main, op6_secret_scan,
    op7_language_id, op8_quality_model, op9_line_dedup, op10_packing, op11_vector_search, op12_whitening,
    op13_lexical_search)}
