"""Snapshot and list readers (SRC1-SRC3, SRC10, SRC11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType, MapType,
                               StringType, StructField, StructType)

RECORD_SCHEMA = StructType([
    StructField("source", StringType()), StructField("source_id", StringType()),
    StructField("url", StringType()), StructField("scraped_at", DateType()),
    StructField("name_he", StringType()), StructField("name_lat", StringType()),
    StructField("fields", MapType(StringType(), StringType())),
])

SELLER_SCHEMA = StructType([
    StructField("source", StringType()), StructField("source_id", StringType()),
    StructField("url", StringType()), StructField("category", StringType()),
    StructField("scraped_at", DateType()), StructField("name_he", StringType()),
    StructField("price", DoubleType()), StructField("currency", StringType()),
    StructField("pot_sizes", ArrayType(StringType())), StructField("availability", StringType()),
])

LABELLED_SCHEMA = StructType([
    StructField("id", IntegerType()), StructField("input_name", StringType()),
    StructField("input_lang", StringType()), StructField("category", StringType()),
    StructField("expected_bucket", StringType()), StructField("note", StringType()),
])


def read_records(spark: SparkSession, glob: str, lines: bool = False) -> DataFrame:
    """SRC1: every dated snapshot with its path: one JSON document a file, or (``lines``)
    one a line, as :func:`verdant.plans.publish.write_json` writes many records."""
    return (spark.read.schema(RECORD_SCHEMA).option("multiLine", not lines).json(glob)
                 .withColumn("path", F.col("_metadata.file_path")))


def read_seller_records(spark: SparkSession, glob: str, lines: bool = False) -> DataFrame:
    """SRC2."""
    return spark.read.schema(SELLER_SCHEMA).option("multiLine", not lines).json(glob)


def read_list_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC3 input: the lines (``value``) of a list file without its header.

    The JVM reader drops each file's first line; a separator and a quote that
    no text holds leave the lines whole."""
    return (spark.read.schema("value string").option("header", True).option("enforceSchema", True)
                 .option("sep", "\u0001").option("quote", "\u0000").option("escape", "\u0000").csv(path))


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: the labelled resolver test set."""
    return spark.read.schema(LABELLED_SCHEMA).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """SRC10: scan a published Parquet table and optionally register a view."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df
