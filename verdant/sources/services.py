"""Schemas of the service dumps that stand in for network look-ups
(SRC4-SRC8).  The flattening logic lives with the operators that use it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType)

MATCH_SCHEMA = StructType([
    StructField("name_key", StringType()),
    StructField("usageKey", LongType()), StructField("acceptedUsageKey", LongType()),
    StructField("scientificName", StringType()), StructField("accepted", StringType()),
    StructField("rank", StringType()), StructField("status", StringType()),
    StructField("matchType", StringType()), StructField("confidence", IntegerType()),
    StructField("kingdom", StringType()), StructField("family", StringType()),
    StructField("genus", StringType()),
])

CHECKLIST_SCHEMA = StructType([
    StructField("page_no", LongType()), StructField("count", LongType()),
    StructField("results", ArrayType(StructType([
        StructField("kingdom", StringType()), StructField("nubKey", LongType()),
        StructField("scientificName", StringType()), StructField("canonicalName", StringType()),
    ]))),
])

_VALUE = StructType([StructField("value", StringType())])
FILES_SCHEMA = StructType([
    StructField("title", StringType()),
    StructField("imageinfo", ArrayType(StructType([
        StructField("thumburl", StringType()), StructField("url", StringType()),
        StructField("descriptionurl", StringType()),
        StructField("extmetadata", StructType([
            StructField("LicenseShortName", _VALUE), StructField("Artist", _VALUE)])),
    ]))),
])

OCCURRENCE_SCHEMA = StructType([
    StructField("taxon_key", LongType()),
    StructField("results", ArrayType(StructType([
        StructField("references", StringType()),
        StructField("media", ArrayType(StructType([
            StructField("identifier", StringType()), StructField("license", StringType()),
            StructField("rightsHolder", StringType()), StructField("creator", StringType()),
        ]))),
    ]))),
])

PAIRS_SCHEMA = StructType([StructField("n", StringType()), StructField("img", StringType())])


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Line-delimited JSON dump with a fixed schema."""
    return spark.read.schema(schema).json(path)
