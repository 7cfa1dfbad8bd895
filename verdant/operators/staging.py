"""Staging (STG1-STG3): records <-> entity-attribute-value rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.functions.text import record_json

EAV_COLUMNS = ["source", "source_id", "raw_name_he", "raw_name_lat",
               "attribute", "value", "raw_text", "scraped_at"]


def eav_from_records(records: DataFrame) -> DataFrame:
    """STG1: one row per (record, field); record columns repeated.

    ``records``: source, source_id, name_he, name_lat, fields map, scraped_at.
    A narrow map-side explode; partition the sink by source and date.
    """
    # the audit text is computed once per record, below the explode, not once
    # per exploded attribute
    per_record = records.select(
        "source", "source_id", F.col("name_he").alias("raw_name_he"),
        F.col("name_lat").alias("raw_name_lat"), "fields",
        record_json(F.col("fields")).alias("raw_text"),
        F.col("scraped_at").cast("date").alias("scraped_at"))
    return per_record.select(
        "source", "source_id", "raw_name_he", "raw_name_lat",
        F.explode("fields").alias("attribute", "value"), "raw_text", "scraped_at")


def records_from_table(df: DataFrame, source: str, id_col: str, name_he_col: str,
                       name_lat_col: str, attribute_cols: dict,
                       scraped_at=None) -> DataFrame:
    """A wide table as snapshot records: ``attribute_cols`` maps label -> column.

    Values are cast to text (schema-on-read staging).
    """
    entries = []
    for label, col in attribute_cols.items():
        entries += [F.lit(label), F.col(col).cast("string")]
    return df.select(
        F.lit(source).alias("source"), F.col(id_col).cast("string").alias("source_id"),
        F.col(name_he_col).cast("string").alias("name_he"),
        F.col(name_lat_col).cast("string").alias("name_lat"),
        F.create_map(*entries).alias("fields"),
        F.lit(scraped_at).cast("date").alias("scraped_at"))


def eav_unpivot(df: DataFrame, source: str, id_col: str, value_cols: list[str]) -> DataFrame:
    """STG1 for a wide table without a map column: ``DataFrame.unpivot``."""
    casted = df.select(F.lit(source).alias("source"),
                       F.col(id_col).cast("string").alias("source_id"),
                       *[F.col(c).cast("string").alias(c) for c in value_cols])
    return casted.unpivot(["source", "source_id"], value_cols, "attribute", "value")


def crosswalk(eav: DataFrame, source: str | None = None) -> DataFrame:
    """STG2: distinct (name_he, name_lat, source_id) with both names present."""
    src = F.lit(source) if source else F.col("source")
    return (eav.where(F.col("raw_name_he").isNotNull() & F.col("raw_name_lat").isNotNull())
               .select(F.col("raw_name_he").alias("name_he"), F.col("raw_name_lat").alias("name_lat"),
                       src.alias("source"), "source_id")
               .distinct())


def pivot_records(eav: DataFrame, labels: list[str]) -> DataFrame:
    """STG3: one row per source record with one column per requested label.

    First value per attribute by snapshot date, ties by value (a null last);
    the names come from the record's first row by (date, attribute, value, names).  The explicit label list turns the pivot into
    conditional aggregates in one pass (partial aggregation keeps hot records
    map-side).  Rows are dealt by record first: the aggregates hold texts, so each
    task sorts its rows, and a task of a scan may make any number of them from a
    small file.  The hint bounds a task's rows by size and splits a hot record's.
    """
    ordk = F.struct("scraped_at", "attribute", F.col("value").isNull().alias("none"), "value",
                    "raw_name_lat", "raw_name_he")
    aggs = [F.min_by(F.struct(F.col("raw_name_he").alias("name_he"),
                              F.col("raw_name_lat").alias("name_lat")), ordk).alias("_names"),
            F.min("scraped_at").alias("scraped_at")]
    for lab in labels:
        aggs.append(F.min_by(F.col("value"),
                             F.when(F.col("attribute") == lab, F.struct(
                                 "scraped_at", F.col("value").isNull().alias("none"), "value"))).alias(lab))
    dealt = eav.withColumn("_at", F.xxhash64("source", "source_id")).hint("rebalance", "_at")
    out = dealt.groupBy("source", "source_id").agg(*aggs)
    return out.select("source", "source_id", "scraped_at", "_names.name_he", "_names.name_lat",
                      *[F.col(f"`{lab}`") for lab in labels])
