"""File compaction (SNK1, SNK8): many small files into few of a target size.

The live version of a table is rewritten as a new version and the pointer is
swapped last (:mod:`verdant.plans.publish`): readers that hold the old version
stay on its files, which are not touched, and a failed run leaves it live.

Each partition folder gets as many bins as its bytes fill; a row's bin comes from
a hash of the row, and all rows of a bin meet in one task, which writes one file.
So a folder has at most ``ceil(bytes / target)`` files, and a folder that holds
most of the table is written by as many tasks as it has bins.  A task holds the rows
of one bin, or few, so it writes with open files instead of sorting its rows by folder
(:data:`OPEN_FILES`): what it holds does not grow with the bin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.plans import publish as P

TARGET_BYTES = 256 * 1024 ** 2
OPEN_FILES = 8          # folders that a task writes at once; the rows of further ones are sorted
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def files(spark: SparkSession, path: str) -> DataFrame:
    """``(folder, path, length)`` of a version's data files; their content is not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    name = F.substring_index("path", "/", -1)
    return f.where(~name.startswith("_") & ~name.startswith(".")).select(
        F.expr("substring(path, 1, char_length(path) - char_length(substring_index(path, '/', -1)) - 1)").alias("folder"),
        "path", "length")


def compact(spark: SparkSession, base: str, name: str, partition_by: list[str] | None = None, fmt: str = "parquet",
            schema=None, target_bytes: int = TARGET_BYTES) -> str:
    """Rewrite the live version of ``name`` and repoint; the new version's path."""
    old = P.current_path(spark, base, name)
    bins = (files(spark, old).groupBy("folder").agg(F.sum("length").alias("bytes"))
            .select("folder", F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int").alias("bins")))
    rows = P.read_current(spark, base, name, fmt, schema)
    own = F.expr("regexp_replace(_metadata.file_path, '/[^/]*$', '')")
    bare = F.regexp_replace("folder", "^[a-z]+:/+", "/")              # both listings, without their scheme
    placed = rows.withColumn("_folder", F.regexp_replace(own, "^[a-z]+:/+", "/")).join(
        bins.select(bare.alias("_folder"), "bins"), "_folder")
    salt = F.pmod(F.xxhash64(*rows.columns), F.col("bins")).alias("_bin")
    placed = placed.select(*rows.columns, "_folder", salt).repartition("_folder", "_bin").drop("_folder", "_bin")
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(OPEN_FILES))
    try:
        return P.write_version(placed, base, name, fmt, partition_by)
    finally:
        spark.conf.set(WRITERS, before)
