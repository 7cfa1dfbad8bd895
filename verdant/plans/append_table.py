"""Append-only tables whose commits are idempotent by batch id.

A batch is written to ``<base>/<name>/data/order=<n>/batch=<id>/attempt=<uuid>``
and then named by one small commit file under ``<base>/<name>/commits``.  Rows
without a commit file are never read, so a failed attempt leaves nothing
behind.  A batch that is already committed is refused before its plan runs; if
two attempts of one batch commit at the same time, every reader takes the same
one (least order, then attempt).  Nothing is overwritten or deleted.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType


@dataclass(frozen=True, order=True)
class Commit:
    order: int
    attempt: str
    batch: str
    path: str


def read_lines(spark: SparkSession, folder: str) -> list[str]:
    """The lines of all small files below ``folder``; none if it is not there."""
    try:
        return [r.value for r in spark.read.text(f"{folder}/*").collect()]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def write_line(spark: SparkSession, path: str, line: str) -> None:
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("errorifexists").text(path)


class AppendTable:
    """One append-only table of rows of ``schema``."""

    def __init__(self, spark: SparkSession, base: str, name: str, schema: StructType,
                 partition_by: tuple[str, ...] = ()):
        self.spark, self.home = spark, f"{base.rstrip('/')}/{name}"
        self.schema, self.partition_by = schema, partition_by

    def commits(self) -> list[Commit]:
        """The commits that count, in order: one a batch."""
        first: dict[str, Commit] = {}
        for line in read_lines(self.spark, f"{self.home}/commits"):
            order, attempt, batch, path = line.split("\t")
            c = Commit(int(order), attempt, batch, path)
            first[batch] = min(c, first.get(batch, c))
        return sorted(first.values())

    def commit(self, df: DataFrame, batch: str, order: int | None = None) -> bool:
        """Append ``df`` as ``batch``; False (and no work) if that batch is there."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"a batch id of letters, digits, '.', '_' and '-': {batch!r}")
        if any(c.batch == batch for c in self.commits()):
            return False
        order, attempt = time.time_ns() if order is None else order, uuid.uuid4().hex[:12]
        path = f"{self.home}/data/order={order}/batch={batch}/attempt={attempt}"
        w = df.select(*self.schema.fieldNames()).write.mode("errorifexists")
        (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(path)
        write_line(self.spark, f"{self.home}/commits/{batch}-{attempt}", f"{order}\t{attempt}\t{batch}\t{path}")
        return True

    def read(self, batches: set[str] | None = None) -> DataFrame:
        """Committed rows with their ``order`` and ``batch`` (of all batches, or of
        some).  The files are fixed when this is called: later commits do not
        show in a plan made earlier."""
        paths = [c.path for c in self.commits() if batches is None or c.batch in batches]
        full = StructType([*self.schema.fields, StructField("order", LongType()), StructField("batch", StringType()),
                           StructField("attempt", StringType())])
        if not paths:
            return self.spark.createDataFrame([], full).drop("attempt")
        return (self.spark.read.schema(full).option("basePath", f"{self.home}/data").parquet(*paths)
                .select(*self.schema.fieldNames(), "order", "batch"))

    def first_wins(self, *key: str) -> DataFrame:
        """One row a key: that of the earliest batch (an aggregate, combined map-side)."""
        rest = [c for c in self.schema.fieldNames() if c not in key]
        return (self.read().groupBy(*key).agg(F.min_by(F.struct(*rest, "batch"), F.struct("order", "batch")).alias("_f"))
                .select(*key, "_f.*"))
