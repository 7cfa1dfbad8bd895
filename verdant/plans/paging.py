"""Seek paging and global ranks (QRY9-QRY12).

* :func:`after` gives the rows that follow a given row in a sort order: a
  predicate on the sort columns, so that nothing which came before is sorted
  again, and a per-partition top-k for the page itself.
* :class:`Ordered` keeps a table in one sort order: dealt to ranges of the
  order, sorted within, each row numbered within its range; the ranges' counts,
  added up, are the offsets that make the numbers global ranks.  A page is a
  range of ranks, which file statistics narrow to the files that hold it.

An order is a list of :class:`Sort`; its last column must be unique (the key),
so the order is total.  Nulls come last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.plans import publish as P


@dataclass(frozen=True)
class Sort:
    col: str
    descending: bool = False

    @property
    def column(self) -> Column:
        c = F.col(self.col)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_last()


def by(order: list[Sort]) -> list[Column]:
    return [s.column for s in order]


def surface_order(sort: str) -> list[Sort]:
    """The surface's orders (QRY9) over the projected table."""
    if sort == "price":
        return [Sort("price_ils", True), Sort("name_he"), Sort("id")]
    return [Sort(sort), Sort("id")]


def follows(order: list[Sort], last: dict) -> Column:
    """True for rows after ``last`` (values of the order's columns)."""
    out, same = F.lit(False), F.lit(True)
    for s in order:
        c, v = F.col(s.col), last[s.col]
        if v is None:                                   # nulls are last: only equal ones are left
            beyond, equal = F.lit(False), c.isNull()
        else:
            beyond = (c < F.lit(v) if s.descending else c > F.lit(v)) | c.isNull()
            equal = F.coalesce(c == F.lit(v), F.lit(False))
        out, same = out | (same & F.coalesce(beyond, F.lit(False))), same & equal
    return out


def after(df: DataFrame, order: list[Sort], last: dict | None = None, limit: int = L.PAGE_SIZE) -> DataFrame:
    """The page of ``limit`` rows that follows ``last`` (the first page without it)."""
    rows = df if last is None else df.where(follows(order, last))
    return rows.orderBy(*by(order)).limit(limit)


def last_of(page: DataFrame, order: list[Sort]) -> dict | None:
    """The values to seek from after a page (one row reaches the driver); None after an empty page."""
    back = [F.col(s.col).asc_nulls_first() if s.descending else F.col(s.col).desc_nulls_first() for s in order]
    row = page.orderBy(*back).select(*dict.fromkeys(s.col for s in order)).first()
    return row.asDict() if row else None


class Ordered:
    """A table stored in one order with global ranks."""

    def __init__(self, spark: SparkSession, base: str, name: str):
        self.spark, self.base, self.name = spark, base, name

    def build(self, df: DataFrame, order: list[Sort], ranges: int | None = None) -> "Ordered":
        ranges = ranges or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        at = F.monotonically_increasing_id()
        dealt = (df.repartitionByRange(ranges, *by(order)).sortWithinPartitions(*by(order))
                 .withColumn("_part", F.shiftright(at, 33).cast("int")).withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1))))
        P.write_version(dealt, self.base, f"{self.name}_dealt")
        P.write_version(P.read_current(self.spark, self.base, f"{self.name}_dealt").groupBy("_part")
                        .agg(F.count(F.lit(1)).alias("n")), self.base, f"{self.name}_counts")
        return self

    def _offsets(self) -> list[tuple[int, int, int]]:
        """(range, rows before it, its rows), in order: a row a range, fixed when it was built."""
        out, before = [], 0
        counts = P.read_current(self.spark, self.base, f"{self.name}_counts")
        for part, n in sorted((r["_part"], r["n"]) for r in counts.collect()):
            out.append((part, before, n))
            before += n
        return out

    def ranked(self) -> DataFrame:
        """All rows with ``rank``, 1 for the first."""
        rows = P.read_current(self.spark, self.base, f"{self.name}_dealt")
        offsets = self.spark.createDataFrame([(p, b) for p, b, _ in self._offsets()], "_part int, _before long")
        return (rows.join(offsets, "_part").withColumn("rank", F.col("_before") + F.col("_at") + 1)
                .drop("_part", "_at", "_before"))

    def slice(self, first: int, last: int) -> DataFrame:
        """The rows of ranks ``first`` to ``last``: only their places are read."""
        rows = P.read_current(self.spark, self.base, f"{self.name}_dealt")
        cond = F.lit(False)
        rank = F.when(F.lit(False), F.lit(0).cast("long"))
        for part, before, n in self._offsets():
            lo, hi = max(first - 1 - before, 0), min(last - 1 - before, n - 1)
            if lo <= hi:
                cond = cond | ((F.col("_part") == part) & (F.col("_at") >= lo) & (F.col("_at") <= hi))
                rank = rank.when(F.col("_part") == part, F.col("_at") + (before + 1))
        return rows.where(cond).withColumn("rank", rank).drop("_part", "_at")

    def page(self, number: int, size: int = L.PAGE_SIZE) -> DataFrame:
        """Page ``number`` (from 1), with ranks."""
        return self.slice((number - 1) * size + 1, number * size)
