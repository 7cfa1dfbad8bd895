"""Table comparison as a job (GAT6): order-free multiset digests in two levels.

A row's digest is a 64-bit hash of its columns (by name, nulls marked).  Rows are
dealt by their digest to :data:`WIDTH` buckets; a bucket's digest is the count and
the sum of its rows' second hashes, which does not depend on order and counts
repeated rows.  Where a bucket differs between the tables, its rows are dealt to
WIDTH finer buckets, and only rows of finer buckets that differ are compared as
rows.  Equal tables cost one aggregate a side (combined map-side, WIDTH rows a
side); what reaches the driver are bucket numbers, at most WIDTH and WIDTH squared
/ :data:`LISTED` of them, else a join replaces the list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 1024
LISTED = 4096


def _hashes(df: DataFrame) -> DataFrame:
    """The table with a row's places and its digest."""
    cols = sorted(df.columns)
    parts = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    h = F.xxhash64(*parts)
    return df.select(*cols, F.pmod(h, F.lit(WIDTH)).cast("int").alias("_b1"),
                     F.pmod(F.shiftright(h, 20), F.lit(WIDTH)).cast("int").alias("_b2"),
                     F.xxhash64(F.lit(7), *parts).alias("_h"))


def digests(rows: DataFrame, *places: str) -> DataFrame:
    """Count and sum of digests by place."""
    return rows.groupBy(*places).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("s"))


def _differing(a: DataFrame, b: DataFrame, *places: str) -> DataFrame:
    """The places whose digests differ: one aggregate over the union of both sides."""
    both = digests(a, *places).withColumn("sign", F.lit(1)).unionByName(digests(b, *places).withColumn("sign", F.lit(-1)))
    return (both.groupBy(*places).agg(F.sum(F.col("n") * F.col("sign")).alias("n"), F.sum(F.col("s") * F.col("sign")).alias("s"))
            .where("n != 0 or s != 0").select(*places))


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows whose number differs, with ``n_left`` and ``n_right``; both tables have the
    same columns, in any order."""
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"other columns: {sorted(set(left.columns) ^ set(right.columns))}")
    cols = sorted(left.columns)
    a, b = _hashes(left), _hashes(right)
    coarse = [r["_b1"] for r in _differing(a, b, "_b1").collect()]                    # at most WIDTH
    in_coarse = F.col("_b1").isin(coarse) if coarse else F.lit(False)
    a, b = a.where(in_coarse), b.where(in_coarse)
    if coarse:
        fine = _differing(a, b, "_b1", "_b2")
        listed = fine.limit(LISTED + 1).collect()
        if len(listed) <= LISTED:
            places = [r["_b1"] * WIDTH + r["_b2"] for r in listed]
            keep = (F.col("_b1") * WIDTH + F.col("_b2")).isin(places)
            a, b = a.where(keep), b.where(keep)
        else:
            a, b = (x.join(fine, ["_b1", "_b2"], "left_semi") for x in (a, b))
    both = a.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        b.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    return (both.groupBy(*cols).agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
            .where("n_left != n_right"))


def equal(left: DataFrame, right: DataFrame) -> bool:
    """True if both hold the same rows as often, by digests alone: one aggregate a side."""
    return not _differing(_hashes(left), _hashes(right), "_b1").take(1)
