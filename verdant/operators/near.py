"""Strings within a few edits of each other, without pairs of merely similar ones.

Two strings within ``d`` edits (insertion, deletion, replacement, swap of neighbours)
become the same string when at most ``d`` characters are deleted from each: a
replacement and a swap cost one deletion on both sides, an insertion or deletion one
on one side.  So both sides are expanded to the hashes of what is left after up to
``d`` deletions and meet by equality.  However many names share a long first word,
only names that truly agree but for those characters meet.

The distances are tried one after the other, and a name that has found its nearest
asks no further: distance 2 (``n^2 / 2`` keys of a name of ``n`` characters) is paid
by the names that have nothing at distance 1.  Names beyond :data:`SHORT` characters
and distances above :data:`DELETED` meet by a caller's own keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT = 40
DELETED = 2


def deletions(col: str, d: int) -> Column:
    """Hashes of the strings left when up to ``d`` (at most 2) characters are deleted."""
    n, none = f"length({col})", "cast(array() AS array<bigint>)"
    sets = [f"array(xxhash64({col}))"]
    if d >= 1:
        sets.append(f"IF({n} >= 1, transform(sequence(1, {n}), i -> "
                    f"xxhash64(concat(substr({col}, 1, i - 1), substr({col}, i + 1)))), {none})")
    if d >= 2:
        left = f"concat(substr({col}, 1, i - 1), substr({col}, i + 1, j - i - 1), substr({col}, j + 1))"
        sets.append(f"IF({n} >= 2, flatten(transform(sequence(1, {n} - 1), i -> "
                    f"transform(sequence(i + 1, {n}), j -> xxhash64({left})))), {none})")
    return F.expr(f"array_distinct(concat({', '.join(sets)}))")


def _meet(asked: DataFrame, known: DataFrame, d: int, other: Callable[..., DataFrame]) -> DataFrame:
    """Distinct ``(q, b)`` that may be within ``d`` edits."""
    if d > DELETED:
        return other(asked, known, d)
    # few bytes, many keys: a number of partitions that is not coalesced by size
    width = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def keys(names: DataFrame, col: str) -> DataFrame:
        dealt = names.repartition(width, F.xxhash64(F.lit(d), col))
        return dealt.select(col, F.explode(deletions(col, d)).alias("h"))

    # known names of a length that an asked one may have: none where nothing is asked
    sizes = asked.select(F.explode(F.sequence(F.length("q") - d, F.length("q") + d)).alias("n")).distinct()
    known = known.join(F.broadcast(sizes), F.length("b") == F.col("n"), "left_semi")
    qs = keys(asked.where(F.length("q") <= SHORT + d), "q")
    bs = keys(known.where(F.length("b") <= SHORT), "b")
    short = qs.repartition(width, "h").join(bs.repartition(width, "h"), "h").select("q", "b").distinct()
    long = other(asked.where(F.length("q") > SHORT - d), known.where(F.length("b") > SHORT), d)
    return short.unionByName(long)


def nearest(asked: DataFrame, known: DataFrame, max_distance: int, distance: Callable[[DataFrame, int], DataFrame],
            other: Callable[[DataFrame, DataFrame, int], DataFrame],
            keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(q, b, d)``: for each distinct ``q`` of ``asked`` all the distinct ``b`` of ``known``
    that are nearest to it, within ``max_distance`` edits.

    ``distance(pairs, d)`` adds the exact distance ``d`` and keeps the pairs within ``d``;
    ``other(asked, known, d)`` gives the pairs of long names, or of great distances;
    ``keep`` (a written table) makes once what several steps read."""
    keep = keep or (lambda df: df)
    asked, known = keep(asked), keep(known)
    found = asked.join(known, F.col("q") == F.col("b")).select("q", "b", F.lit(0).alias("d"))
    out, left = found, asked.join(known, F.col("q") == F.col("b"), "left_anti")
    steps = range(1, max_distance + 1) if max_distance <= DELETED else [*range(1, DELETED + 1), max_distance]
    for i, d in enumerate(steps):
        if i:
            left = left.join(found.select("q").distinct(), "q", "left_anti")
        found = keep(distance(_meet(left, known, d, other), d))
        out = out.unionByName(found)
    least = out.groupBy("q").agg(F.min("d").alias("d"))
    return out.join(least, ["q", "d"]).select("q", "b", "d")
