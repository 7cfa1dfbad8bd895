"""Homonyms and transposed letters (RES8, RES4).

* :func:`match_near` finds backbone names within ``max_distance`` edits, where a
  swapped pair of letters is *one* edit (Damerau-Levenshtein).  Names meet by what
  is left after deletions (:mod:`verdant.operators.near`); long names, and names more
  than two edits away, by segments: an edit touches at most two neighbouring segments
  of a name cut into ``2 k + 1`` even segments, so one segment stays whole, shifted by
  at most ``k`` places, and a query probes ``(2 k + 1)^3`` keys, whatever its length.
  Pairs that meet are bounded by ``levenshtein`` (a swap is two of its edits) and
  decided by the exact distance.
* :func:`choose` picks among several backbone rows of one name by context: family
  first, then kingdom, then accepted before synonym, then the lowest key; the
  number of rows that fit the context equally well is reported.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from verdant.functions.text import normalize_name
from verdant.operators.near import nearest


def damerau(a: str, b: str) -> int:
    """Damerau-Levenshtein distance (adjacent swaps, also around other edits)."""
    last: dict[str, int] = {}
    far = len(a) + len(b)
    d = [[far] * (len(b) + 2)] + [[far, i, *[0] * len(b)] for i in range(len(a) + 1)]
    d[1] = [far, *range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        seen = 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), seen
            seen = j if x == y else seen
            d[i + 1][j + 1] = min(d[i][j] + (x != y), d[i + 1][j] + 1, d[i][j + 1] + 1,
                                  d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[x] = i
    return d[-1][-1]


@F.pandas_udf(IntegerType())
def damerau_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([damerau(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


def _cut(n: str, i: str, parts: int) -> tuple[str, str]:
    """(start, length) of segment ``i`` of ``parts`` in a string of length ``n``."""
    return f"({i} * {n} div {parts})", f"(({i} + 1) * {n} div {parts} - {i} * {n} div {parts})"


def segments(col: str, k: int) -> Column:
    """The ``2 k + 1`` segments of a backbone name: array<struct<len, i, sub>>."""
    n, parts = f"length({col})", 2 * k + 1
    start, size = _cut(n, "i", parts)
    return F.expr(f"transform(sequence(0, {parts - 1}), i -> named_struct('len', {n}, 'i', i, "
                  f"'sub', substr({col}, cast({start} + 1 AS int), cast({size} AS int))))")


def probes(col: str, k: int) -> Column:
    """The segments that a backbone name within ``k`` edits may share with a name."""
    n, parts = f"length({col})", 2 * k + 1
    start, size = _cut("m", "i", parts)
    inner = (f"transform(sequence(-{k}, {k}), d -> named_struct('len', m, 'i', i, 'sub', "
             f"IF({start} + d >= 0 AND {start} + d + {size} <= {n}, "
             f"substr({col}, cast({start} + d + 1 AS int), cast({size} AS int)), NULL)))")
    return F.expr(f"array_distinct(filter(flatten(flatten(transform(sequence(greatest(0, {n} - {k}), {n} + {k}), "
                  f"m -> transform(sequence(0, {parts - 1}), i -> {inner})))), x -> x.sub IS NOT NULL))")


def _by_segments(asked: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """Distinct ``(q, b)`` that share a segment."""
    qs = asked.select("q", F.explode(probes("q", k)).alias("p")).select("q", "p.*")
    bs = known.select("b", F.explode(segments("b", k)).alias("p")).select("b", "p.*")
    return qs.join(bs, ["len", "i", "sub"]).select("q", "b").distinct()


def _within(pairs: DataFrame, k: int) -> DataFrame:
    return (pairs.where(F.levenshtein("q", "b", 2 * k) >= 0)
            .withColumn("d", damerau_distance("q", "b")).where(F.col("d") <= k))


def match_near(queries: DataFrame, backbone: DataFrame, max_distance: int = 2,
               keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(input_name, name, distance)``: of each distinct input name the nearest backbone
    names (all that are equally near), compared lower-cased.  ``keep`` as in
    :func:`~verdant.operators.near.nearest`."""
    q = queries.select("input_name").distinct().withColumn("q", F.lower(normalize_name(F.col("input_name"))))
    b = backbone.select("name", F.lower("name").alias("b")).distinct()
    pairs = nearest(q.select("q").distinct(), b.select("b").distinct(), max_distance, _within, _by_segments, keep)
    return (pairs.join(b, "b").join(q, "q")
            .select("input_name", "name", F.col("d").alias("distance")))


def choose(matched: DataFrame, backbone: DataFrame) -> DataFrame:
    """One backbone row for each matched row.

    ``matched``: (input_name, name, kingdom, family), the context's nulls fit everything;
    ``backbone``: (name, key, kingdom, family, status).  Result: the context, ``key``, the
    row's own ``row_kingdom`` and ``row_family``, and ``n_best``, the rows of that name that
    fit the context as well as the chosen one."""
    m = matched.select("input_name", "name", F.col("kingdom").alias("_k"), F.col("family").alias("_f")).distinct()
    j = m.join(backbone.select("name", "key", "kingdom", "family", "status"), "name")

    def misses(context: str, own: str) -> Column:
        return F.when(F.col(context).isNull() | F.col(context).eqNullSafe(F.col(own)), 0).otherwise(1)

    fit = F.struct(misses("_f", "family").alias("f"), misses("_k", "kingdom").alias("k"))
    by_fit = (j.groupBy("input_name", "name", "_k", "_f", fit.alias("fit"))
              .agg(F.count(F.lit(1)).alias("n"),
                   F.min_by(F.struct("key", "kingdom", "family"),
                            F.struct((F.col("status") != "ACCEPTED").alias("s"), F.col("key"))).alias("row")))
    best = by_fit.groupBy("input_name", "name", "_k", "_f").agg(F.min_by(F.struct("row", "n"), "fit").alias("b"))
    return best.select("input_name", "name", F.col("_k").alias("kingdom"), F.col("_f").alias("family"), F.col("b.row.key").alias("key"),
                       F.col("b.row.kingdom").alias("row_kingdom"), F.col("b.row.family").alias("row_family"),
                       F.col("b.n").alias("n_best"))
