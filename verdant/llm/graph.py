"""Connected components as Spark joins (alternating star contraction).

Edges are pairs of longs.  Each round rewires every node to the smallest
neighbour it sees: first the larger neighbours ("large star"), then the
smaller ones ("small star").  A node's neighbourhood is only ever reduced
by ``min``, which combines map-side, so a hub with a third of all edges
never gathers them in one task; the join that hands the minimum back is a
plain equi-join that AQE splits when skewed.  Rounds are logarithmic in the
graph's diameter; they end as soon as the links are stars around the smallest
node of each component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import scratch, staged

MAX_ROUNDS = 60


def _minima(df: DataFrame) -> DataFrame:
    return df.groupBy("u").agg(F.min("v").alias("m"))


def _stars(e: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none that has one itself."""
    ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return (ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .where("up > 1 or (up = 1 and down = 1)").isEmpty())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every node of ``edges``; component is the smallest id.

    Self-links and null ends are ignored, repeated links are harmless; an
    empty edge table gives an empty result.
    """
    with scratch(edges.sparkSession):
        e = staged(edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
                   .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
        for _ in range(MAX_ROUNDS):
            if _stars(e):
                break
            # large star: every larger neighbour is linked to the smallest of the neighbourhood
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = _minima(both).select("u", F.least("u", "m").alias("m"))
            large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .distinct())
            # small star: the smaller neighbours and the node itself are linked to the smallest
            large = staged(large, "large")
            low = _minima(large)
            small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            own = low.select("u", F.col("m").alias("v"))
            e = staged(small.unionByName(own).distinct(), "small")
        else:
            raise RuntimeError("components: no fixed point")
        roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
        return staged(e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots),
                      "components", keep=True)
