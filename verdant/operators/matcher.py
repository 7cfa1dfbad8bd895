"""Re-aimed name matcher (RES8): the names the match table cannot answer are
matched against a backbone name table.

Match types (the scoring is our own; the original delegates it to a remote
service whose formula is not published):

* EXACT       lower-cased name equal                       confidence 99
* FUZZY       Levenshtein distance 1 or 2 (closest wins)   confidence 100 - 6 * d
* HIGHERRANK  only the first token (genus) is known        confidence 90
* NONE        nothing                                      confidence 0

Equal names are found by an equi-join.  The names left meet by what is left of them
after one deletion, then, where nothing is that near, after two
(:mod:`verdant.operators.near`).  Long names, and names more than two edits away, are
found by segments: a backbone name is cut into ``max_distance + 2`` even segments, and a string
within that many edits keeps at least *two* of them whole.  Both together are the
key, so the names of a large genus, whose first segment is the same, meet only
where another segment agrees as well.  The shifts of the two and the difference in
length come from the edits before, between and behind them, so they sum to at most
``max_distance``: 25 shifts for two edits and 6 pairs of segments, at most 150 keys
a query name, whatever its length.  ``levenshtein`` verifies the pairs that meet.
This is exact for every distance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.functions.text import normalize_name, tokens
from verdant.operators.near import nearest

# the columns of a backbone that answers carry through, where it has them
CARRIED = ["acceptedUsageKey", "accepted", "rank", "status", "kingdom", "family", "genus"]


def _pairs(col: str, k: int, m: str, p: str, q: str, checks: str) -> str:
    """Keys (len, i, j, s, t) of all pairs of the ``k + 2`` segments of a string of length
    ``m``, read from ``col`` shifted by ``p`` and ``q``; null where ``checks`` fails."""
    def cut(x: str) -> tuple[str, str]:
        return f"({x} * {m} div {k + 2})", f"(({x} + 1) * {m} div {k + 2} - {x} * {m} div {k + 2})"

    (at_i, size_i), (at_j, size_j) = cut("i"), cut("j")
    inside = checks.format(i=f"{at_i} + {p}", j=f"{at_j} + {q}", end=f"{at_j} + {q} + {size_j}", gap=f"{at_i} + {p} + {size_i}")

    def part(at: str, shift: str, size: str) -> str:
        return f"substr({col}, cast({at} + {shift} + 1 AS int), cast({size} AS int))"

    return (f"flatten(transform(sequence(0, {k}), i -> transform(sequence(i + 1, {k + 1}), j -> IF({inside}, "
            f"named_struct('len', {m}, 'i', i, 'j', j, 's', {part(at_i, p, size_i)}, 't', {part(at_j, q, size_j)}), NULL))))")


def segments(col: str, k: int) -> Column:
    """Every two of the ``k + 2`` segments of a backbone name."""
    return F.expr(_pairs(col, k, f"length({col})", "0", "0", "true"))


def probes(col: str, k: int) -> Column:
    """The pairs of segments that a backbone name within ``k`` edits may share with a name."""
    reach = range(-k, k + 1)
    shifts = [(a, a + b, a + b + c) for a in reach for b in reach for c in reach if abs(a) + abs(b) + abs(c) <= k]
    rows = ", ".join(f"named_struct('p', {p}, 'q', {q}, 'm', {m})" for p, q, m in shifts)
    n = f"length({col})"
    keys = _pairs(col, k, f"({n} - x.m)", "x.p", "x.q",
                  f"{n} >= x.m AND {{i}} >= 0 AND {{j}} >= {{gap}} AND {{end}} <= {n}")
    return F.expr(f"array_distinct(filter(flatten(transform(array({rows}), x -> {keys})), y -> y IS NOT NULL))")


def _by_segments(asked: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """Distinct ``(q, b)`` that share two segments."""
    qs = asked.select("q", F.explode(probes("q", k)).alias("p")).select("q", "p.*")
    bs = known.select("b", F.explode(segments("b", k)).alias("p")).select("b", "p.*")
    return qs.join(bs, ["len", "i", "j", "s", "t"]).select("q", "b").distinct()


def _within(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.withColumn("d", F.levenshtein("q", "b", k)).where(F.col("d") >= 0)


def match_names_fuzzy(queries: DataFrame, backbone: DataFrame, max_distance: int = 2,
                      keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Distinct ``input_name`` -> (input_name, matched_name, key, distance,
    matchType, confidence) and the :data:`CARRIED` columns that ``backbone``
    (name, key, ...) has.  ``keep`` as in :func:`~verdant.operators.near.nearest`."""
    carried = [c for c in CARRIED if c in backbone.columns]
    q = (queries.select("input_name").distinct()
                .withColumn("q", F.lower(normalize_name(F.col("input_name")))))
    b = backbone.select(F.col("name").alias("matched_name"), "key", *carried,
                        F.lower(F.col("name")).alias("b"))
    pairs = nearest(q.select("q").distinct(), b.select("b").distinct(), max_distance, _within, _by_segments, keep)
    cand = pairs.join(b, "b")
    best = (cand.groupBy("q").agg(F.min_by(F.struct("matched_name", "key", "d", *carried),
                                           F.struct("d", "b", "key")).alias("m")))
    genus = (b.select(F.element_at(tokens(F.col("b")), 1).alias("g")).distinct())
    out = (q.join(best, "q", "left")
            .withColumn("g", F.element_at(tokens(F.col("q")), 1)))
    out = out.join(genus.withColumn("_genus_known", F.lit(True)), "g", "left")
    d = F.col("m.d")
    mt = (F.when(d == 0, "EXACT").when(d.isNotNull(), "FUZZY")
           .when(F.col("_genus_known"), "HIGHERRANK").otherwise("NONE"))
    conf = (F.when(d == 0, 99).when(d.isNotNull(), 100 - 6 * d)
             .when(F.col("_genus_known"), 90).otherwise(0))
    return out.select(
        "input_name",
        F.when(d.isNotNull(), F.col("m.matched_name")).when(F.col("_genus_known"), F.col("g"))
         .alias("matched_name"),
        F.col("m.key").alias("key"), d.alias("distance"), mt.alias("matchType"),
        conf.cast("int").alias("confidence"), *[F.col(f"m.{c}").alias(c) for c in carried])


def responses_for(misses: DataFrame, backbone: DataFrame,
                  keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Match-table rows for unseen keys (RES7 + RES8): ``misses``: (name_key).

    Rank, status, kingdom, family, genus and the accepted name are those of the
    backbone row that answered; a backbone without these columns counts as
    accepted species of unstated kingdom."""
    m = match_names_fuzzy(misses.select(F.col("name_key").alias("input_name")), backbone, keep=keep)
    has = set(backbone.columns)
    hit = F.col("matchType").isin("EXACT", "FUZZY")

    def field(name: str, default) -> Column:
        return (F.col(name) if name in has else F.when(hit, F.lit(default))).alias(name)

    return m.select(
        F.col("input_name").alias("name_key"), F.col("key").cast("bigint").alias("usageKey"),
        F.col("acceptedUsageKey").cast("bigint").alias("acceptedUsageKey") if "acceptedUsageKey" in has
        else F.lit(None).cast("bigint").alias("acceptedUsageKey"),
        F.col("matched_name").alias("scientificName"), field("accepted", None).cast("string"),
        F.when(F.col("matchType") == "HIGHERRANK", "GENUS").when(hit, field("rank", "SPECIES")).alias("rank"),
        F.coalesce(field("status", "ACCEPTED"), F.lit("ACCEPTED")).alias("status"), "matchType", "confidence",
        field("kingdom", None).cast("string"), field("family", None).cast("string"),
        field("genus", None).cast("string"))
