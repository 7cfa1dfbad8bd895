"""Data-quality gates (GAT1-GAT5): each returns a one-row DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant import lookups as L

KEY = "canonical_taxon_id"


def _pct(a, b):
    return F.round(F.try_divide(a * 100.0, b), 0)


def tally(**frames: DataFrame) -> DataFrame:
    """Row counts of several frames in one pass, one row, no joins.

    Each frame contributes only a tag column; the union is aggregated once.
    """
    parts = [df.select(F.lit(name).alias("_t")) for name, df in frames.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.count_if(F.col("_t") == name).alias(name) for name in frames])


def phase1_gate(records: DataFrame, resolved: DataFrame, canonical: DataFrame,
                review: DataFrame, prov: DataFrame, asked: DataFrame | None = None,
                missed: DataFrame | None = None) -> DataFrame:
    """GAT1: staged, resolved %, rows, review %, provenance rows; with the look-up keys
    ``asked`` and ``missed``, also the hits and misses of the kept answers."""
    extra = {} if asked is None else {"keys_asked": asked, "cache_misses": missed}
    r = tally(staged=records, resolved=resolved, canonical_rows=canonical,
              review=review, provenance_rows=prov, **extra)
    if extra:
        r = r.withColumn("cache_hits", F.col("keys_asked") - F.col("cache_misses"))
    return (r.withColumn("resolved_pct", _pct(F.col("resolved"), F.col("staged")))
             .withColumn("review_pct", _pct(F.col("review"), F.col("staged"))))


def phase2_gate(canonical: DataFrame, flags=L.STATUS_FLAGS) -> DataFrame:
    """GAT2: status coverage (must be 100 %), breakdown, flag counts, regions."""
    covered = F.col("invasive_status").isin("listed", "potential", "not_listed")
    return canonical.agg(
        F.count(F.lit(1)).alias("canonical"),
        F.count_if(covered).alias("covered"),
        F.count_if(F.col("invasive_status") == "listed").alias("listed"),
        F.count_if(F.col("invasive_status") == "potential").alias("potential"),
        F.count_if(F.col("invasive_status") == "not_listed").alias("not_listed"),
        *[F.count_if(F.col(f)).alias(f) for f in flags],
        F.count_if(F.size("distribution_regions") > 0).alias("with_region"),
    ).withColumn("coverage_ok", F.col("covered") == F.col("canonical"))


def phase3_gate(matched: DataFrame, before: DataFrame, after: DataFrame,
                by_key: DataFrame, added: DataFrame | None = None) -> DataFrame:
    """GAT3: match rate, no orphan rows (before == after), multi-listings and, with the
    layer's provenance ``added``, its rows."""
    extra = {} if added is None else {"provenance_rows_added": added}
    r = tally(seller_products=matched, matched=matched.where(F.col(KEY).isNotNull()),
              rows_before=before, rows_after=after, taxa_with_seller=by_key,
              multi_listing_taxa=by_key.where(F.col("conflict")), **extra)
    return (r.withColumn("unmatched", F.col("seller_products") - F.col("matched"))
             .withColumn("match_pct", _pct(F.col("matched"), F.col("seller_products")))
             .withColumn("no_orphans", F.col("rows_before") == F.col("rows_after")))


def resolver_gate(labelled: DataFrame, results: DataFrame,
                  resolve_floor: float = 90.0) -> DataFrame:
    """GAT4: labelled names joined to their results, bucket pass rates.

    ``labelled``: (input_name, input_lang, expected_bucket, ...);
    ``results``: output of ``resolve_names``.
    """
    j = labelled.join(results, ["input_name", "input_lang"], "left")
    exp_res = F.col("expected_bucket") == "resolve"
    exp_rev = F.col("expected_bucket") == "review"
    g = j.agg(
        F.count_if(exp_res).alias("resolve_total"),
        F.count_if(exp_res & (F.col("status") == "resolved")).alias("resolve_ok"),
        F.count_if(exp_rev).alias("review_total"),
        F.count_if(exp_rev & (F.col("status") == "review")).alias("review_ok"))
    return (g.withColumn("resolve_pct", _pct(F.col("resolve_ok"), F.col("resolve_total")))
             .withColumn("review_pct", _pct(F.col("review_ok"), F.col("review_total")))
             .withColumn("pass", (F.col("resolve_ok") * 100.0 >= resolve_floor * F.col("resolve_total")) &
                         (F.col("review_ok") == F.col("review_total"))))


def resolver_misses(labelled: DataFrame, results: DataFrame) -> DataFrame:
    """GAT4 detail: resolve-bucket misses and review-bucket leaks."""
    j = labelled.join(results, ["input_name", "input_lang"], "left")
    miss = (F.col("expected_bucket") == "resolve") & (F.col("status") != "resolved")
    leak = (F.col("expected_bucket") == "review") & (F.col("status") != "review")
    return j.where(miss | leak).withColumn("kind", F.when(miss, "miss").otherwise("leak"))


def second_run_gate(stats: DataFrame) -> DataFrame:
    """GAT5: the second run must find nothing new (misses == 0)."""
    return stats.withColumn("pass", F.col("misses") == 0)
