"""Status layer (STA1-STA3, JON2, RES9, SRC4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.operators.resolve import resolve_names

KEY = "canonical_taxon_id"


def curated_names(lines: DataFrame) -> DataFrame:
    """SRC3: text lines (``value``) of a list file -> distinct names.

    Blank lines are skipped; the name is the text before the first comma,
    stripped.  The reader has dropped the header.
    """
    df = lines
    df = df.where(F.col("value").rlike(r"(?U)\S"))
    return (df.select(F.regexp_replace(F.substring_index(F.col("value"), ",", 1),
                                       r"(?U)^\s+|\s+$", "").alias("name"))
              .distinct())


def listed_keys(names: DataFrame, match: DataFrame,
                profile: L.Profile = L.REFERENCE_PROFILE) -> tuple[DataFrame, DataFrame]:
    """RES9: resolve the curated names -> (listed keys, unresolved names)."""
    res = resolve_names(names.select(F.col("name").alias("input_name"),
                                     F.lit("lat").alias("input_lang")), match, profile)
    listed = (res.where(F.col("status") == "resolved")
                 .groupBy(KEY).agg(F.min("scientific_name").alias("name")))
    unresolved = res.where(F.col("status") != "resolved").select(
        F.col("input_name").alias("name"), "reason")
    return listed, unresolved


def checklist_keys(pages: DataFrame, kingdom: str = L.ACCEPTED_KINGDOM) -> DataFrame:
    """SRC4: checklist result pages -> (key, name); the last page wins per key.

    ``pages``: (page_no, results array<struct<kingdom, nubKey, scientificName,
    canonicalName>>).
    """
    ex = pages.select("page_no", F.posexplode("results").alias("pos", "x"))
    ex = ex.where((F.col("x.kingdom") == kingdom) & F.col("x.nubKey").isNotNull() &
                  (F.col("x.nubKey") != 0))
    name = F.coalesce(F.nullif(F.col("x.scientificName"), F.lit("")), F.col("x.canonicalName"))
    return (ex.groupBy(F.col("x.nubKey").cast("bigint").alias(KEY))
              .agg(F.max_by(name, F.struct("page_no", "pos")).alias("name")))


def potential_keys(checklist: DataFrame, listed: DataFrame) -> DataFrame:
    """STA1: checklist minus listed (anti-join on the key)."""
    return checklist.join(listed.select(KEY), KEY, "left_anti")


def status_frame(listed: DataFrame, potential: DataFrame) -> DataFrame:
    """STA2+STA3: one row per flagged key; listed beats potential."""
    a = listed.select(KEY, F.lit("listed").alias("invasive_status"),
                      F.lit(L.LISTED_SOURCE).alias("status_source"), F.lit(1).alias("_p"))
    b = potential.select(KEY, F.lit("potential").alias("invasive_status"),
                         F.lit(L.POTENTIAL_SOURCE).alias("status_source"), F.lit(2).alias("_p"))
    u = a.unionByName(b)
    return (u.groupBy(KEY).agg(F.min_by(F.struct("invasive_status", "status_source"), "_p").alias("s"))
             .select(KEY, "s.invasive_status", "s.status_source"))


def apply_status(spine: DataFrame, status: DataFrame) -> DataFrame:
    """JON2: status with its source for every spine key (not_listed default)."""
    j = spine.join(status, KEY, "left")
    return (j.withColumn("invasive_status", F.coalesce("invasive_status", F.lit("not_listed")))
             .withColumn("status_source", F.coalesce("status_source", F.lit(L.DEFAULT_STATUS_SOURCE))))
