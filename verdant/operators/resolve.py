"""Identity resolution (RES1-RES7, RES9, RES10, JON1).

The name-match service of the original is a *reference table* here, one row
per looked-up name key (``lower(normalised name)``) with the response fields
``usageKey, acceptedUsageKey, scientificName, accepted, rank, status,
matchType, confidence, kingdom, family, genus``.

Plan shape: distinct input names -> two probe rows per name (first and retry
key) -> one left join with the match table -> ladder per distinct name ->
join the per-name result back to the records.  The big records table never
meets the big match table directly.  A small match table is broadcast by
AQE (a left outer join can only build on its right side); a large one goes
through a shuffle join in which Spark's runtime bloom filter (on by default)
prunes it to the probed keys before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.functions.text import is_latin, normalize_name, strip_cultivar

MATCH_FIELDS = ["usageKey", "acceptedUsageKey", "scientificName", "accepted", "rank",
                "status", "matchType", "confidence", "kingdom", "family", "genus"]

RESULT_COLUMNS = ["status", "reason", "canonical_taxon_id", "scientific_name", "family",
                  "genus", "confidence", "matchType", "gbif_status"]


def lookup_keys(names: DataFrame, profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """RES1: per distinct (input_name, input_lang): the first and the retry key.

    The retry key exists only where a stripped (cultivar-free) name differs.
    """
    n = names.select(F.coalesce(F.col("input_name"), F.lit("")).alias("input_name"),
                     F.coalesce(F.col("input_lang"), F.lit("lat")).alias("input_lang")).distinct()
    n = n.select("*", normalize_name(F.col("input_name")).alias("_name"))
    n = n.select("*", normalize_name(strip_cultivar(F.col("_name"))).alias("_stripped"))
    looked = (F.col("_name") != "") & (F.col("input_lang") != "he") & is_latin(F.col("_name"))
    return n.select("*", F.when(looked, F.lower("_name")).alias("_k1"),
                    F.when(looked & (F.col("_stripped") != "") & (F.col("_stripped") != F.col("_name")),
                           F.lower("_stripped")).alias("_k2"))


def ladder(profile: L.Profile = L.REFERENCE_PROFILE) -> Column:
    """RES4: the review reason in ladder order; null means resolved."""
    mt = F.coalesce(F.col("_r.matchType"), F.lit("NONE"))
    conf = F.coalesce(F.col("_r.confidence"), F.lit(0))
    kingdom = F.col("_r.kingdom")
    rank = F.col("_r.rank")
    key = F.coalesce(F.nullif(F.col("_r.acceptedUsageKey"), F.lit(0)), F.nullif(F.col("_r.usageKey"), F.lit(0)))
    return (F.when(F.col("_name") == "", F.lit("empty"))
             .when((F.col("input_lang") == "he") | ~is_latin(F.col("_name")), F.lit("hebrew_no_crosswalk"))
             .when(mt == "NONE", F.lit("no_match"))
             .when(kingdom.isNotNull() & (kingdom != "") & (kingdom != profile.accepted_kingdom),
                   F.concat(F.lit("non_plant:"), kingdom))
             .when((mt == "HIGHERRANK") | ~F.coalesce(rank.isin(*profile.species_ranks), F.lit(False)),
                   F.concat(F.lit("higher_rank:"), F.coalesce(rank, F.lit("None"))))
             .when(conf < profile.threshold, F.concat(F.lit("low_confidence:"), conf.cast("string")))
             .when(key.isNull(), F.lit("missing_key")))


def resolve_names(names: DataFrame, match: DataFrame,
                  profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """RES2-RES5 per distinct (input_name, input_lang).

    One pass: each name becomes two probe rows (first key, retry key), the
    probes meet the match table in one left join, and one regroup by name
    puts the two answers side by side.  The probe side holds distinct names
    only.
    """
    keys = lookup_keys(names, profile)
    probes = keys.select("input_name", "input_lang", "_name", "_k1", "_k2",
                         F.explode(F.array(F.struct(F.lit(1).alias("which"), F.col("_k1").alias("name_key")),
                                           F.struct(F.lit(2).alias("which"), F.col("_k2").alias("name_key"))))
                          .alias("_p"))
    probes = probes.select("*", F.col("_p.which").alias("_which"), F.col("_p.name_key").alias("name_key")).drop("_p")
    resp = match.select("name_key", F.struct(*[F.col(c) for c in MATCH_FIELDS]).alias("_resp"))
    hit = probes.join(resp, "name_key", "left")
    j = hit.groupBy("input_name", "input_lang", "_name", "_k1", "_k2").agg(
        F.max(F.when(F.col("_which") == 1, F.col("_resp"))).alias("_a"),
        F.max(F.when(F.col("_which") == 2, F.col("_resp"))).alias("_b"))
    # RES3: a weak or missing first answer is *replaced* by the retry answer.
    weak = (F.coalesce(F.col("_a.matchType"), F.lit("NONE")) == "NONE") | \
           (F.coalesce(F.col("_a.confidence"), F.lit(0)) < profile.threshold)
    j = j.select("*", F.when(F.col("_k2").isNotNull() & weak, F.col("_b")).otherwise(F.col("_a")).alias("_r"))
    j = j.select("*", ladder(profile).alias("reason"))
    looked = F.col("_k1").isNotNull()
    resolved = F.col("reason").isNull()
    return j.select(
        "input_name", "input_lang",
        F.when(resolved, "resolved").otherwise("review").alias("status"),
        "reason",
        F.when(resolved, F.coalesce(F.nullif(F.col("_r.acceptedUsageKey"), F.lit(0)),
                                    F.nullif(F.col("_r.usageKey"), F.lit(0))).cast("bigint"))
         .alias("canonical_taxon_id"),
        F.when(resolved, F.coalesce(F.nullif(F.col("_r.accepted"), F.lit("")),
                                    F.col("_r.scientificName"))).alias("scientific_name"),
        F.when(looked, F.col("_r.family")).alias("family"),
        F.when(looked, F.col("_r.genus")).alias("genus"),
        F.when(looked, F.coalesce(F.col("_r.confidence"), F.lit(0))).cast("int").alias("confidence"),
        F.when(looked, F.coalesce(F.col("_r.matchType"), F.lit("NONE"))).alias("matchType"),
        F.when(looked, F.col("_r.status")).alias("gbif_status"))


def resolve_records(records: DataFrame, match: DataFrame, name_col: str = "name_lat",
                    lang: str | Column = "lat",
                    profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """Attach the resolution of ``name_col`` to every record (JON1)."""
    lang_c = F.lit(lang) if isinstance(lang, str) else lang
    recs = records.select("*", F.coalesce(F.col(name_col), F.lit("")).alias("_in"),
                          F.coalesce(lang_c, F.lit("lat")).alias("_lang"))
    names = recs.select(F.col("_in").alias("input_name"), F.col("_lang").alias("input_lang"))
    res = resolve_names(names, match, profile)
    out = recs.join(res, (recs["_in"] == res["input_name"]) & (recs["_lang"] == res["input_lang"]), "left")
    return out.drop("_in", "_lang", "input_name", "input_lang")


def split_review(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """RES6: (resolved records, review queue with its six columns)."""
    ok = resolved.where(F.col("status") == "resolved")
    review = resolved.where(F.col("status") != "resolved").select(
        "source_id", "name_he", "name_lat", "reason", "confidence", "matchType")
    return ok, review


def asked_keys(names: DataFrame, profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """The distinct look-up keys that names ask for (first and retry keys)."""
    keys = lookup_keys(names, profile)
    return (keys.select(F.col("_k1").alias("name_key"))
                .union(keys.select(F.col("_k2").alias("name_key")))
                .where(F.col("name_key").isNotNull()).distinct())


def unseen_keys(names: DataFrame, match: DataFrame,
                profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """RES7: look-up keys the match table does not hold yet (the misses)."""
    return asked_keys(names, profile).join(match.select("name_key"), "name_key", "left_anti")


def cache_stats(names: DataFrame, match: DataFrame,
                profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """RES7/GAT5 counters: distinct keys asked, hits and misses (one row)."""
    marked = asked_keys(names, profile).join(match.select("name_key").distinct().withColumn("_hit", F.lit(True)),
                         "name_key", "left")
    return marked.agg(F.count(F.lit(1)).alias("keys"),
                      F.count_if(F.col("_hit").isNotNull()).alias("hits"),
                      F.count_if(F.col("_hit").isNull()).alias("misses"))


def extend_match_table(match: DataFrame, new_responses: DataFrame) -> DataFrame:
    """RES7: append responses for the misses (keys already present win)."""
    fresh = new_responses.join(match.select("name_key"), "name_key", "left_anti")
    return match.unionByName(fresh.select(*match.columns))


def resolve_via_crosswalk(records: DataFrame, xwalk: DataFrame, match: DataFrame,
                          profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """RES10 (declared in the spec, off in the original code): a record with
    only a local name borrows the Latin name its crosswalk pairs with it.

    The crosswalk is reduced to one Latin name per local name (lowest
    source_id first) before the join, so no record is multiplied.
    """
    pick = (xwalk.groupBy("name_he")
                 .agg(F.min_by("name_lat", "source_id").alias("_xw_lat")))
    joined = records.join(pick, "name_he", "left")
    joined = joined.withColumn("_lat_in", F.coalesce(F.nullif(F.col("name_lat"), F.lit("")),
                                                     F.col("_xw_lat")))
    return resolve_records(joined, match, "_lat_in", "lat", profile).drop("_lat_in")
