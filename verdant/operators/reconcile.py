"""Reconciliation of all source records of one key into one wide row
(REC1-REC10).

Record order is the *string* order of ``source_id`` (then ``source``), the
order in which the original walked its records.

Scale: one key may hold a large share of all records, so nothing here
collects a key's records into one task.  Scalars use ``min_by`` / ``max``,
which aggregate partially on the map side.  The order-keeping list unions
are computed as "first (record, position) per distinct element": explode,
aggregate per (key, field, element), then gather the distinct elements,
which are bounded by the output row, not by the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.functions.enums import ordered_enum, split_regions, split_statuses, status_flags, zones
from verdant.functions.text import bare_binomial, url_from_id

KEY = "canonical_taxon_id"
LIST_FIELDS = ["common_names_en", "synonyms_latin", "statuses_he",
               "distribution_regions", "climate_zone"]

CANONICAL_COLUMNS = [
    KEY, "scientific_name", "family", "genus", "name_he", "name_ar", "common_names_en",
    "synonyms_latin", "life_form", "native_status", "invasive_status",
    "protected", "red_list", "nectar", "edible", "medicinal", "poisonous", "allergenic",
    "statuses_he", "bloom_months_he", "habitat_he", "distribution_il",
    "distribution_regions", "climate_zone", "leaf_shape", "leaf_margin", "stem_shape",
    "petals", "source_id", "source_url",
]

PROVENANCE_COLUMNS = [KEY, "field", "value", "source", "confidence"]


def _attr(profile_label: str) -> Column:
    return F.col(f"`{profile_label}`")


def record_facts(resolved: DataFrame, profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """Per resolved record: the derived facts the merge needs (no aggregation)."""
    lat = F.col("name_lat")
    common = _attr(profile.label_common_en)
    lf_raw = _attr(profile.label_life_form)
    regions = split_regions(_attr(profile.label_distribution), profile.region_zone)
    statuses = split_statuses(_attr(profile.label_statuses))
    empty = F.array().cast("array<string>")
    cols = [
        F.col(KEY), F.struct(F.col("source_id"), F.col("source")).alias("_ord"),
        "source_id", "scientific_name", "family", "genus", "confidence", "name_he",
        lf_raw.alias("_life_form_raw"),
        ordered_enum(lf_raw, profile.life_form_map).alias("life_form"),
        F.when(common.isNotNull() & (common != ""), F.array(common)).otherwise(empty)
         .alias("common_names_en"),
        F.when(lat.isNotNull() & (lat != "") &
               (bare_binomial(lat) != bare_binomial(F.col("scientific_name"))), F.array(lat))
         .otherwise(empty).alias("synonyms_latin"),
        statuses.alias("statuses_he"),
        regions.alias("distribution_regions"),
    ]
    for col, label in profile.scalar_labels.items():
        cols.append(_attr(label).alias(col))
    df = resolved.select(*cols)
    return df.select("*", zones(F.col("distribution_regions"), profile.region_zone).alias("climate_zone"),
                     *status_flags(F.col("statuses_he"), profile.status_map, profile.status_flags))


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c.cast("string") != "")


def _first_fields(profile: L.Profile) -> list[str]:
    return ["scientific_name", "family", "genus", "confidence", "name_he", "source_id",
            "_life_form_raw", "life_form", "statuses_he"] + list(profile.scalar_labels)


def merge(facts: DataFrame, profile: L.Profile = L.REFERENCE_PROFILE,
          fields=LIST_FIELDS) -> DataFrame:
    """REC1-REC4 in one linear plan over the record facts.

    Every record contributes one scalar row and one row per list element.
    Aggregate 1 groups by (key, field, item): the scalar row of a key takes
    the first record's values, the OR of flags and the gap fills (all
    ``min_by``/``max``, combined map-side); an element row takes the first
    (record, position) where the element occurs.  Aggregate 2 groups by key
    and gathers the distinct elements per list in that order (REC2).  The
    facts are read once; nothing collects a key's records.
    """
    gaps = ["life_form", "name_he"] + list(profile.scalar_labels)
    scal = F.struct(*[F.col(c) for c in _first_fields(profile)])
    rows = [F.array(F.struct(F.lit("_s").alias("field"), F.lit(None).cast("string").alias("item"),
                             F.lit(0).alias("pos")))]
    def tagged(name):
        return lambda x, i: F.struct(F.lit(name).alias("field"), x.alias("item"), i.alias("pos"))

    for f in fields:
        rows.append(F.transform(F.coalesce(F.col(f), F.array().cast("array<string>")), tagged(f)))
    ex = facts.select(KEY, "_ord", scal.alias("_scal"), *profile.status_flags, *gaps,
                      F.explode(F.concat(*rows)).alias("_e"))
    is_s = F.col("_e.field") == "_s"
    ex = ex.select(KEY, "_ord", F.col("_e.field").alias("field"), F.col("_e.item").alias("item"),
                   F.col("_e.pos").alias("pos"),
                   F.when(is_s, F.col("_scal")).alias("_scal"),
                   *[F.when(is_s, F.col(f)).alias(f) for f in profile.status_flags],
                   *[F.when(is_s, F.col(g)).alias(g) for g in gaps])
    ordc = F.col("_ord")
    a1 = ex.groupBy(KEY, "field", "item").agg(
        F.min(F.struct("_ord", "pos")).alias("_at"),
        F.min_by("_scal", ordc).alias("_first"),
        *[F.max(f).alias(f) for f in profile.status_flags],
        *[F.min_by(F.col(g), F.when(_truthy(F.col(g)), ordc)).alias(f"_gap_{g}") for g in gaps])
    s_row = F.col("field") == "_s"
    aggs = [F.max(F.when(s_row, F.col("_first"))).alias("_first"),
            *[F.max(F.when(s_row, F.col(f))).alias(f) for f in profile.status_flags],
            *[F.max(F.when(s_row, F.col(f"_gap_{g}"))).alias(f"_gap_{g}") for g in gaps]]
    for f in fields:
        picked = F.array_sort(F.collect_list(F.when(F.col("field") == f,
                                                    F.struct(F.col("_at"), F.col("item")))))
        aggs.append(F.transform(picked, lambda x: x["item"]).alias(f))
    out = a1.groupBy(KEY).agg(*aggs)
    return out.select(KEY, "_first", *profile.status_flags, *fields,
                      *[F.coalesce(F.col(f"_gap_{g}"), F.col(f"_first.{g}")).alias(g) for g in gaps])


def reconcile(resolved: DataFrame, status: DataFrame | None = None,
              profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """REC1-REC6 + STA3: resolved records -> canonical rows (30 columns).

    ``resolved`` holds one row per resolved source record with the pivoted
    label columns; ``status`` is (canonical_taxon_id, invasive_status,
    status_source) from ``status.status_frame``.
    """
    out = merge(record_facts(resolved, profile), profile)
    empty = F.array().cast("array<string>")
    if status is not None:
        out = out.join(status.select(KEY, "invasive_status", "status_source"), KEY, "left")
    else:
        out = (out.withColumn("invasive_status", F.lit(None).cast("string"))
                  .withColumn("status_source", F.lit(None).cast("string")))
    return out.select(
        F.col(KEY).cast("bigint").alias(KEY),
        F.col("_first.scientific_name").alias("scientific_name"),
        F.col("_first.family").alias("family"), F.col("_first.genus").alias("genus"),
        "name_he", "name_ar",
        *[F.coalesce(F.col(f), empty).alias(f) for f in ["common_names_en", "synonyms_latin"]],
        "life_form", F.lit("native").alias("native_status"),
        F.coalesce(F.col("invasive_status"), F.lit("not_listed")).alias("invasive_status"),
        *profile.status_flags,
        F.coalesce(F.col("statuses_he"), empty).alias("statuses_he"),
        "bloom_months_he", "habitat_he", "distribution_il",
        *[F.coalesce(F.col(f), empty).alias(f) for f in ["distribution_regions", "climate_zone"]],
        "leaf_shape", "leaf_margin", "stem_shape", "petals",
        F.col("_first.source_id").alias("source_id"),
        url_from_id(F.col("_first.source_id"), profile.url_prefix).alias("source_url"),
        # carried for provenance, dropped by publish
        F.col("_first.confidence").alias("_identity_confidence"),
        F.col("_first._life_form_raw").alias("_first_life_form_raw"),
        F.col("_first.life_form").alias("_first_life_form"),
        F.col("_first.statuses_he").alias("_first_statuses"),
        F.col("_first.name_he").alias("_first_name_he"),
        F.col(f"_first.{_distribution_col(profile)}").alias("_first_distribution"),
        F.coalesce(F.col("status_source"), F.lit(L.DEFAULT_STATUS_SOURCE)).alias("_status_source"),
    )


def _distribution_col(profile: L.Profile) -> str:
    for col, label in profile.scalar_labels.items():
        if label == profile.label_distribution:
            return col
    return "distribution_il"


def canonical_table(reconciled: DataFrame) -> DataFrame:
    """The 30 published columns (helper columns dropped)."""
    return reconciled.select(*CANONICAL_COLUMNS)


def provenance(reconciled: DataFrame, profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """REC7: provenance rows of the first record of each key.

    Identity rows carry the match confidence; source facts carry 100; one row
    per status label; life form (raw text) and distribution only when present.
    """
    src, ids = F.lit(profile.source), F.lit(profile.identity_source)
    gc = F.col("_identity_confidence")
    hundred = F.lit(100)

    def row(field, value, source, conf, keep=F.lit(True)):
        return F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"),
                        source.alias("source"), conf.cast("int").alias("confidence"),
                        keep.alias("_keep"))

    fixed = F.array(
        row("scientific_name", F.col("scientific_name"), ids, gc),
        row("family", F.col("family"), ids, gc),
        row("genus", F.col("genus"), ids, gc),
        row("name_he", F.col("_first_name_he"), src, hundred),
        row("native_status", F.col("native_status"), src, hundred),
        row("invasive_status", F.col("invasive_status"), F.col("_status_source"), hundred),
        row("life_form", F.col("_first_life_form_raw"), src, hundred,
            F.col("_first_life_form").isNotNull()),
        row("distribution_il", F.col("_first_distribution"), src, hundred,
            _truthy(F.col("_first_distribution"))),
    )
    statuses = F.transform(F.coalesce(F.col("_first_statuses"), F.array().cast("array<string>")),
                           lambda s: row("status", s, src, hundred))
    # keep the original row order: the six identity rows, life form, statuses, distribution
    allrows = F.concat(F.slice(fixed, 1, 7), statuses, F.slice(fixed, 8, 1))
    ex = reconciled.select(KEY, F.posexplode(allrows).alias("seq", "p"))
    return ex.where(F.col("p._keep")).select(
        F.col(KEY), F.col("p.field").alias("field"), F.col("p.value").alias("value"),
        F.col("p.source").alias("source"), F.col("p.confidence").alias("confidence"))


def all_values_provenance(facts: DataFrame, profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """REC7 in 'all' mode: one row per (key, field, value) of every record."""
    src = F.lit(profile.source)
    scal = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
            for c in ["name_he", "life_form"] + list(profile.scalar_labels)]
    lists = F.transform(F.col("statuses_he"),
                        lambda s: F.struct(F.lit("status").alias("field"), s.alias("value")))
    ex = facts.select(KEY, F.explode(F.concat(F.array(*scal), lists)).alias("p"))
    return (ex.where(_truthy(F.col("p.value")))
              .select(KEY, "p.field", "p.value", src.alias("source"), F.lit(100).alias("confidence"))
              .distinct())


# Source precedence of REC9 (declared in the spec: authority > catalogue > seller)
DEFAULT_PRECEDENCE = {"gbif": 0, "wildflowers": 1, "azur": 2}


def precedence(prov: DataFrame, ranks: dict = DEFAULT_PRECEDENCE) -> DataFrame:
    """REC9: one winning value per (key, field): source rank, then confidence
    (high first), then source name and value as tie-breaks.

    An aggregate (``min_by`` on a sort struct) rather than a window: it
    combines map-side, so a key with many provenance rows is never sorted in
    one task.
    """
    m = F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))])
    rank = F.coalesce(F.try_element_at(m, F.col("source")), F.lit(len(ranks)))
    order = F.struct(rank.alias("r"), (-F.coalesce(F.col("confidence"), F.lit(0))).alias("c"),
                     F.col("source").alias("s"), F.col("value").alias("v"))
    return (prov.groupBy(KEY, "field")
                .agg(F.min_by(F.struct("value", "source", "confidence"), order).alias("w"))
                .select(KEY, "field", "w.value", "w.source", "w.confidence"))


def conflicts(prov: DataFrame) -> DataFrame:
    """REC10: (key, field) with more than one distinct value."""
    distinct = prov.where(F.col("value").isNotNull()).select(KEY, "field", "value").distinct()
    return (distinct.groupBy(KEY, "field")
                    .agg(F.count(F.lit(1)).alias("n_values"),
                         F.array_sort(F.collect_list("value")).alias("values"))
                    .where(F.col("n_values") > 1))


def conflict_values(prov: DataFrame) -> DataFrame:
    """REC10 in long form: each value of a (key, field) that has several, with its rows
    and its first source.  No row holds a key's values; both aggregates combine map-side."""
    known = prov.where(F.col("value").isNotNull())
    several = (known.groupBy(KEY, "field").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
               .where("lo < hi").select(KEY, "field"))
    return (known.groupBy(KEY, "field", "value")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("source").alias("first_source"))
            .join(several, [KEY, "field"], "left_semi"))


def metrics(df: DataFrame, **named: Column) -> DataFrame:
    """One aggregate pass over ``df`` -> long rows (metric, value)."""
    row = df.agg(*[c.cast("bigint").alias(n) for n, c in named.items()])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in named
    ])).alias("m")).select("m.metric", "m.value")


def build_summary(records_in: DataFrame, resolved: DataFrame, canonical: DataFrame,
                  review: DataFrame, prov: DataFrame,
                  profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
    """REC8: build summary as (metric, value) rows, one aggregate per input."""
    one = F.count(F.lit(1))
    parts = [
        metrics(records_in, taxa_in=one),
        metrics(resolved, resolved=one),
        metrics(canonical, canonical_rows=one,
                **{f"invasive_{s}": F.count_if(F.col("invasive_status") == s)
                   for s in ("listed", "potential", "not_listed")},
                **{f"status_{f}": F.count_if(F.col(f)) for f in profile.status_flags},
                with_region=F.count_if(F.size("distribution_regions") > 0)),
        metrics(review, review=one),
        metrics(prov, provenance_rows=one),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
