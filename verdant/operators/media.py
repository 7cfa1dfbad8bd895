"""Media layer (MED1-MED6, JON8, JON9, SRC6-SRC8).

Inputs are the dumps of the three media services as tables:

* ``pairs``: (n, img) name -> file URL, possibly several per name (SRC6);
* ``files``: (title, imageinfo array<struct<thumburl, url, descriptionurl,
  extmetadata struct<LicenseShortName struct<value>, Artist struct<value>>>>)
  (SRC7);
* ``occurrences``: flat occurrence media (see ``flatten_occurrences`` for the
  nested service dump) (SRC8).

The second source is only joined for keys that still lack a photo (JON9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.functions.text import bare_name, clean_credit, file_name, https

KEY = "canonical_taxon_id"
REC_FIELDS = ["thumb", "source", "license", "credit", "page"]


def first_image_per_name(pairs: DataFrame) -> DataFrame:
    """SRC6: one URL per name (the smallest; the service order is undefined)."""
    return (pairs.where(F.col("n").isNotNull() & F.col("img").isNotNull())
                 .groupBy("n").agg(F.min("img").alias("img")))


def file_metadata(files: DataFrame) -> DataFrame:
    """SRC7: flatten the first imageinfo entry; an empty thumb falls back to the url."""
    ii = F.get(F.col("imageinfo"), 0)
    return files.select(
        F.replace(F.col("title"), F.lit("File:"), F.lit("")).alias("fn"),
        https(F.coalesce(F.nullif(ii["thumburl"], F.lit("")), ii["url"])).alias("thumb"),
        ii["extmetadata"]["LicenseShortName"]["value"].alias("license"),
        clean_credit(ii["extmetadata"]["Artist"]["value"]).alias("credit"),
        ii["descriptionurl"].alias("page"))


def flatten_occurrences(occ: DataFrame) -> DataFrame:
    """SRC8 dump (taxon_key, results array<occurrence>) -> flat media rows.

    Flat form: (taxon_key, occ_order, references, media_pos, identifier,
    license, rightsHolder, creator); an occurrence without media keeps one
    row with a null identifier so it still counts as an occurrence.
    """
    o = occ.select(F.col("taxon_key").cast("bigint").alias("taxon_key"),
                   F.posexplode("results").alias("opos", "occ"))
    m = o.select("taxon_key", F.struct("opos").alias("occ_order"),
                 F.col("occ.references").alias("references"),
                 F.posexplode_outer("occ.media").alias("media_pos", "m"))
    return m.select("taxon_key", "occ_order", "references", "media_pos",
                    F.col("m.identifier").alias("identifier"), F.col("m.license").alias("license"),
                    F.col("m.rightsHolder").alias("rightsHolder"), F.col("m.creator").alias("creator"))


def occurrence_media(flat: DataFrame, limit: int | None = None) -> DataFrame:
    """First media item with an identifier among each key's occurrences (in
    ``occ_order``): all of them, or the first ``limit`` (the original asked its
    service for pages of ``lookups.OCCURRENCE_LIMIT``).

    No per-key sort or window: the earliest occurrence holding media is a
    ``min`` (map-side combinable); it qualifies when fewer than ``limit``
    distinct occurrences of its key come before it, which is a keyed count.
    """
    has = flat.where(F.col("identifier").isNotNull() & (F.col("identifier") != ""))
    rec = F.struct(https(F.col("identifier")).alias("thumb"), F.col("license").alias("license"),
                   F.coalesce(F.nullif(F.col("rightsHolder"), F.lit("")), F.col("creator")).alias("credit"),
                   F.col("references").alias("page"))
    first = (has.groupBy(F.col("taxon_key").alias(KEY))
                .agg(F.min_by(rec, F.struct("occ_order", "media_pos")).alias("g"),
                     F.min("occ_order").alias("_at")))
    if limit is None:
        return first.select(KEY, "g.*")
    occs = flat.select(F.col("taxon_key").alias(KEY), "occ_order").distinct()
    before = (occs.join(first.select(KEY, "_at"), KEY)
                  .where(F.col("occ_order") < F.col("_at"))
                  .groupBy(KEY).agg(F.count(F.lit(1)).alias("_before")))
    out = first.join(before, KEY, "left")
    return (out.where(F.coalesce(F.col("_before"), F.lit(0)) < limit)
               .select(KEY, "g.*"))


def pick_media(spine: DataFrame, pairs: DataFrame, files: DataFrame, occ: DataFrame,
               illustration_pattern: str = L.ILLUSTRATION_PATTERN,
               normalize_underscores: bool = False, occurrence_limit: int | None = None) -> DataFrame:
    """MED1-MED3: one record per key (thumb, source, license, credit, page).

    Preference: a photo from the first source, else an occurrence photo, else
    the first source's illustration.  Keys with nothing get no row.
    File names match the metadata titles exactly, as in the original (a title
    spelled with spaces misses a URL spelled with underscores);
    ``normalize_underscores=True`` compares both with '_' read as ' '.
    """
    # a key without a name has no first source, but may have an occurrence photo
    keys = spine.select(KEY, bare_name(F.col("scientific_name")).alias("bare"))
    # MED1 + JON8: distinct names -> file -> metadata, then back to keys
    names = keys.select("bare").where(F.col("bare").isNotNull()).distinct()
    wd = first_image_per_name(pairs)
    meta = file_metadata(files)
    fn = file_name(F.col("img"))
    if normalize_underscores:
        fn = F.replace(fn, F.lit("_"), F.lit(" "))
        meta = meta.withColumn("fn", F.replace(F.col("fn"), F.lit("_"), F.lit(" ")))
    # one record a file: the first with a thumb, by (thumb, page, license, credit)
    record = F.struct("thumb", "page", "license", "credit")
    meta = (meta.where(F.col("thumb").isNotNull() & (F.col("thumb") != ""))
            .groupBy("fn").agg(F.min(record).alias("m")).select("fn", "m.*"))
    per_name = (names.join(wd, names["bare"] == wd["n"], "inner")
                     .select("bare", fn.alias("fn"))
                     .join(meta, "fn", "inner")
                     .select("bare", F.struct(
                         "thumb", F.lit("wikimedia").alias("source"), "license", "credit", "page",
                         F.col("fn").rlike("(?iU)" + illustration_pattern).alias("illu")).alias("w")))
    k = keys.join(per_name, "bare", "left")
    # JON9: the fallback source is joined only for keys without a photo
    need = k.where(F.col("w").isNull() | F.col("w.illu")).select(KEY)
    occ_needed = occ.join(need.select(F.col(KEY).alias("taxon_key")), "taxon_key", "left_semi")
    gb = (occurrence_media(occ_needed, occurrence_limit)
          .where(F.col("thumb").isNotNull() & (F.col("thumb") != ""))
          .select(KEY, F.struct("thumb", F.lit("gbif").alias("source"), "license", "credit", "page")
                  .alias("g")))
    k = k.join(gb, KEY, "left")
    w = F.struct(*[F.col(f"w.{c}").alias(c) for c in REC_FIELDS])
    rec = (F.when(F.col("w").isNotNull() & ~F.col("w.illu"), w)
            .when(F.col("g").isNotNull(), F.col("g"))
            .when(F.col("w").isNotNull(), w))
    out = k.select(KEY, rec.alias("rec"), F.coalesce(F.col("w.illu"), F.lit(False)).alias("_illu"))
    return out.where(F.col("rec").isNotNull()).select(
        KEY, *[F.col(f"rec.{c}").alias(c) for c in REC_FIELDS],
        (F.col("_illu") & (F.col("rec.source") == "wikimedia")).alias("illustration"))


def media_layer(picked: DataFrame) -> DataFrame:
    """MED4: the five published media columns per key."""
    return picked.select(KEY, F.col("thumb").alias("image_thumb"),
                         F.col("source").alias("image_source"),
                         F.col("license").alias("image_license"),
                         F.col("credit").alias("image_credit"),
                         F.col("page").alias("image_page"))


def media_provenance(picked: DataFrame) -> DataFrame:
    """MED5: one 'image' provenance row per key."""
    return picked.select(KEY, F.lit("image").alias("field"), F.col("thumb").alias("value"),
                         F.col("source").alias("source"), F.lit(100).alias("confidence"))


def media_coverage(spine: DataFrame, picked: DataFrame) -> DataFrame:
    """MED6: (total, have, wikimedia, gbif, illustration_fallback), one row."""
    j = spine.select(KEY).join(picked, KEY, "left")
    return j.agg(F.count(F.lit(1)).alias("total"),
                 F.count("source").alias("have"),
                 F.count_if(F.col("source") == "wikimedia").alias("wikimedia"),
                 F.count_if(F.col("source") == "gbif").alias("gbif"),
                 F.count_if(F.coalesce(F.col("illustration"), F.lit(False))).alias("illustration_fallback"))
