"""Offer layer (JON3-JON6, OFR1-OFR6): seller records onto the spine.

Matching works on distinct normalised seller names:

* exact: normalised spine name -> lowest key (JON3);
* containment (JON4), for the names left: same first token and every seller
  token present in the spine name, accepted only if exactly one distinct key
  qualifies.  Names of one or two tokens take the (min key, max key) of their
  postings.  Any other name probes one posting list: the spine names that hold
  its first token and the *rarest* of its other tokens beside it, or, where that
  list is long (:data:`HOT`), its two rarest tokens together.  The tokens
  of a candidate are then compared.  Every length of name gets the same answers,
  and they are folded to (min key, max key) map-side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.functions.enums import price_band
from verdant.functions.text import norm_local_name, tokens

KEY = "canonical_taxon_id"
HOT = 1024      # spine names under one (first, other) token pair, beyond which two other tokens are the key


def spine_index(spine: DataFrame, name_col: str = "name_he") -> DataFrame:
    """Normalised non-empty spine names: (key, n, first, rest)."""
    s = spine.where(F.col(name_col).isNotNull()).select(
        KEY, norm_local_name(F.col(name_col)).alias("n"))
    s = s.where(F.col("n") != "")
    t = F.array_distinct(tokens(F.col("n")))
    return s.select(KEY, "n", F.get(t, 0).alias("first"),
                    F.array_sort(F.array_remove(t, F.get(t, 0))).alias("rest"))


def exact_index(idx: DataFrame) -> DataFrame:
    """JON3 build side: one key per normalised name (lowest key wins)."""
    return idx.groupBy("n").agg(F.min(KEY).alias("_exact_key"))


def containment_keys(q: DataFrame, idx: DataFrame, hot: int = HOT) -> DataFrame:
    """JON4: ``q`` (n, first, rest) -> (n, _cmin, _cmax), the least and greatest
    key of the spine names that contain all tokens of ``n``.

    Names of one or two tokens are answered by aggregates of the postings.  Longer ones
    probe the postings of their rarest token beside the first; where more than ``hot``
    spine names hold even that one, the postings of their two rarest tokens together."""
    ends = [F.min(KEY).alias("_cmin"), F.max(KEY).alias("_cmax")]
    single = (q.where(F.size("rest") == 0).join(idx.groupBy("first").agg(*ends), "first")
              .select("n", "_cmin", "_cmax"))
    posts = idx.select(KEY, "first", "rest", F.explode("rest").alias("tok"))
    count = posts.groupBy("first", "tok").agg(F.count(F.lit(1)).alias("c"), *ends)
    probe = (q.select("n", "first", F.col("rest").alias("_want"), F.explode("rest").alias("tok"))
             .join(count, ["first", "tok"])
             .groupBy("n", "first", "_want")
             .agg(F.array_sort(F.collect_list(F.struct("c", "tok"))).alias("by"),     # the name's own tokens
                  F.min("_cmin").alias("_cmin"), F.max("_cmax").alias("_cmax"))
             .where(F.size("by") == F.size("_want")))             # every token occurs beside the first
    two = probe.where(F.size("_want") == 1).select("n", "_cmin", "_cmax")
    longer = probe.where(F.size("_want") > 1).select("n", "first", "_want", F.col("by")[0]["c"].alias("c"),
                                                     F.col("by")[0]["tok"].alias("tok"), F.col("by")[1]["tok"].alias("tok2"))
    rare = longer.where(F.col("c") <= hot).join(posts, ["first", "tok"])
    # tokens that many names hold: two of them are the key
    often = count.where(F.col("c") > hot).select("first", "tok")
    pairs = (posts.join(often, ["first", "tok"]).groupBy(KEY, "first", "rest")
             .agg(F.array_sort(F.collect_set("tok")).alias("toks"))                   # of one spine name
             .select(KEY, "first", "rest", F.posexplode("toks").alias("i", "tok"), "toks")
             .select(KEY, "first", "rest", "tok", F.explode(F.expr("slice(toks, i + 2, size(toks))")).alias("tok2")))
    wide = (longer.where(F.col("c") > hot)
            .select("n", "first", "_want", F.least("tok", "tok2").alias("tok"), F.greatest("tok", "tok2").alias("tok2"))
            .join(pairs, ["first", "tok", "tok2"]))
    several = (rare.select("n", "_want", KEY, "rest").unionByName(wide.select("n", "_want", KEY, "rest"))
               .where(F.size(F.array_except("_want", "rest")) == 0).groupBy("n").agg(*ends))
    return single.unionByName(two).unionByName(several)


def match_names(names: DataFrame, spine: DataFrame, name_col: str = "name_he", containment: bool = True,
                keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """JON5 on distinct seller names: (name, n, key, how).

    The normalised names of both sides are read by several branches; ``keep`` (a
    reliable checkpoint, or a written table) makes them once.  ``containment=False``
    stops after the exact matches (JON3)."""
    keep = keep or (lambda df: df)
    idx = keep(spine_index(spine, name_col))
    q = keep(names.select("name").distinct().withColumn("n", norm_local_name(F.col("name"))))
    t = F.array_distinct(tokens(F.col("n")))
    first = F.get(t, 0)
    # empty names meet nothing: they are kept out of the joins' keys
    asked = (q.where(F.col("n") != "").select("n").distinct()
             .join(exact_index(idx), "n", "left"))
    if containment:
        left = asked.where(F.col("_exact_key").isNull()).select(
            "n", first.alias("first"), F.array_sort(F.array_remove(t, first)).alias("rest"))
        answers = asked.join(containment_keys(left, idx), "n", "left")
    else:
        none = F.lit(None).cast(spine.schema[KEY].dataType)
        answers = asked.select("*", none.alias("_cmin"), none.alias("_cmax"))
    answers = answers.withColumnRenamed("n", "_n")
    q = q.join(answers, F.nullif(F.col("n"), F.lit("")) == F.col("_n"), "left")
    cmin, cmax = F.col("_cmin"), F.col("_cmax")
    unique = cmin.isNotNull() & (cmin == cmax)
    key = (F.when(F.col("n") == "", F.lit(None))
             .when(F.col("_exact_key").isNotNull(), F.col("_exact_key"))
             .when(unique, cmin))
    how = (F.when(F.col("n") == "", F.lit(None))
            .when(F.col("_exact_key").isNotNull(), F.lit("exact"))
            .when(unique, F.lit("genus_containment")))
    return q.select("name", "n", key.cast("bigint").alias(KEY), how.alias("how"))


def match_offers(offers: DataFrame, spine: DataFrame, name_col: str = "name_he",
                 spine_name_col: str = "name_he", containment: bool = True,
                 keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Every offer with its matched key and method (null when unmatched)."""
    m = match_names(offers.select(F.coalesce(F.col(name_col), F.lit("")).alias("name")),
                    spine, spine_name_col, containment, keep)
    o = offers.withColumn("_mname", F.coalesce(F.col(name_col), F.lit("")))
    return o.join(m.select(F.col("name").alias("_mname"), KEY, "how"), "_mname", "left").drop("_mname")


def unmatched(matched: DataFrame) -> DataFrame:
    """JON6 / SNK6: offers without a key (5 columns)."""
    return matched.where(F.col(KEY).isNull()).select(
        "source_id", "name_he", "category", "price", "url")


def offers_by_key(matched: DataFrame, seller: str) -> DataFrame:
    """OFR1-OFR3, OFR6: one row per key.

    Two aggregates, as in reconciliation: every offer contributes one stats
    row plus one row per pot size and one for its URL; aggregate 1 over
    (key, kind, value) computes the stats (map-side combinable) and
    deduplicates sizes and URLs; aggregate 2 over the key gathers the
    distinct values, so a key with many listings never holds more than its
    output row.
    """
    m = matched.where(F.col(KEY).isNotNull())
    tag = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("value"))
    rows = F.concat(F.array(tag("_o", F.lit(None)), tag("url", F.col("url"))),
                    F.transform(F.coalesce(F.col("pot_sizes"), F.array().cast("array<string>")),
                                lambda x: tag("size", x)))
    ex = m.select(KEY, "price", "availability", F.explode(rows).alias("_t"))
    is_o = F.col("_t.kind") == "_o"
    a1 = ex.groupBy(KEY, F.col("_t.kind").alias("kind"), F.col("_t.value").alias("value")).agg(
        F.min(F.when(is_o, F.col("price"))).alias("price_ils"),
        F.max(F.when(is_o, F.col("availability") == "in_stock")).alias("_any_in"),
        F.count(F.when(is_o, F.lit(1))).alias("listings"),
        F.count(F.when(is_o, F.col("price"))).alias("n_prices"))
    o = F.col("kind") == "_o"
    agg = a1.groupBy(KEY).agg(
        F.max(F.when(o, F.col("price_ils"))).alias("price_ils"),
        F.max(F.when(o, F.col("_any_in"))).alias("_any_in"),
        F.sum(F.when(o, F.col("listings"))).alias("listings"),
        F.sum(F.when(o, F.col("n_prices"))).alias("n_prices"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "size", F.col("value")))).alias("pot_sizes"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "url", F.col("value")))).alias("source_urls"))
    return agg.select(
        KEY, F.array(F.lit(seller)).alias("sold_by"), "pot_sizes", "price_ils",
        price_band(F.col("price_ils")).alias("price_band"),
        F.when(F.coalesce("_any_in", F.lit(False)), "in_stock").otherwise("out_of_stock")
         .alias("availability"),
        "source_urls", "listings", "n_prices",
        ((F.col("n_prices") > 1) | (F.col("listings") > 1)).alias("conflict"))


def offer_values(matched: DataFrame) -> DataFrame:
    """OFR1-OFR3 in long form: one row per (key, kind, value), ``kind`` being ``url`` or
    ``size``, with the listings that state it, their lowest price and whether one is in stock."""
    m = matched.where(F.col(KEY).isNotNull())
    tag = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("value"))
    sizes = F.transform(F.array_distinct(F.coalesce(F.col("pot_sizes"), F.array().cast("array<string>"))),
                        lambda x: tag("size", x))
    ex = m.select(KEY, "price", "availability", F.explode(F.concat(F.array(tag("url", F.col("url"))), sizes)).alias("t"))
    return (ex.where(F.col("t.value").isNotNull())
            .groupBy(KEY, F.col("t.kind").alias("kind"), F.col("t.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("listings"), F.min("price").alias("price_ils"),
                 F.coalesce(F.max(F.col("availability") == "in_stock"), F.lit(False)).alias("in_stock")))


def offer_provenance(matched: DataFrame, seller: str | Column) -> DataFrame:
    """OFR4: one row per seller value (not deduplicated); ``seller`` is a name, or a
    column where one table holds the offers of several."""
    m = matched.where(F.col(KEY).isNotNull())
    s = F.lit(seller) if isinstance(seller, str) else seller

    def row(field, value, keep=F.lit(True)):
        return F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"),
                        keep.alias("_keep"))

    sizes = F.transform(F.coalesce(F.col("pot_sizes"), F.array().cast("array<string>")),
                        lambda x: row("pot_sizes", x))
    rows = F.concat(F.array(row("sold_by", s),
                            row("price_ils", F.col("price"), F.col("price").isNotNull())),
                    sizes,
                    F.array(row("availability", F.col("availability")),
                            row("match_method", F.col("how"))))
    ex = m.select(KEY, s.alias("source"), F.explode(rows).alias("p")).where(F.col("p._keep"))
    return ex.select(KEY, F.col("p.field").alias("field"), F.col("p.value").alias("value"),
                     "source", F.lit(100).alias("confidence"))
