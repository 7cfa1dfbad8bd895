"""The driver's benchmark tables seen as catalogue inputs.

The benchmark tables are not flora data, so each catalogue input is *derived*
from them by a fixed rule over the whole table (no sampling, no id ranges):

* ``part`` rows are source records: name = ``p_name`` (a PROMO part carries a
  quoted cultivar suffix on its Latin name), fields brand/type/size/price and
  a region text made from the name tokens with a parenthesised note;
* the name-match table has one response per distinct ``p_name``; the response
  fields follow the name's first token (adjective) and second token (noun) so
  that every rung of the decision ladder occurs;
* ``lineitem`` rows are seller offers for the (name, brand) spine;
* ``labels`` give the status sets of ``documents``;
* ``events`` give the occurrence-media and checklist dumps.

The same rules are written in SQL in ``demo_sql`` for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.lookups import Profile
from verdant.operators.staging import eav_from_records, records_from_table

# FIXED VALUES of the parts demo domain (chosen for the demo; not flora values)
PARTS_REGION_ZONE = {
    "small": "compact", "large": "bulky", "ring": "round", "gear": "round",
    "plate": "flat", "rod": "long", "bolt": "long", "hot": "warm", "cold": "cool",
}
PARTS_LIFE_FORM_MAP = [
    ("old", "vintage"), ("gizmo", "device"), ("widget", "device"), ("ring", "round"),
    ("gear", "round"), ("bolt", "fastener"), ("rod", "bar"), ("hot", "heated"),
]
PARTS_STATUS_MAP = {
    "PROMO": "protected", "ECONOMY": "edible", "SMALL": "nectar", "LARGE": "red_list",
    "MEDIUM": "medicinal",
}

PARTS_PROFILE = Profile(
    source="part", identity_source="match", url_prefix="https://parts.example/item/",
    label_name_he="name", label_name_lat="name",
    scalar_labels={"name_ar": "brand", "bloom_months_he": "size", "habitat_he": "type",
                   "distribution_il": "regions", "leaf_shape": "price",
                   "leaf_margin": "margin", "stem_shape": "stem", "petals": "petals"},
    label_common_en="brand", label_life_form="name", label_statuses="type",
    label_distribution="regions", status_map=dict(PARTS_STATUS_MAP),
    region_zone=dict(PARTS_REGION_ZONE), life_form_map=list(PARTS_LIFE_FORM_MAP),
)

SELLER = "shop"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name-match table derived from ``part``."""
    return match_table(table(spark, sf_dir, "part"))


def part_records_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as source records."""
    return part_records(table(spark, sf_dir, "part"))


def adjective(c) -> F.Column:
    return F.split_part(c, F.lit(" "), F.lit(1))


def noun(c) -> F.Column:
    return F.split_part(c, F.lit(" "), F.lit(2))


def part_records(part: DataFrame) -> DataFrame:
    """Part rows as snapshot records (source, source_id, names, fields map)."""
    p = part.select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice",
        F.concat(F.col("p_name"), F.when(F.col("p_type") == "PROMO", F.lit(" 'Select'"))
                 .otherwise(F.lit(""))).alias("name_lat"),
        F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")),
                 F.when(F.col("p_size") > 25, F.concat(F.lit(" ("), F.col("p_type"), F.lit(")")))
                  .otherwise(F.concat(F.lit(" ("), F.lower("p_brand"), F.lit(", "),
                                      F.col("p_type"), F.lit(")")))).alias("regions"))
    return records_from_table(p, "part", "p_partkey", "p_name", "name_lat",
                              {"name": "p_name", "brand": "p_brand", "type": "p_type",
                               "size": "p_size", "price": "p_retailprice",
                               "regions": "regions"})


def part_eav(part: DataFrame) -> DataFrame:
    return eav_from_records(part_records(part))


def match_table(part: DataFrame) -> DataFrame:
    """One name-match response per distinct part name (rules in module doc)."""
    base = part.groupBy("p_name").agg(
        F.min("p_partkey").alias("usage_key"),
        F.min_by("p_type", "p_partkey").alias("fam"),
        F.count(F.lit(1)).alias("n"))
    acc = base.select(F.col("p_name").alias("_acc_name"), F.col("usage_key").alias("_acc_key"))
    adj, nn = adjective(F.col("p_name")), noun(F.col("p_name"))
    b = base.withColumn("_target", F.when(adj == "new", F.concat(F.lit("old "), nn)))
    b = b.join(acc, b["_target"] == acc["_acc_name"], "left")
    return b.select(
        F.lower("p_name").alias("name_key"),
        F.col("usage_key").cast("bigint").alias("usageKey"),
        F.col("_acc_key").cast("bigint").alias("acceptedUsageKey"),
        F.col("p_name").alias("scientificName"),
        F.col("_target").alias("accepted"),
        F.when(adj == "large", "GENUS").when(nn == "rod", F.lit(None)).otherwise("SPECIES").alias("rank"),
        F.when(adj == "new", "SYNONYM").otherwise("ACCEPTED").alias("status"),
        F.when(adj == "cold", "NONE").when(adj == "large", "HIGHERRANK")
         .when(adj == "hot", "FUZZY").otherwise("EXACT").alias("matchType"),
        F.when(adj == "red", 85).when(adj == "blue", 88)
         .otherwise(90 + F.col("n") % 10).cast("int").alias("confidence"),
        F.when(nn == "anvil", "Animalia").when(nn == "gizmo", F.lit(None))
         .otherwise("Plantae").alias("kingdom"),
        F.col("fam").alias("family"), nn.alias("genus"))


def offer_spine(part: DataFrame) -> DataFrame:
    """Spine for the offer layer: one key per (name, brand), lowest part key."""
    nm = F.concat(F.col("p_name"), F.lit(" "), F.lower("p_brand"))
    return (part.groupBy(nm.alias("name_he")).agg(F.min("p_partkey").alias("canonical_taxon_id")))


def offers(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Seller records: one per line item (name form follows the return flag)."""
    li = lineitem.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand"),
                       "l_partkey")
    full = F.concat(F.col("p_name"), F.lit(" "), F.lower("p_brand"))
    short = F.concat(adjective(F.col("p_name")), F.lit(" "), F.lower("p_brand"))
    name = (F.when(F.col("l_returnflag") == "R", full)
             .when(F.col("l_returnflag") == "A", short)
             .otherwise(adjective(F.col("p_name"))))
    return li.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("source_id"),
        name.alias("name_he"), F.col("p_name").alias("part_name"),
        F.col("l_returnflag").alias("category"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.array(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" l"))).alias("pot_sizes"),
        F.when(F.col("l_linestatus") == "O", "in_stock").otherwise("out_of_stock").alias("availability"),
        F.concat(F.lit("https://shop.example/p/"), F.col("l_partkey").cast("string"), F.lit("/"),
                 F.col("l_suppkey").cast("string")).alias("url"))


def media_inputs(part: DataFrame, events: DataFrame):
    """(spine, pairs, files, flat occurrences) for the media layer.

    spine: one key per part name (lowest part key), scientific name = p_name;
    pairs: every part gives its name a file ``<name>_<brand>[_drawing].jpg``;
    files: one metadata record per file name (thumb missing for SMALL parts);
    occurrences: each event is an occurrence of taxon ``props.k``, ordered by
    (ts, event_id), with one media item whose identifier exists for views and
    clicks.
    """
    spine = part.groupBy(F.col("p_name").alias("scientific_name")).agg(
        F.min("p_partkey").alias("canonical_taxon_id"))
    fn = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("_"),
                  F.replace(F.col("p_brand"), F.lit("#"), F.lit("")),
                  F.when(F.col("p_size") > 40, F.lit("_drawing")).otherwise(F.lit("")), F.lit(".jpg"))
    pf = part.select(F.col("p_name").alias("n"), fn.alias("fn"), "p_type", "p_brand")
    pairs = pf.select("n", F.concat(F.lit("http://commons.example/wiki/Special:FilePath/"),
                                    F.col("fn")).alias("img"))
    files = (pf.groupBy("fn").agg(F.min("p_type").alias("p_type"), F.min("p_brand").alias("p_brand"))
               .select(F.concat(F.lit("File:"), F.col("fn")).alias("title"),
                       F.array(F.struct(
                           F.when(F.col("p_type") != "SMALL",
                                  F.concat(F.lit("http://thumbs.example/"), F.col("fn"))).alias("thumburl"),
                           F.when(F.col("p_type") != "MEDIUM",
                                  F.concat(F.lit("http://img.example/"), F.col("fn"))).alias("url"),
                           F.concat(F.lit("https://commons.example/page/"), F.col("fn")).alias("descriptionurl"),
                           F.struct(F.struct(F.col("p_brand").alias("value")).alias("LicenseShortName"),
                                    F.struct(F.concat(F.lit("<b>"), F.col("p_type"),
                                                      F.lit("</b> &amp; co")).alias("value")).alias("Artist"))
                            .alias("extmetadata"))).alias("imageinfo")))
    ev = events.select(
        F.get_json_object("props", "$.k").cast("bigint").alias("taxon_key"),
        F.struct("ts", "event_id").alias("occ_order"),
        F.concat(F.lit("https://occ.example/"), F.col("event_id").cast("string")).alias("references"),
        F.lit(0).alias("media_pos"),
        F.when(F.col("event_type").isin("view", "click"),
               F.concat(F.lit("http://media.example/"), F.col("event_id").cast("string"))).alias("identifier"),
        F.col("event_type").alias("license"),
        F.when(F.col("value") > 20, F.concat(F.lit("user"), F.col("user_id").cast("string"))).alias("rightsHolder"),
        F.concat(F.lit("creator"), F.col("user_id").cast("string")).alias("creator"))
    return spine, pairs, files, ev


def checklist_pages(events: DataFrame, page_size: int = 300) -> DataFrame:
    """Events as a paged checklist dump: page = event_id div page_size, items in
    event order (pages hold at most ``page_size`` items by construction)."""
    item = F.struct(
        F.col("event_id"),
        F.when(F.col("event_type") != "error", "Plantae").otherwise("Animalia").alias("kingdom"),
        F.when(F.col("event_type") != "signup",
               F.get_json_object("props", "$.k").cast("bigint")).alias("nubKey"),
        F.when(F.col("value") < 50, F.concat(F.lit("Taxon "), F.col("event_id").cast("string")))
         .alias("scientificName"),
        F.concat(F.lit("taxon-"), F.col("user_id").cast("string")).alias("canonicalName"))
    pages = events.groupBy(F.floor(F.col("event_id") / page_size).alias("page_no")).agg(
        F.array_sort(F.collect_list(item)).alias("_items"))
    return pages.select("page_no", F.transform("_items", lambda x: F.struct(
        x["kingdom"].alias("kingdom"), x["nubKey"].alias("nubKey"),
        x["scientificName"].alias("scientificName"),
        x["canonicalName"].alias("canonicalName"))).alias("results"))
