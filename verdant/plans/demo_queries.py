"""Registered queries over the driver's tables (one per operator group).

Every query reads whole tables; list outputs are rendered as text with '|'
(the surface's own list-to-text rule, NRM14) so results compare across
engines.  The matching oracle SQL is in ``demo_sql``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.functions import display as D
from verdant.functions import enums as E
from verdant.functions import text as T
from verdant.operators import extract as X
from verdant.operators import media as M
from verdant.operators import offers as O
from verdant.operators import reconcile as R
from verdant.operators import resolve as RS
from verdant.operators import staging as S
from verdant.operators import status as ST
from verdant.operators.layers import OFFER_COLUMNS, attach_layer, replace_provenance
from verdant.lookups import OCCURRENCE_LIMIT, Profile
from verdant.plans import gates as G
from verdant.plans import surface as Q
from verdant.plans.demo_inputs import (PARTS_PROFILE, SELLER, checklist_pages, media_inputs,
                                       offer_spine, offers, part_eav, part_match, part_records,
                                       part_records_of, table)
from verdant.session import written
from verdant.sources.sitemap import products_from_urls

KEY = "canonical_taxon_id"

# FIXED VALUES of the page demo (patterns over the driver's generated pages)
NAV_PAIR = r'(?s)<li><a href="/([^"]*)">(.*?)</a></li>'
NAV_HREF = r'(?s)<li><a href="/([^"]*)">'
H1 = r"(?s)<h1>(.*?)</h1>"
URL_PRICE_BLOCK = r"/[a-z][a-z]/([^/?#]*)"
WHOLE = r"(?s)^(.*)$"
NUMBER_TOKENS = r"ad [0-9]+|track\([0-9]+\)"
SPAM_MARKER = "cheap-pills"
STOCK_MARKER = "&middot;"
NAME_LABELS = ("and", "the")


def _lists_as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.array_join(F.col(f.name), "|").alias(f.name)
                       if f.dataType.typeName() == "array" else F.col(f.name)
                       for f in df.schema.fields])


# --------------------------------------------------------------- extraction

def extract_pairs(spark, sf):
    pages = table(spark, sf, "pages")
    return X.page_pairs(pages, "page_id", "html", NAV_PAIR).drop("pos")


def extract_status_list(spark, sf):
    pages = table(spark, sf, "pages")
    df = X.with_pot_sizes(X.with_status_text(pages, "html", NAV_HREF, "statuses"), "html",
                          NUMBER_TOKENS, "pot_sizes")
    return df.select("page_id", "statuses", F.array_join("pot_sizes", "|").alias("pot_sizes"))


def extract_record(spark, sf):
    pages = table(spark, sf, "pages")
    prof = Profile(label_name_he=NAME_LABELS[0], label_name_lat=NAME_LABELS[1])
    # one pass: record fields first, then the product fields from the kept HTML and URL
    recs = X.extract_records(pages, "pages", "2026-06-25", profile=prof,
                             pair_pattern=NAV_PAIR, status_pattern=NAV_HREF,
                             block_marker=SPAM_MARKER, keep=("html",))
    recs = recs.select(F.col("source_id").alias("rec_id"), F.col("url").alias("rec_url"), "html",
                       F.col("outcome").alias("rec_outcome"), F.col("name_he").alias("label_and"),
                       F.col("name_lat").alias("label_the"))
    prods = X.extract_products(
        recs, "pages", "2026-06-25", id_col="rec_id", url_col="rec_url", category_col=None,
        title_pattern=H1, price_text=F.col("rec_url"), block_pattern=URL_PRICE_BLOCK,
        amount_pattern=WHOLE, pot_pattern=NUMBER_TOKENS, out_marker=STOCK_MARKER,
        keep=("rec_outcome", "label_and", "label_the"))
    return prods.select("source_id", F.col("rec_outcome").alias("outcome"), "label_and", "label_the",
                        F.col("name_he").alias("title"), "price", "availability",
                        F.col("outcome").alias("product_outcome"))


def clean_text(spark, sf):
    pages = table(spark, sf, "pages")
    raw = F.regexp_extract(F.col("html"), H1, 1)
    return pages.select("page_id", T.clean_text(raw).alias("title"),
                        T.clean_credit(raw).alias("credit"))


def url_parts(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", T.https(F.col("url")).alias("loc"))
    out = products_from_urls(pages, "loc", anchor="https:", categories=None)
    return out.select("page_id", "loc", F.col("category").alias("host"), "slug",
                      T.file_name(F.col("loc")).alias("file_name"))


# ------------------------------------------------------------------ staging

def stage_eav(spark, sf):
    part = table(spark, sf, "part")
    cust = table(spark, sf, "customer")
    a = part_eav(part)
    c = S.eav_from_records(S.records_from_table(
        cust, "customer", "c_custkey", "c_mktsegment", "c_name",
        {"name": "c_name", "nation": "c_nationkey", "balance": "c_acctbal",
         "segment": "c_mktsegment"}))
    return a.unionByName(c).drop("scraped_at")


def pivot_records(spark, sf):
    eav = part_eav(table(spark, sf, "part"))
    return S.pivot_records(eav, ["name", "brand", "type", "size", "price", "regions"]).drop(
        "scraped_at", "source")


def crosswalk(spark, sf):
    return S.crosswalk(part_eav(table(spark, sf, "part")), "part")


# ------------------------------------------------------------ normalisation

def normalize_names(spark, sf):
    docs = table(spark, sf, "documents")
    n = T.normalize_name(F.col("text"))
    return docs.select("doc_id", n.alias("name"), T.is_latin(n).alias("latin"))


def _quoted_names(part):
    suffix = (F.when(F.col("p_type") == "PROMO", F.lit(" 'Gold'"))
               .when(F.col("p_type") == "SMALL", F.lit(' "Mini"')).otherwise(F.lit("")))
    return part.select("p_partkey", F.concat(F.col("p_name"), suffix).alias("raw"))


def strip_quotes(spark, sf):
    q = _quoted_names(table(spark, sf, "part"))
    s = T.strip_cultivar(F.col("raw"))
    return q.select("p_partkey", s.alias("stripped"), T.bare_binomial(F.upper("raw")).alias("binomial"),
                    T.bare_name(F.col("raw")).alias("bare"), T.norm_local_name(F.col("raw")).alias("norm"))


def enum_map(spark, sf):
    part = table(spark, sf, "part")
    st = E.split_statuses(F.concat(F.col("p_type"), F.lit("; ; "), F.upper(F.col("p_brand"))))
    return part.select("p_partkey",
                       E.ordered_enum(F.col("p_name"), PARTS_PROFILE.life_form_map).alias("life_form"),
                       *E.status_flags(st, PARTS_PROFILE.status_map))


def split_map_list(spark, sf):
    recs = part_records(table(spark, sf, "part"))
    txt = F.col("fields")["regions"]
    regions = E.split_regions(txt, PARTS_PROFILE.region_zone)
    return recs.select(
        F.col("source_id"), F.array_join(regions, "|").alias("regions"),
        F.array_join(E.zones(regions, PARTS_PROFILE.region_zone), "|").alias("zones"),
        T.url_from_id(F.col("source_id"), PARTS_PROFILE.url_prefix).alias("url"),
        F.array_join(D.display_list(txt), "|").alias("display"))


def price_bands(spark, sf):
    li = table(spark, sf, "lineitem")
    price = F.col("l_extendedprice") / 500.0
    return li.select("l_orderkey", "l_linenumber", price.alias("price"),
                     E.price_band(price).alias("band"))


# ---------------------------------------------------------------- resolving

def _resolve_inputs(spark, sf):
    recs = part_records_of(spark, sf)
    lang = F.when(F.col("fields")["size"] == "1", F.lit("he")).otherwise(F.lit("lat"))
    return recs.withColumn("lang", lang)


def resolve_ladder(spark, sf):
    part = table(spark, sf, "part")
    recs = _resolve_inputs(spark, sf)
    res = RS.resolve_records(recs, part_match(spark, sf), "name_lat", F.col("lang"), PARTS_PROFILE)
    return res.select("source_id", *RS.RESULT_COLUMNS)


def resolve_incremental(spark, sf):
    part = table(spark, sf, "part")
    recs = _resolve_inputs(spark, sf)
    names = recs.select(F.col("name_lat").alias("input_name"), F.col("lang").alias("input_lang"))
    m = part_match(spark, sf)
    first = RS.cache_stats(names, m, PARTS_PROFILE)
    # RES7 + RES8: the misses are answered by the matcher against a backbone
    # made from the part names, and appended to the match table
    from verdant.operators.matcher import responses_for
    misses = RS.unseen_keys(names, m, PARTS_PROFILE)
    backbone = part.groupBy(F.col("p_name").alias("name")).agg(
        F.min("p_partkey").alias("key"))
    m2 = RS.extend_match_table(m, responses_for(misses, backbone))
    second = RS.cache_stats(names, m2, PARTS_PROFILE)
    return (first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2))))


def resolve_fuzzy(spark, sf):
    from verdant.operators.matcher import match_names_fuzzy
    part = table(spark, sf, "part")
    backbone = part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("key"))
    typo = F.concat(F.substring("p_name", 1, 2), F.substring("p_name", 4, 100))
    queries = part.select(typo.alias("input_name")).distinct()
    return match_names_fuzzy(queries, backbone)


def resolve_listed(spark, sf):
    part = table(spark, sf, "part")
    lines = part.select(F.concat(F.lit(" "), F.col("p_name"), F.lit(" ,"), F.col("p_type"),
                                 F.lit(","), F.col("p_brand")).alias("value"))
    names = ST.curated_names(lines)
    res = RS.resolve_names(names.select(F.col("name").alias("input_name"),
                                        F.lit("lat").alias("input_lang")), part_match(spark, sf),
                           PARTS_PROFILE)
    return res.select(F.col("input_name").alias("name"), "status", KEY, "reason")


def resolve_crosswalk(spark, sf):
    part = table(spark, sf, "part")
    recs = part_records(part)
    xw = S.crosswalk(S.eav_from_records(recs), "part")
    # SMALL parts arrive with their local name only
    loc = recs.select("source_id", "name_he",
                      F.when(F.col("fields")["type"] != "SMALL", F.col("name_lat")).alias("name_lat"))
    res = RS.resolve_via_crosswalk(loc, xw, part_match(spark, sf), PARTS_PROFILE)
    return res.select("source_id", "status", KEY, "reason")


# -------------------------------------------------------------- reconciling

def _resolved(spark, sf):
    """Every part record with its resolution: one row per record."""
    recs = S.pivot_records(part_eav(table(spark, sf, "part")), PARTS_PROFILE.labels)
    return RS.resolve_records(recs, part_match(spark, sf), "name_lat", "lat", PARTS_PROFILE)


def _reconciled(spark, sf):
    """The reconciled part spine."""
    ok, _ = RS.split_review(_resolved(spark, sf))
    return R.reconcile(ok, None, PARTS_PROFILE)


def reconcile_rows(spark, sf):
    return _lists_as_text(R.canonical_table(_reconciled(spark, sf)))


def provenance_rows(spark, sf):
    return R.provenance(_reconciled(spark, sf), PARTS_PROFILE)


def status_layer(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias(KEY))
    lab = table(spark, sf, "labels")
    listed = lab.where(F.col("toxic") == 1).select(F.col("doc_id").alias(KEY))
    check = lab.where(F.col("quality") == 0).select(F.col("doc_id").alias(KEY))
    st = ST.status_frame(listed, ST.potential_keys(check, listed))
    return ST.apply_status(docs, st)


def checklist(spark, sf):
    return ST.checklist_keys(checklist_pages(table(spark, sf, "events")))


# ------------------------------------------------------------------- offers

def _matched(spark, sf, containment=True):
    """Line-item offers matched onto the (name, brand) spine; both sides' names are made once."""
    part = table(spark, sf, "part")
    return O.match_offers(offers(table(spark, sf, "lineitem"), part), offer_spine(part),
                          containment=containment, keep=written), part


def match_exact(spark, sf):
    m, _ = _matched(spark, sf, containment=False)
    return m.where(F.col("how") == "exact").select("l_orderkey", "l_linenumber", KEY)


def match_containment(spark, sf):
    part = table(spark, sf, "part")
    o = offers(table(spark, sf, "lineitem"), part)
    res = O.match_names(o.select(F.col("name_he").alias("name")), offer_spine(part), keep=written)
    return res.select("name", KEY, "how")


def unmatched_offers(spark, sf):
    m, _ = _matched(spark, sf)
    return O.unmatched(m)


def offers_by_key(spark, sf):
    m, _ = _matched(spark, sf)
    return _lists_as_text(O.offers_by_key(m, SELLER))


def offer_values(spark, sf):
    m, _ = _matched(spark, sf)
    return O.offer_values(m)


def offer_provenance(spark, sf):
    m, _ = _matched(spark, sf)
    m = written(m.select(KEY, "price", "pot_sizes", "availability", "how"), "matched")
    new = O.offer_provenance(m, SELLER)
    # the table before: an older run of the seller and the same rows of a market;
    # re-running the layer replaces the seller's rows and leaves the market's
    old = (O.offer_provenance(m.withColumn("availability", F.lit("stale")), SELLER)
           .unionByName(O.offer_provenance(m, "market").where(F.col("field") == "match_method")))
    return replace_provenance(old, new, source=SELLER)


def attach_layer_q(spark, sf):
    m, part = _matched(spark, sf)
    out = attach_layer(offer_spine(part), O.offers_by_key(m, SELLER), OFFER_COLUMNS)
    return _lists_as_text(out.select(KEY, "name_he", *OFFER_COLUMNS))


def offer_gate(spark, sf):
    m, part = _matched(spark, sf)
    m = written(m.select(KEY, "price", "pot_sizes", "availability", "url"), "matched")
    spine = offer_spine(part)
    by_key = O.offers_by_key(m, SELLER)
    return G.phase3_gate(m, spine, attach_layer(spine, by_key, OFFER_COLUMNS), by_key)


# -------------------------------------------------------------------- media

def media_pick(spark, sf):
    spine, pairs, files, occ = media_inputs(table(spark, sf, "part"), table(spark, sf, "events"))
    return M.pick_media(spine, pairs, files, occ, occurrence_limit=OCCURRENCE_LIMIT)


def media_coverage(spark, sf):
    spine, pairs, files, occ = media_inputs(table(spark, sf, "part"), table(spark, sf, "events"))
    return M.media_coverage(spine, M.pick_media(spine, pairs, files, occ, occurrence_limit=OCCURRENCE_LIMIT))


# ------------------------------------------------------------------ surface

def _catalog(spark, sf):
    """Reconciled part spine with its offers attached."""
    rec = written(R.canonical_table(_reconciled(spark, sf)), "spine")
    part = table(spark, sf, "part")
    o = offers(table(spark, sf, "lineitem"), part)
    spine_names = rec.select(KEY, F.col("name_he"))
    m = O.match_offers(o.withColumn("name_he", F.col("part_name")), spine_names, keep=written)
    return attach_layer(rec, O.offers_by_key(m, SELLER), OFFER_COLUMNS)


def search_text(spark, sf):
    docs = table(spark, sf, "documents")
    q = Q.CatalogQuery(search="th_t ", search_columns=("text", "source"))
    return q.where(docs).select("doc_id", "lang")


def filter_combo(spark, sf):
    cat = _catalog(spark, sf)
    q = Q.CatalogQuery(zone="round", special="edible", month="4", search="e")
    return q.matches(cat).select("id", "name_he", "life_form", "zones", "bloom_months_he")


def sorted_page(spark, sf):
    cat = _catalog(spark, sf)
    q = Q.CatalogQuery(sort="price")
    page = q.matches(cat).orderBy(*q.order()).limit(q.limit)
    return page.select("id", "name_he", "price_ils", "price_band", "sold_by", "statuses", "regions",
                       D.bloom_short(F.col("regions")).alias("bloom_short"),
                       D.badge(F.col("red_list"), F.col("invasive_status"), F.col("protected"))
                        .alias("badge"))


SURFACE_FILTERS = {
    "life_form": dict(life_form="device"), "invasive_status": dict(invasive_status="not_listed"),
    "habitat": dict(habitat="PROMO"), "region": dict(region="ring"), "month": dict(month="4"),
    "for_sale": dict(for_sale=True), "poisonous": dict(special="poisonous"),
}


def surface_filters(spark, sf):
    """The ids that each filter of the surface lets through, in one pass."""
    hits = [F.when(reduce(lambda a, b: a & b, Q.CatalogQuery(**kw).predicates()), F.lit(name))
            for name, kw in SURFACE_FILTERS.items()]
    return _catalog(spark, sf).select(
        F.col(KEY).cast("string").alias("id"),
        F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("filter"))


def two_pages(spark, sf):
    """Two short pages by scientific name: the limit bites."""
    q = Q.CatalogQuery(sort="scientific_name", limit=5)
    return q.page(_catalog(spark, sf), pages=2).select("id", "scientific_name", "name_he", "availability")


def facets_ranked(spark, sf):
    return Q.facet_ranked(table(spark, sf, "orders"), "o_orderpriority")


def facets(spark, sf):
    return Q.facet(table(spark, sf, "orders"), "o_orderpriority")


def facet_array(spark, sf):
    return Q.array_facet(R.canonical_table(_reconciled(spark, sf)), "distribution_regions", "region")


def stats(spark, sf):
    return Q.stats(_catalog(spark, sf))


def lookup_one(spark, sf):
    rec = _reconciled(spark, sf)
    prov = R.provenance(rec, PARTS_PROFILE)
    first = rec.agg(F.min(KEY).alias("_k"))
    return prov.join(first, prov[KEY] == first["_k"], "left_semi")


def conflicts(spark, sf):
    m, _ = _matched(spark, sf)
    return _lists_as_text(R.conflicts(O.offer_provenance(m, SELLER)))


def conflict_values(spark, sf):
    m, _ = _matched(spark, sf)
    return R.conflict_values(O.offer_provenance(m, SELLER))


def precedence(spark, sf):
    m, _ = _matched(spark, sf)
    # the shop's offers, and the same ones in a market's hands: one pass
    sold = F.array(F.struct(F.lit(SELLER).alias("seller"), F.col("availability")),
                   F.struct(F.lit("market").alias("seller"), F.lit("in_stock").alias("availability")))
    both = m.select(KEY, "price", "pot_sizes", "how", F.explode(sold).alias("s")).select(
        KEY, "price", "pot_sizes", "how", "s.seller", "s.availability")
    return R.precedence(O.offer_provenance(both, F.col("seller")), {"market": 0, SELLER: 1})


def gates(spark, sf):
    res = _resolved(spark, sf)
    ok, review = RS.split_review(res)
    rec = _reconciled(spark, sf)
    return R.build_summary(res, ok, R.canonical_table(rec), review, R.provenance(rec, PARTS_PROFILE),
                           PARTS_PROFILE)


def phase1_gate(spark, sf):
    res = _resolved(spark, sf)
    ok, review = RS.split_review(res)
    rec = _reconciled(spark, sf)
    return G.phase1_gate(res, ok, R.canonical_table(rec), review, R.provenance(rec, PARTS_PROFILE))


def phase2_gate(spark, sf):
    return G.phase2_gate(R.canonical_table(_reconciled(spark, sf)))


def resolver_gate(spark, sf):
    part = table(spark, sf, "part")
    lab = (part.select(F.col("p_name").alias("input_name"), F.lit("lat").alias("input_lang"))
               .distinct()
               .withColumn("expected_bucket",
                           F.when(F.split_part("input_name", F.lit(" "), F.lit(1))
                                   .isin("cold", "large", "red"), "review").otherwise("resolve")))
    res = RS.resolve_names(lab.select("input_name", "input_lang"), part_match(spark, sf), PARTS_PROFILE)
    return G.resolver_gate(lab, res)


QUERIES = {
    "extract_pairs": extract_pairs,
    "extract_status_list": extract_status_list,
    "extract_record": extract_record,
    "clean_text": clean_text,
    "url_parts": url_parts,
    "stage_eav": stage_eav,
    "pivot_records": pivot_records,
    "crosswalk": crosswalk,
    "normalize_names": normalize_names,
    "strip_quotes": strip_quotes,
    "enum_map": enum_map,
    "split_map_list": split_map_list,
    "price_bands": price_bands,
    "resolve_ladder": resolve_ladder,
    "resolve_incremental": resolve_incremental,
    "resolve_fuzzy": resolve_fuzzy,
    "resolve_listed": resolve_listed,
    "resolve_crosswalk": resolve_crosswalk,
    "reconcile_rows": reconcile_rows,
    "provenance_rows": provenance_rows,
    "status_layer": status_layer,
    "checklist": checklist,
    "match_exact": match_exact,
    "match_containment": match_containment,
    "unmatched_offers": unmatched_offers,
    "offers_by_key": offers_by_key,
    "offer_values": offer_values,
    "offer_provenance": offer_provenance,
    "attach_layer": attach_layer_q,
    "offer_gate": offer_gate,
    "media_pick": media_pick,
    "media_coverage": media_coverage,
    "search_text": search_text,
    "filter_combo": filter_combo,
    "sorted_page": sorted_page,
    "surface_filters": surface_filters,
    "two_pages": two_pages,
    "facets": facets,
    "facets_ranked": facets_ranked,
    "facet_array": facet_array,
    "stats": stats,
    "lookup_one": lookup_one,
    "conflicts": conflicts,
    "conflict_values": conflict_values,
    "precedence": precedence,
    "gates": gates,
    "resolver_gate": resolver_gate,
    "phase1_gate": phase1_gate,
    "phase2_gate": phase2_gate,
}
