"""Oracle SQL (DuckDB dialect) of the queries that keep state: what their
tables must hold at the end, computed from scratch."""

from __future__ import annotations

from verdant.plans.demo_sql import (CANON_OUT, CATALOG, LATIN, MATCH, MEDIA, NORM, OFFER_PROV, OFFERS, PART_REC, PROVENANCE,
                                    RECONCILE, RES_COLS, RESOLVE, TOKS)
from verdant.plans.store_inputs import ADJECTIVES, NOUNS, PAGE_IDS, TYPES


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def PART_LIKE(key: str, text: str, n: str, brand: str, first: int = 1) -> str:
    """Select list of part-like rows (store_inputs.part_like)."""
    n = f"coalesce({n}, 0)"
    w = f"lower(regexp_replace(split_part(coalesce({text}, ''), ' ', {first}), '[^A-Za-z]', '', 'g'))"
    return (f"{key} AS p_partkey, {_list(ADJECTIVES)}[{n} % 8 + 1] || ' ' || {_list(NOUNS)}[length({w}) % 8 + 1] || ' ' || {w} AS p_name, "
            f"'Brand#' || coalesce({brand}, '') AS p_brand, {_list(TYPES)}[{n} % 5 + 1] AS p_type, "
            f"{n} % 50 + 1 AS p_size, {n} AS p_retailprice")


def DOCS(first: int = 1, where: str = "true") -> str:
    return f"SELECT {PART_LIKE('doc_id', 'text', 'n_chars', 'lang', first)} FROM documents WHERE {where}"


H1 = "regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"
PAGES = f"SELECT {PART_LIKE(f'page_id + {PAGE_IDS}', H1, 'length(html)', repr('page'))} FROM pages"
THOSE = "doc_id IN (SELECT doc_id FROM labels WHERE {0})"
MOVED, TOXIC, BACK = (THOSE.format(c) for c in ("quality = 0", "toxic = 1", "toxic = 1 AND quality = 1"))

ORACLE_SQL: dict[str, str] = {}

ANSWERS = f"""part AS ({DOCS()}),
{MATCH},
asked AS (SELECT DISTINCT lower({NORM("substr(p_name, 1, 2) || substr(p_name, 4, 1000)")}) AS name_key,
                 bool_or(p_brand = 'Brand#en') OVER (PARTITION BY lower({NORM("substr(p_name, 1, 2) || substr(p_name, 4, 1000)")})) AS early
          FROM part),
keys AS (SELECT *, EXISTS (SELECT 1 FROM m WHERE m.name_key = a.name_key) AS known FROM asked a
         WHERE name_key <> '' AND {LATIN('name_key')})"""

ORACLE_SQL["kept_answers"] = f"""
WITH {ANSWERS},
b AS (SELECT p_name, min(p_partkey) AS key, lower(p_name) AS b FROM part GROUP BY p_name),
c AS (SELECT k.name_key, b.*, levenshtein(k.name_key, b.b) AS d FROM keys k, b
      WHERE NOT k.known AND abs(length(k.name_key) - length(b.b)) <= 2 AND levenshtein(k.name_key, b.b) <= 2),
best AS (SELECT name_key, first(p_name ORDER BY d, b, key) AS p_name, first(key ORDER BY d, b, key) AS key, min(d) AS d
         FROM c GROUP BY name_key),
g AS (SELECT DISTINCT {TOKS('b')}[1] AS g FROM b)
SELECT k.name_key, best.key AS usageKey,
       CASE WHEN best.d IS NOT NULL THEN best.p_name WHEN g.g IS NOT NULL THEN g.g END AS scientificName,
       CASE WHEN best.d = 0 THEN 'EXACT' WHEN best.d IS NOT NULL THEN 'FUZZY'
            WHEN g.g IS NOT NULL THEN 'HIGHERRANK' ELSE 'NONE' END AS matchType,
       CAST(CASE WHEN best.d = 0 THEN 99 WHEN best.d IS NOT NULL THEN 100 - 6 * best.d
            WHEN g.g IS NOT NULL THEN 90 ELSE 0 END AS INTEGER) AS confidence,
       CASE WHEN early THEN 'a' ELSE 'b' END AS batch
FROM keys k LEFT JOIN best USING (name_key) LEFT JOIN g ON g.g = {TOKS('k.name_key')}[1] WHERE NOT k.known"""

ORACLE_SQL["second_run"] = f"""
WITH {ANSWERS},
r AS (SELECT 1 AS run, count(*) AS keys, count(*) FILTER (WHERE known) AS hits FROM keys WHERE early
      UNION ALL SELECT 2, count(*), count(*) FILTER (WHERE known OR early) FROM keys
      UNION ALL SELECT 3, count(*), count(*) FROM keys)
SELECT run, keys, hits, keys - hits AS misses, keys = hits AS pass FROM r"""

# what is live after the last batch
LIVE = f"""known AS ({DOCS()} UNION ALL {DOCS(3)} UNION ALL {PAGES}),
part AS ({DOCS(1, f"(NOT {MOVED} AND NOT {TOXIC}) OR {BACK}")}
         UNION ALL {DOCS(3, f"{MOVED} AND NOT {TOXIC}")} UNION ALL {PAGES})"""
REBUILT = f"{LIVE},\n" + RECONCILE.replace("FROM part GROUP BY p_name", "FROM known GROUP BY p_name")

ORACLE_SQL["incremental_rebuild"] = f"WITH {REBUILT}\nSELECT {CANON_OUT} FROM canon"

ORACLE_SQL["incremental_review"] = f"""
WITH {REBUILT}
SELECT source_id, name_he, name_lat, reason, CAST(CASE WHEN _looked THEN coalesce(rr.confidence, 0) END AS INTEGER) AS confidence,
       CASE WHEN _looked THEN coalesce(rr.matchType, 'NONE') END AS matchType
FROM res WHERE reason IS NOT NULL"""

# the whole build: documents as records, media for the spine's names
BUILT = f"part AS ({DOCS()}),\n{CATALOG},\n" + MEDIA.replace(
    "SELECT p_name AS scientific_name, min(p_partkey) AS canonical_taxon_id FROM part GROUP BY p_name",
    "SELECT scientific_name, canonical_taxon_id FROM canon").replace(
    "pf AS (SELECT p_name AS n,",
    f"pf AS (SELECT CASE WHEN len({TOKS('p_name')}) >= 2 THEN array_to_string(list_slice({TOKS('p_name')}, 1, 2), ' ') ELSE p_name END AS n,") + """,
flag AS (SELECT doc_id, CASE WHEN bool_or(toxic = 1) THEN 'listed' ELSE 'potential' END AS st
         FROM labels WHERE toxic = 1 OR quality = 0 GROUP BY doc_id),
canon2 AS (SELECT canon.* REPLACE (coalesce(st, 'not_listed') AS invasive_status,
                  CASE st WHEN 'listed' THEN 'curated-il-invasive' WHEN 'potential' THEN 'griis-israel' ELSE 'default' END AS _status_source)
           FROM canon LEFT JOIN flag ON doc_id = canonical_taxon_id)"""

ORACLE_SQL["full_build"] = f"""
WITH {BUILT}
SELECT c.*, array_to_string(cby.sold_by, '|') AS sold_by, array_to_string(cby.pot_sizes, '|') AS pot_sizes, cby.price_ils,
       cby.price_band, cby.availability, array_to_string(cby.source_urls, '|') AS source_urls,
       media.thumb AS image_thumb, media.source AS image_source, media.license AS image_license,
       media.credit AS image_credit, media.page AS image_page
FROM (SELECT {CANON_OUT} FROM canon2) c LEFT JOIN cby USING (canonical_taxon_id) LEFT JOIN media USING (canonical_taxon_id)"""

ORACLE_SQL["full_build_provenance"] = f"""
WITH {BUILT}, {PROVENANCE.replace("FROM canon", "FROM canon2")}, {OFFER_PROV('cmatched', 'shop', 'op')}
SELECT * FROM prov UNION ALL SELECT * FROM op
UNION ALL SELECT canonical_taxon_id, 'image', thumb, source, 100 FROM media"""

ORACLE_SQL["full_build_review"] = f"""
WITH part AS ({DOCS()}), {RECONCILE}
SELECT source_id, name_he, name_lat, reason, CAST(CASE WHEN _looked THEN coalesce(rr.confidence, 0) END AS INTEGER) AS confidence,
       CASE WHEN _looked THEN coalesce(rr.matchType, 'NONE') END AS matchType
FROM res WHERE reason IS NOT NULL"""

ORACLE_SQL["full_build_gates"] = f"""
WITH {BUILT}, {PROVENANCE.replace("FROM canon", "FROM canon2")}, {OFFER_PROV('cmatched', 'shop', 'op')},
keys AS (SELECT _k1 AS k FROM res WHERE _k1 IS NOT NULL UNION SELECT _k2 FROM res WHERE _k2 IS NOT NULL),
c AS (SELECT 'GAT1' AS gate, 'staged' AS counter, count(*) AS value FROM part_rec
      UNION ALL SELECT 'GAT1', 'resolved', count(*) FROM res WHERE reason IS NULL
      UNION ALL SELECT 'GAT1', 'review', count(*) FROM res WHERE reason IS NOT NULL
      UNION ALL SELECT 'GAT1', 'canonical_rows', count(*) FROM canon
      UNION ALL SELECT 'GAT1', 'provenance_rows', count(*) FROM prov
      UNION ALL SELECT 'GAT1', 'keys_asked', count(*) FROM keys
      UNION ALL SELECT 'GAT1', 'cache_hits', count(*) FROM keys WHERE k IN (SELECT name_key FROM m)
      UNION ALL SELECT 'GAT1', 'cache_misses', count(*) FROM keys WHERE k NOT IN (SELECT name_key FROM m)
      UNION ALL SELECT 'GAT3', 'seller_products', count(*) FROM cmatched
      UNION ALL SELECT 'GAT3', 'matched', count(*) FROM cmatched WHERE canonical_taxon_id IS NOT NULL
      UNION ALL SELECT 'GAT3', 'unmatched', count(*) FROM cmatched WHERE canonical_taxon_id IS NULL
      UNION ALL SELECT 'GAT3', 'rows_before', count(*) FROM canon
      UNION ALL SELECT 'GAT3', 'rows_after', count(*) FROM catalog
      UNION ALL SELECT 'GAT3', 'taxa_with_seller', count(*) FROM cby
      UNION ALL SELECT 'GAT3', 'multi_listing_taxa', count(*) FROM cby WHERE conflict
      UNION ALL SELECT 'GAT3', 'provenance_rows_added', count(*) FROM op)
SELECT * FROM c"""

LAST = "canonical_taxon_id = (SELECT max(canonical_taxon_id) FROM canon)"
ORACLE_SQL["lookup_entity"] = f"WITH {BUILT}\nSELECT {CANON_OUT} FROM canon2 WHERE {LAST}"
ORACLE_SQL["lookup_provenance"] = f"SELECT * FROM ({ORACLE_SQL['full_build_provenance']}) WHERE canonical_taxon_id = " \
    f"(SELECT max(canonical_taxon_id) FROM ({ORACLE_SQL['full_build']}))"

ORACLE_SQL["snapshots_staged"] = f"""
WITH part AS ({DOCS()}), {PART_REC}
SELECT source_id, name_he AS raw_name_he, name_lat AS raw_name_lat, a.attribute,
       CASE a.attribute WHEN 'name' THEN p_name WHEN 'brand' THEN p_brand WHEN 'type' THEN p_type WHEN 'size' THEN CAST(p_size AS VARCHAR)
            WHEN 'price' THEN CAST(p_retailprice AS VARCHAR) ELSE regions_txt END AS value,
       CAST(CAST(DATE '2026-06-01' + CAST(p_partkey % 3 AS INTEGER) AS DATE) AS VARCHAR) AS scraped_at
FROM part_rec, (VALUES ('name'), ('brand'), ('type'), ('size'), ('price'), ('regions')) a(attribute)"""

ORACLE_SQL["seller_snapshots"] = f"""
WITH {OFFERS}
SELECT 'shop' AS source, source_id, url, name_he, price, array_to_string(pot_sizes, '|') AS pot_sizes, availability FROM offer_src"""

ORACLE_SQL["listed_names"] = f"""
WITH part AS ({DOCS()}), {MATCH},
nin AS (SELECT DISTINCT trim(p_name) AS name FROM part),
{RESOLVE('nin', 'name', "'lat'", 'res')},
r AS (SELECT name, {RES_COLS} FROM res)
SELECT canonical_taxon_id, min(scientific_name) AS name, NULL AS reason FROM r WHERE status = 'resolved' GROUP BY 1
UNION ALL SELECT NULL, name, reason FROM r WHERE status <> 'resolved'"""

ORACLE_SQL["labelled_gate"] = f"""
WITH part AS ({DOCS()}), {MATCH},
own AS ({DOCS(1, "doc_id IN (SELECT doc_id FROM labels)")}),
lab AS (SELECT DISTINCT p_name AS input_name, 'lat' AS input_lang, 'resolve' AS expected_bucket FROM own
        UNION SELECT DISTINCT substr(p_name, 1, 2) || substr(p_name, 4, 1000), 'lat', 'review' FROM own),
{RESOLVE('lab', 'input_name', 'input_lang', 'res')},
g AS (SELECT count(*) FILTER (WHERE expected_bucket = 'resolve') AS resolve_total,
             count(*) FILTER (WHERE expected_bucket = 'resolve' AND reason IS NULL) AS resolve_ok,
             count(*) FILTER (WHERE expected_bucket = 'review') AS review_total,
             count(*) FILTER (WHERE expected_bucket = 'review' AND reason IS NOT NULL) AS review_ok FROM res)
SELECT *, round(resolve_ok * 100.0 / resolve_total, 0) AS resolve_pct, round(review_ok * 100.0 / review_total, 0) AS review_pct,
       (resolve_ok * 100.0 >= 90.0 * resolve_total AND review_ok = review_total) AS pass FROM g"""

ORACLE_SQL["resolve_swapped"] = f"""
WITH part AS ({DOCS()}),
q AS (SELECT DISTINCT substr(p_name, 1, 1) || substr(p_name, 3, 1) || substr(p_name, 2, 1) || substr(p_name, 4, 1000) AS input_name FROM part),
qn AS (SELECT input_name, lower({NORM('input_name')}) AS q FROM q),
b AS (SELECT DISTINCT p_name AS name, lower(p_name) AS b FROM part),
p AS (SELECT input_name, name, damerau_levenshtein(q, b) AS d FROM qn, b
      WHERE abs(length(q) - length(b)) <= 1 AND damerau_levenshtein(q, b) <= 1),
l AS (SELECT input_name, min(d) AS d FROM p GROUP BY 1)
SELECT input_name, name, CAST(d AS INTEGER) AS distance FROM p JOIN l USING (input_name, d)"""

ORACLE_SQL["resolve_homonyms"] = f"""
WITH part AS ({DOCS()}),
r AS (SELECT p_name AS name, p_brand AS rf, p_type AS rk, min(p_partkey) AS key FROM part GROUP BY ALL),
a AS (SELECT DISTINCT p_name AS name, CASE WHEN p_size < 40 THEN p_type END AS kingdom, CASE WHEN p_size > 10 THEN p_brand END AS family FROM part),
j AS (SELECT *, CASE WHEN family IS NULL OR family = rf THEN 0 ELSE 2 END + CASE WHEN kingdom IS NULL OR kingdom = rk THEN 0 ELSE 1 END AS fit
      FROM a JOIN r USING (name)),
k AS (SELECT *, min(fit) OVER w AS least FROM j WINDOW w AS (PARTITION BY name, kingdom, family))
SELECT name AS input_name, name, kingdom, family, first(key ORDER BY key % 2, key) AS key,
       first(rk ORDER BY key % 2, key) AS row_kingdom, first(rf ORDER BY key % 2, key) AS row_family, count(*) AS n_best
FROM k WHERE fit = least GROUP BY name, kingdom, family"""

ORACLE_SQL["compacted_eav"] = f"SELECT * EXCLUDE (scraped_at) FROM ({ORACLE_SQL['snapshots_staged']})"
