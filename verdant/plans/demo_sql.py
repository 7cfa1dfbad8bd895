"""Oracle SQL (DuckDB dialect) for the registered queries in ``demo_queries``.

Each statement restates the query's rules in plain SQL over the same
tables; brute-force forms (pairwise comparisons, correlated look-ups) are
fine here because the oracle runs on small scale factors only.  Patterns
stay ASCII where the two regex dialects differ (see SURVEY trap 17).
"""

from __future__ import annotations

from verdant.plans.demo_inputs import PARTS_LIFE_FORM_MAP, PARTS_REGION_ZONE, PARTS_STATUS_MAP

NAV_PAIR = r"""'(?s)<li><a href="/([^"]*)">(.*?)</a></li>'"""
NAV_HREF = r"""'(?s)<li><a href="/([^"]*)">'"""


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def UNESC(x):
    return (f"replace(replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), "
            f"'&middot;', '·'), '&amp;', '&')")


def COLLAPSE(x):
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def STRIP_TAGS(x):
    return f"regexp_replace({x}, '<[^>]+>', '', 'g')"


def CLEAN(x):
    return COLLAPSE(UNESC(STRIP_TAGS(x)))


def CREDIT(x):
    return f"nullif(substring({COLLAPSE(STRIP_TAGS(UNESC(x)))}, 1, 90), '')"


def NORM(x):
    return f"coalesce({COLLAPSE(f'nfc_normalize({x})')}, '')"


def LATIN(x):
    return f"(regexp_matches({x}, '[A-Za-z]') AND NOT regexp_matches({x}, '[֐-׿]'))"


def TOKS(x):
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')"


def BB(x):
    low = f"lower(coalesce({x}, ''))"
    return f"array_to_string(list_slice({TOKS(low)}, 1, 2), ' ')"


CULT = q("\\s*'[^']*'|\\s*\"[^\"]*\"")
MARKS = q("[֑-ׇ]")
POT_TOKENS = q('קוטר\\s*\\d+\\s*ס(?:"|״)?מ|\\d+\\s*ס(?:"|״)?מ|\\d+\\s*ליטר|עציץ\\s*\\d+')
PUNCT = q("""['"׳״\\-–,.()\\[\\]/]+""")


def NORM_LOCAL(x):
    s = f"regexp_replace(nfc_normalize({x}), {MARKS}, '', 'g')"
    s = f"regexp_replace({s}, {POT_TOKENS}, ' ', 'g')"
    s = f"regexp_replace({s}, {PUNCT}, ' ', 'g')"
    return f"coalesce({COLLAPSE(s)}, '')"


def LIFE(x):
    whens = " ".join(f"WHEN contains({x}, {q(t)}) THEN {q(v)}" for t, v in PARTS_LIFE_FORM_MAP)
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL {whens} END"


KNOWN = "[" + ", ".join(q(k) for k in PARTS_REGION_ZONE) + "]"


def REGIONS0(x):
    parts = f"string_split_regex(coalesce({x}, ''), '[,،]\\s*')"
    cleaned = f"list_transform({parts}, lambda r: trim(regexp_replace(r, '\\s*\\(.*?\\)\\s*', '', 'g')))"
    return f"list_filter({cleaned}, lambda r: r <> '' AND list_contains({KNOWN}, r))"


def DISTINCT_KEEP(x):
    return f"list_filter({x}, lambda e, i: list_position({x}, e) = i)"


def ZONE(x):
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in PARTS_REGION_ZONE.items())
    return f"CASE {x} {whens} END"


def ZONES(x):
    return f"list_sort(list_distinct(list_transform({x}, lambda r: {ZONE('r')})))"


def STATUSES(x):
    return f"list_filter(list_transform(string_split(coalesce({x}, ''), ';'), lambda s: trim(s)), lambda s: s <> '')"


FLAGS = ("protected", "red_list", "nectar", "edible", "medicinal", "poisonous", "allergenic")


def FLAG_COLS(x):
    out = []
    for f in FLAGS:
        labels = [k for k, v in PARTS_STATUS_MAP.items() if v == f]
        if labels:
            out.append(f"list_has_any({x}, [{', '.join(q(s) for s in labels)}]) AS {f}")
        else:
            out.append(f"false AS {f}")
    return ", ".join(out)


def BAND(x):
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 40 THEN 'budget' WHEN {x} < 100 THEN 'mid' "
            f"WHEN {x} < 200 THEN 'premium' ELSE 'luxury' END")


PART_REC = """part_rec AS (
  SELECT CAST(p_partkey AS VARCHAR) AS source_id, p_partkey, p_name, p_brand, p_type, p_size,
         p_retailprice, p_name AS name_he,
         p_name || CASE WHEN p_type = 'PROMO' THEN ' ''Select''' ELSE '' END AS name_lat,
         replace(p_name, ' ', ', ') || CASE WHEN p_size > 25 THEN ' (' || p_type || ')'
              ELSE ' (' || lower(p_brand) || ', ' || p_type || ')' END AS regions_txt
  FROM part)"""

MATCH = """mbase AS (SELECT p_name, min(p_partkey) AS usage_key, arg_min(p_type, p_partkey) AS fam,
                  count(*) AS n FROM part GROUP BY p_name),
m AS (SELECT lower(b.p_name) AS name_key, CAST(b.usage_key AS BIGINT) AS usageKey,
        CAST(a.usage_key AS BIGINT) AS acceptedUsageKey, b.p_name AS scientificName,
        CASE WHEN split_part(b.p_name, ' ', 1) = 'new' THEN 'old ' || split_part(b.p_name, ' ', 2) END AS accepted,
        CASE WHEN split_part(b.p_name, ' ', 1) = 'large' THEN 'GENUS'
             WHEN split_part(b.p_name, ' ', 2) = 'rod' THEN NULL ELSE 'SPECIES' END AS rank,
        CASE WHEN split_part(b.p_name, ' ', 1) = 'new' THEN 'SYNONYM' ELSE 'ACCEPTED' END AS status,
        CASE split_part(b.p_name, ' ', 1) WHEN 'cold' THEN 'NONE' WHEN 'large' THEN 'HIGHERRANK'
             WHEN 'hot' THEN 'FUZZY' ELSE 'EXACT' END AS matchType,
        CAST(CASE split_part(b.p_name, ' ', 1) WHEN 'red' THEN 85 WHEN 'blue' THEN 88
             ELSE 90 + b.n % 10 END AS INTEGER) AS confidence,
        CASE WHEN split_part(b.p_name, ' ', 2) = 'anvil' THEN 'Animalia'
             WHEN split_part(b.p_name, ' ', 2) = 'gizmo' THEN NULL ELSE 'Plantae' END AS kingdom,
        b.fam AS family, split_part(b.p_name, ' ', 2) AS genus
      FROM mbase b LEFT JOIN mbase a
        ON a.p_name = CASE WHEN split_part(b.p_name, ' ', 1) = 'new' THEN 'old ' || split_part(b.p_name, ' ', 2) END)"""


def RESOLVE(src: str, name: str, lang: str, out: str) -> str:
    """CTEs resolving ``name`` of ``src``; ``out`` has src columns + _looked, rr, reason."""
    return f"""{out}_k AS (SELECT *, {NORM(f'coalesce({name}, {q("")})')} AS _nm,
                   coalesce({lang}, 'lat') AS _lang FROM {src}),
{out}_k2 AS (SELECT *, {NORM(f"regexp_replace(_nm, {CULT}, '', 'g')")} AS _stripped,
                 (_nm <> '' AND _lang <> 'he' AND {LATIN('_nm')}) AS _looked FROM {out}_k),
{out}_k3 AS (SELECT *, CASE WHEN _looked THEN lower(_nm) END AS _k1,
                 CASE WHEN _looked AND _stripped <> '' AND _stripped <> _nm THEN lower(_stripped) END AS _k2
             FROM {out}_k2),
{out}_j AS (SELECT k.*, CASE WHEN k._k2 IS NOT NULL AND (coalesce(a.matchType, 'NONE') = 'NONE'
                                  OR coalesce(a.confidence, 0) < 88) THEN b ELSE a END AS rr
            FROM {out}_k3 k LEFT JOIN m a ON a.name_key = k._k1 LEFT JOIN m b ON b.name_key = k._k2),
{out} AS (SELECT *, CASE
     WHEN _nm = '' THEN 'empty'
     WHEN _lang = 'he' OR NOT {LATIN('_nm')} THEN 'hebrew_no_crosswalk'
     WHEN coalesce(rr.matchType, 'NONE') = 'NONE' THEN 'no_match'
     WHEN rr.kingdom IS NOT NULL AND rr.kingdom <> '' AND rr.kingdom <> 'Plantae' THEN 'non_plant:' || rr.kingdom
     WHEN coalesce(rr.matchType, 'NONE') = 'HIGHERRANK'
          OR NOT coalesce(rr.rank IN ('SPECIES', 'SUBSPECIES', 'VARIETY', 'FORM'), false)
          THEN 'higher_rank:' || coalesce(rr.rank, 'None')
     WHEN coalesce(rr.confidence, 0) < 88 THEN 'low_confidence:' || CAST(coalesce(rr.confidence, 0) AS VARCHAR)
     WHEN coalesce(nullif(rr.acceptedUsageKey, 0), nullif(rr.usageKey, 0)) IS NULL THEN 'missing_key'
   END AS reason FROM {out}_j)"""


RES_COLS = """CASE WHEN reason IS NULL THEN 'resolved' ELSE 'review' END AS status, reason,
  CASE WHEN reason IS NULL THEN CAST(coalesce(nullif(rr.acceptedUsageKey, 0), nullif(rr.usageKey, 0)) AS BIGINT) END
    AS canonical_taxon_id,
  CASE WHEN reason IS NULL THEN coalesce(nullif(rr.accepted, ''), rr.scientificName) END AS scientific_name,
  CASE WHEN _looked THEN rr.family END AS family, CASE WHEN _looked THEN rr.genus END AS genus,
  CAST(CASE WHEN _looked THEN coalesce(rr.confidence, 0) END AS INTEGER) AS confidence,
  CASE WHEN _looked THEN coalesce(rr.matchType, 'NONE') END AS matchType,
  CASE WHEN _looked THEN rr.status END AS gbif_status"""


def GAP(c, alias):
    return (f"coalesce(first({c} ORDER BY source_id) FILTER (WHERE {c} IS NOT NULL AND CAST({c} AS VARCHAR) <> ''), "
            f"first({c} ORDER BY source_id)) AS {alias}")


LIST_FIELDS = [("common", "common_names_en"), ("syns", "synonyms_latin"), ("sts", "statuses_he"),
               ("regs", "distribution_regions"), ("zns", "climate_zone")]

RECONCILE = PART_REC + ",\n" + MATCH + ",\n" + RESOLVE("part_rec", "name_lat", "'lat'", "res") + f""",
facts0 AS (
  SELECT {RES_COLS.replace('AS canonical_taxon_id', 'AS key')}, source_id, name_he, name_lat, p_name AS lf_raw,
         {LIFE('p_name')} AS life_form,
         CASE WHEN p_brand IS NOT NULL AND p_brand <> '' THEN [p_brand] ELSE [] END AS common,
         {STATUSES('p_type')} AS sts, {REGIONS0('regions_txt')} AS regs0,
         p_brand AS name_ar, CAST(p_size AS VARCHAR) AS bloom, p_type AS habitat, regions_txt AS distrib,
         CAST(p_retailprice AS VARCHAR) AS leaf, CAST(NULL AS VARCHAR) AS margin,
         CAST(NULL AS VARCHAR) AS stem, CAST(NULL AS VARCHAR) AS petals
  FROM res WHERE reason IS NULL),
facts1 AS (SELECT *, CASE WHEN name_lat IS NOT NULL AND name_lat <> '' AND {BB('name_lat')} <> {BB('scientific_name')}
                     THEN [name_lat] ELSE [] END AS syns,
                  {DISTINCT_KEEP('regs0')} AS regs FROM facts0),
facts AS (SELECT *, {ZONES('regs')} AS zns, {FLAG_COLS('sts')} FROM facts1),
sc AS (SELECT key,
   first(scientific_name ORDER BY source_id) AS scientific_name, first(family ORDER BY source_id) AS family,
   first(genus ORDER BY source_id) AS genus, first(confidence ORDER BY source_id) AS _conf,
   first(source_id ORDER BY source_id) AS source_id, first(lf_raw ORDER BY source_id) AS _lf_raw,
   first(life_form ORDER BY source_id) AS _lf_first, first(sts ORDER BY source_id) AS _sts_first,
   first(name_he ORDER BY source_id) AS _nh_first, first(distrib ORDER BY source_id) AS _dist_first,
   {GAP('life_form', 'life_form')}, {GAP('name_he', 'name_he')}, {GAP('name_ar', 'name_ar')},
   {GAP('bloom', 'bloom_months_he')}, {GAP('habitat', 'habitat_he')}, {GAP('distrib', 'distribution_il')},
   {GAP('leaf', 'leaf_shape')}, {GAP('margin', 'leaf_margin')}, {GAP('stem', 'stem_shape')},
   {GAP('petals', 'petals')},
   {", ".join(f"bool_or({f}) AS {f}" for f in FLAGS)}
  FROM facts GROUP BY key),
lx AS ({" UNION ALL ".join(f"SELECT key, source_id, '{f}' AS field, unnest({f}) AS item, generate_subscripts({f}, 1) AS pos FROM facts" for f, _ in LIST_FIELDS)}),
lf AS (SELECT key, field, item, min({{'s': source_id, 'p': pos}}) AS first_at FROM lx GROUP BY key, field, item),
ll AS (SELECT key, {", ".join(f"list(item ORDER BY first_at) FILTER (WHERE field = '{f}') AS {c}" for f, c in LIST_FIELDS)}
       FROM lf GROUP BY key),
canon AS (
  SELECT sc.key AS canonical_taxon_id, scientific_name, family, genus, name_he, name_ar,
         coalesce(common_names_en, []) AS common_names_en, coalesce(synonyms_latin, []) AS synonyms_latin,
         life_form, 'native' AS native_status, 'not_listed' AS invasive_status,
         {", ".join(FLAGS)},
         coalesce(statuses_he, []) AS statuses_he, bloom_months_he, habitat_he, distribution_il,
         coalesce(distribution_regions, []) AS distribution_regions, coalesce(climate_zone, []) AS climate_zone,
         leaf_shape, leaf_margin, stem_shape, petals, source_id,
         'https://parts.example/item/' || source_id AS source_url,
         _conf, _lf_raw, _lf_first, _sts_first, _nh_first, _dist_first, 'default' AS _status_source
  FROM sc LEFT JOIN ll ON ll.key = sc.key)"""

CANON_OUT = """canonical_taxon_id, scientific_name, family, genus, name_he, name_ar,
  array_to_string(common_names_en, '|') AS common_names_en, array_to_string(synonyms_latin, '|') AS synonyms_latin,
  life_form, native_status, invasive_status, protected, red_list, nectar, edible, medicinal, poisonous, allergenic,
  array_to_string(statuses_he, '|') AS statuses_he, bloom_months_he, habitat_he, distribution_il,
  array_to_string(distribution_regions, '|') AS distribution_regions,
  array_to_string(climate_zone, '|') AS climate_zone, leaf_shape, leaf_margin, stem_shape, petals,
  source_id, source_url"""

PROVENANCE = """prov AS (
  SELECT canonical_taxon_id, 'scientific_name' AS field, scientific_name AS value, 'match' AS source, _conf AS confidence FROM canon
  UNION ALL SELECT canonical_taxon_id, 'family', family, 'match', _conf FROM canon
  UNION ALL SELECT canonical_taxon_id, 'genus', genus, 'match', _conf FROM canon
  UNION ALL SELECT canonical_taxon_id, 'name_he', _nh_first, 'part', 100 FROM canon
  UNION ALL SELECT canonical_taxon_id, 'native_status', native_status, 'part', 100 FROM canon
  UNION ALL SELECT canonical_taxon_id, 'invasive_status', invasive_status, _status_source, 100 FROM canon
  UNION ALL SELECT canonical_taxon_id, 'life_form', _lf_raw, 'part', 100 FROM canon WHERE _lf_first IS NOT NULL
  UNION ALL SELECT canonical_taxon_id, 'status', unnest(_sts_first), 'part', 100 FROM canon
  UNION ALL SELECT canonical_taxon_id, 'distribution_il', _dist_first, 'part', 100 FROM canon
            WHERE _dist_first IS NOT NULL AND _dist_first <> '')"""

OFFERS = f"""offer_src AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS source_id,
         CASE WHEN l.l_returnflag = 'R' THEN p.p_name || ' ' || lower(p.p_brand)
              WHEN l.l_returnflag = 'A' THEN split_part(p.p_name, ' ', 1) || ' ' || lower(p.p_brand)
              ELSE split_part(p.p_name, ' ', 1) END AS name_he,
         p.p_name AS part_name, l.l_returnflag AS category,
         l.l_extendedprice / l.l_quantity AS price,
         [CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) || ' l'] AS pot_sizes,
         CASE WHEN l.l_linestatus = 'O' THEN 'in_stock' ELSE 'out_of_stock' END AS availability,
         'https://shop.example/p/' || CAST(l.l_partkey AS VARCHAR) || '/' || CAST(l.l_suppkey AS VARCHAR) AS url
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
offer_spine AS (SELECT p_name || ' ' || lower(p_brand) AS name_he, min(p_partkey) AS canonical_taxon_id
                FROM part GROUP BY 1)"""


def MATCHING(offers: str, spine: str, name: str, out: str) -> str:
    """CTEs: distinct offer names matched to the spine (exact, then unique containment)."""
    return f"""{out}_sp AS (SELECT canonical_taxon_id AS key, {NORM_LOCAL('name_he')} AS n FROM {spine}
                  WHERE name_he IS NOT NULL),
{out}_sp2 AS (SELECT key, n, list_distinct_keep AS toks FROM (
                  SELECT key, n, {DISTINCT_KEEP(TOKS('n'))} AS list_distinct_keep FROM {out}_sp WHERE n <> '')),
{out}_ex AS (SELECT n, min(key) AS ekey FROM {out}_sp2 GROUP BY n),
{out}_q AS (SELECT DISTINCT coalesce({name}, '') AS name FROM {offers}),
{out}_q2 AS (SELECT name, {NORM_LOCAL('name')} AS n FROM {out}_q),
{out}_q3 AS (SELECT name, n, {DISTINCT_KEEP(TOKS('n'))} AS toks FROM {out}_q2),
{out}_ct AS (SELECT q.name, min(s.key) AS cmin, max(s.key) AS cmax FROM {out}_q3 q JOIN {out}_sp2 s
               ON s.toks[1] = q.toks[1] AND list_has_all(s.toks, q.toks) WHERE q.n <> '' GROUP BY q.name),
{out} AS (SELECT q.name, q.n,
            CAST(CASE WHEN q.n = '' THEN NULL WHEN e.ekey IS NOT NULL THEN e.ekey
                      WHEN c.cmin = c.cmax THEN c.cmin END AS BIGINT) AS canonical_taxon_id,
            CASE WHEN q.n = '' THEN NULL WHEN e.ekey IS NOT NULL THEN 'exact'
                 WHEN c.cmin = c.cmax THEN 'genus_containment' END AS how
          FROM {out}_q3 q LEFT JOIN {out}_ex e ON e.n = q.n LEFT JOIN {out}_ct c ON c.name = q.name)"""


MATCHED = OFFERS + ",\n" + MATCHING("offer_src", "offer_spine", "name_he", "om") + """,
matched AS (SELECT o.*, om.canonical_taxon_id, om.how FROM offer_src o
            LEFT JOIN om ON om.name = coalesce(o.name_he, ''))"""


def BY_KEY(matched: str, out: str) -> str:
    return f"""{out}_sz AS (SELECT canonical_taxon_id, list_sort(list_distinct(flatten(list(pot_sizes)))) AS pot_sizes
                 FROM {matched} WHERE canonical_taxon_id IS NOT NULL GROUP BY 1),
{out} AS (SELECT a.canonical_taxon_id, ['shop'] AS sold_by, s.pot_sizes, a.price_ils,
             {BAND('a.price_ils')} AS price_band,
             CASE WHEN a.any_in THEN 'in_stock' ELSE 'out_of_stock' END AS availability,
             a.source_urls, a.listings, a.n_prices, (a.n_prices > 1 OR a.listings > 1) AS conflict
          FROM (SELECT canonical_taxon_id, min(price) AS price_ils,
                       coalesce(bool_or(availability = 'in_stock'), false) AS any_in,
                       list_sort(list_distinct(list(url))) AS source_urls, count(*) AS listings,
                       count(price) AS n_prices
                FROM {matched} WHERE canonical_taxon_id IS NOT NULL GROUP BY 1) a
          JOIN {out}_sz s ON s.canonical_taxon_id = a.canonical_taxon_id)"""


def OFFER_PROV(matched: str, seller: str, out: str) -> str:
    s = q(seller)
    return f"""{out} AS (
  SELECT canonical_taxon_id, 'sold_by' AS field, {s} AS value, {s} AS source, 100 AS confidence FROM {matched} WHERE canonical_taxon_id IS NOT NULL
  UNION ALL SELECT canonical_taxon_id, 'price_ils', CAST(price AS VARCHAR), {s}, 100 FROM {matched} WHERE canonical_taxon_id IS NOT NULL AND price IS NOT NULL
  UNION ALL SELECT canonical_taxon_id, 'pot_sizes', unnest(pot_sizes), {s}, 100 FROM {matched} WHERE canonical_taxon_id IS NOT NULL
  UNION ALL SELECT canonical_taxon_id, 'availability', availability, {s}, 100 FROM {matched} WHERE canonical_taxon_id IS NOT NULL
  UNION ALL SELECT canonical_taxon_id, 'match_method', how, {s}, 100 FROM {matched} WHERE canonical_taxon_id IS NOT NULL)"""


CATALOG = RECONCILE + ",\n" + OFFERS + ",\n" + MATCHING("offer_src", "canon", "part_name", "cm") + """,
cmatched AS (SELECT o.*, cm.canonical_taxon_id, cm.how FROM offer_src o LEFT JOIN cm ON cm.name = coalesce(o.part_name, ''))""" + ",\n" + BY_KEY("cmatched", "cby") + """,
catalog AS (SELECT canon.*, cby.sold_by, cby.pot_sizes, cby.price_ils, cby.price_band, cby.availability,
                   cby.source_urls
            FROM canon LEFT JOIN cby ON cby.canonical_taxon_id = canon.canonical_taxon_id)"""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["extract_pairs"] = f"""
WITH x AS (SELECT page_id, regexp_extract_all(html, {NAV_PAIR}, 1) AS k,
                  regexp_extract_all(html, {NAV_PAIR}, 2) AS v FROM pages),
u AS (SELECT page_id, unnest(k) AS k, unnest(v) AS v, generate_subscripts(k, 1) AS pos FROM x),
c AS (SELECT page_id, pos, trim(regexp_replace({CLEAN('k')}, ':+$', '')) AS label, {CLEAN('v')} AS value FROM u)
SELECT page_id, label, first(value ORDER BY pos) AS value FROM c WHERE label <> '' GROUP BY page_id, label"""

ORACLE_SQL["extract_status_list"] = f"""
SELECT page_id, CASE WHEN len(s) > 0 THEN array_to_string(s, '; ') END AS statuses,
       array_to_string(p, '|') AS pot_sizes
FROM (SELECT page_id,
        list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(html, {NAV_HREF}, 1),
                  lambda x: {CLEAN('x')}), lambda x: x <> ''))) AS s,
        list_sort(list_distinct(list_transform(regexp_extract_all(html, 'ad [0-9]+|track\\([0-9]+\\)', 0),
                  lambda x: {CLEAN('x')}))) AS p
      FROM pages)"""

ORACLE_SQL["extract_record"] = f"""
WITH x AS (SELECT page_id, regexp_extract_all(html, {NAV_PAIR}, 1) AS k,
                  regexp_extract_all(html, {NAV_PAIR}, 2) AS v FROM pages),
u AS (SELECT page_id, unnest(k) AS k, unnest(v) AS v, generate_subscripts(k, 1) AS pos FROM x),
c AS (SELECT page_id, pos, trim(regexp_replace({CLEAN('k')}, ':+$', '')) AS label, {CLEAN('v')} AS value FROM u),
f AS (SELECT page_id, label, first(value ORDER BY pos) AS value FROM c WHERE label <> '' GROUP BY page_id, label),
fl AS (SELECT page_id, max(value) FILTER (WHERE label = 'and') AS label_and,
              max(value) FILTER (WHERE label = 'the') AS label_the,
              bool_or(label IN ('and', 'the')) AS has_name FROM f GROUP BY page_id),
pr AS (SELECT page_id, url, html,
              nullif({CLEAN("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '') AS title,
              regexp_extract(url, '/[a-z][a-z]/([^/?#]*)', 1) AS block FROM pages)
SELECT CAST(pr.page_id AS VARCHAR) AS source_id,
       CASE WHEN contains(lower(pr.html), 'cheap-pills') THEN 'blocked'
            WHEN NOT coalesce(fl.has_name, false) THEN 'no_fields' ELSE 'ok' END AS outcome,
       fl.label_and, fl.label_the, pr.title,
       TRY_CAST(nullif(regexp_replace({CLEAN('block')}, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS price,
       CASE WHEN contains(pr.html, '&middot;') THEN 'out_of_stock' ELSE 'in_stock' END AS availability,
       CASE WHEN pr.title IS NULL THEN 'no_name' ELSE 'ok' END AS product_outcome
FROM pr LEFT JOIN fl ON fl.page_id = pr.page_id"""

ORACLE_SQL["clean_text"] = f"""
SELECT page_id, {CLEAN('raw')} AS title, {CREDIT('raw')} AS credit
FROM (SELECT page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS raw FROM pages)"""

ORACLE_SQL["url_parts"] = """
WITH u AS (SELECT page_id, replace(url, 'http://', 'https://') AS loc FROM pages),
p AS (SELECT page_id, loc, list_filter(string_split(url_decode(loc), '/'), lambda x: x <> '') AS parts FROM u),
i AS (SELECT *, list_position(parts, 'https:') AS i FROM p)
SELECT page_id, loc, parts[i + 1] AS host, parts[-1] AS slug,
       CASE WHEN regexp_extract(loc, 'Special:FilePath/(.+)$', 1) <> ''
            THEN url_decode(regexp_extract(loc, 'Special:FilePath/(.+)$', 1)) END AS file_name
FROM i WHERE i > 0 AND len(parts) >= i + 2"""

ORACLE_SQL["stage_eav"] = f"""
WITH {PART_REC},
pj AS (SELECT *, CAST(json_object('name', p_name, 'brand', p_brand, 'type', p_type, 'size', CAST(p_size AS VARCHAR),
                             'price', CAST(p_retailprice AS VARCHAR), 'regions', regions_txt) AS VARCHAR) AS raw_text
       FROM part_rec),
cj AS (SELECT *, CAST(json_object('name', c_name, 'nation', CAST(c_nationkey AS VARCHAR),
                             'balance', CAST(c_acctbal AS VARCHAR), 'segment', c_mktsegment) AS VARCHAR) AS raw_text
       FROM customer)
SELECT 'part' AS source, source_id, name_he AS raw_name_he, name_lat AS raw_name_lat, a.attribute, a.value, raw_text
FROM pj, (VALUES ('name'), ('brand'), ('type'), ('size'), ('price'), ('regions')) a0(attribute),
     LATERAL (SELECT a0.attribute, CASE a0.attribute WHEN 'name' THEN p_name WHEN 'brand' THEN p_brand
                WHEN 'type' THEN p_type WHEN 'size' THEN CAST(p_size AS VARCHAR)
                WHEN 'price' THEN CAST(p_retailprice AS VARCHAR) ELSE regions_txt END AS value) a
UNION ALL
SELECT 'customer', CAST(c_custkey AS VARCHAR), c_mktsegment, c_name, a.attribute, a.value, raw_text
FROM cj, (VALUES ('name'), ('nation'), ('balance'), ('segment')) a0(attribute),
     LATERAL (SELECT a0.attribute, CASE a0.attribute WHEN 'name' THEN c_name
                WHEN 'nation' THEN CAST(c_nationkey AS VARCHAR) WHEN 'balance' THEN CAST(c_acctbal AS VARCHAR)
                ELSE c_mktsegment END AS value) a"""

ORACLE_SQL["pivot_records"] = f"""
WITH {PART_REC}
SELECT source_id, name_he, name_lat, p_name AS name, p_brand AS brand, p_type AS type,
       CAST(p_size AS VARCHAR) AS size, CAST(p_retailprice AS VARCHAR) AS price, regions_txt AS regions
FROM part_rec"""

ORACLE_SQL["crosswalk"] = f"""
WITH {PART_REC}
SELECT DISTINCT name_he, name_lat, 'part' AS source, source_id FROM part_rec
WHERE name_he IS NOT NULL AND name_lat IS NOT NULL"""

ORACLE_SQL["normalize_names"] = f"""
SELECT doc_id, name, {LATIN('name')} AS latin FROM (SELECT doc_id, {NORM('text')} AS name FROM documents)"""

QUOTED = """quoted AS (SELECT p_partkey, p_name || CASE WHEN p_type = 'PROMO' THEN ' ''Gold'''
                     WHEN p_type = 'SMALL' THEN ' "Mini"' ELSE '' END AS raw FROM part)"""

ORACLE_SQL["strip_quotes"] = f"""
WITH {QUOTED}
SELECT p_partkey, regexp_replace(raw, {CULT}, '', 'g') AS stripped, {BB('upper(raw)')} AS binomial,
       CASE WHEN len({TOKS("coalesce(raw, '')")}) >= 2
            THEN array_to_string(list_slice({TOKS("coalesce(raw, '')")}, 1, 2), ' ') ELSE raw END AS bare,
       {NORM_LOCAL('raw')} AS norm
FROM quoted"""

ORACLE_SQL["enum_map"] = f"""
SELECT p_partkey, {LIFE('p_name')} AS life_form, {FLAG_COLS('st')}
FROM (SELECT p_partkey, p_name, {STATUSES("p_type || '; ; ' || upper(p_brand)")} AS st FROM part)"""

ORACLE_SQL["split_map_list"] = f"""
WITH {PART_REC},
r AS (SELECT source_id, regions_txt, {REGIONS0('regions_txt')} AS r0 FROM part_rec),
r2 AS (SELECT *, {DISTINCT_KEEP('r0')} AS regs FROM r)
SELECT source_id, array_to_string(regs, '|') AS regions, array_to_string({ZONES('regs')}, '|') AS zones,
       'https://parts.example/item/' || source_id AS url,
       array_to_string(list_filter(string_split_regex(coalesce(regions_txt, ''), '[,،]\\s*'), lambda x: x <> ''), '|')
         AS display
FROM r2"""

ORACLE_SQL["price_bands"] = f"""
SELECT l_orderkey, l_linenumber, l_extendedprice / 500.0 AS price, {BAND('l_extendedprice / 500.0')} AS band
FROM lineitem"""

RES_INPUT = """rin AS (SELECT *, CASE WHEN p_size = 1 THEN 'he' ELSE 'lat' END AS lang FROM part_rec)"""

ORACLE_SQL["resolve_ladder"] = f"""
WITH {PART_REC}, {MATCH}, {RES_INPUT}, {RESOLVE('rin', 'name_lat', 'lang', 'res')}
SELECT source_id, {RES_COLS} FROM res"""

ORACLE_SQL["resolve_incremental"] = f"""
WITH {PART_REC}, {MATCH}, {RES_INPUT}, {RESOLVE('rin', 'name_lat', 'lang', 'res')},
keys AS (SELECT _k1 AS name_key FROM res WHERE _k1 IS NOT NULL
         UNION SELECT _k2 FROM res WHERE _k2 IS NOT NULL),
hit AS (SELECT k.name_key, EXISTS (SELECT 1 FROM m WHERE m.name_key = k.name_key) AS h FROM keys k)
SELECT count(*) AS keys, count(*) FILTER (WHERE h) AS hits, count(*) FILTER (WHERE NOT h) AS misses, 1 AS run FROM hit
UNION ALL
SELECT count(*), count(*), 0, 2 FROM hit"""

ORACLE_SQL["resolve_fuzzy"] = f"""
WITH qn AS (SELECT input_name, lower({NORM('input_name')}) AS q
            FROM (SELECT DISTINCT substr(p_name, 1, 2) || substr(p_name, 4, 100) AS input_name FROM part)),
b AS (SELECT p_name AS matched_name, min(p_partkey) AS key, lower(p_name) AS b FROM part GROUP BY p_name),
c AS (SELECT qn.q, b.*, levenshtein(qn.q, b.b) AS d FROM qn, b WHERE levenshtein(qn.q, b.b) <= 2),
best AS (SELECT q, first(matched_name ORDER BY d, b, key) AS matched_name, first(key ORDER BY d, b, key) AS key,
                min(d) AS d FROM c GROUP BY q),
g AS (SELECT DISTINCT {TOKS('b')}[1] AS g FROM b)
SELECT qn.input_name,
       CASE WHEN best.d IS NOT NULL THEN best.matched_name WHEN g.g IS NOT NULL THEN g.g END AS matched_name,
       best.key AS key, CAST(best.d AS INTEGER) AS distance,
       CASE WHEN best.d = 0 THEN 'EXACT' WHEN best.d IS NOT NULL THEN 'FUZZY'
            WHEN g.g IS NOT NULL THEN 'HIGHERRANK' ELSE 'NONE' END AS matchType,
       CAST(CASE WHEN best.d = 0 THEN 99 WHEN best.d IS NOT NULL THEN 100 - 6 * best.d
            WHEN g.g IS NOT NULL THEN 90 ELSE 0 END AS INTEGER) AS confidence
FROM qn LEFT JOIN best ON best.q = qn.q LEFT JOIN g ON g.g = {TOKS('qn.q')}[1]"""

ORACLE_SQL["resolve_listed"] = f"""
WITH {MATCH},
names AS (SELECT DISTINCT trim(split_part(' ' || p_name || ' ,' || p_type || ',' || p_brand, ',', 1)) AS name
          FROM part),
nin AS (SELECT name FROM names),
{RESOLVE('nin', 'name', "'lat'", 'res')}
SELECT name, status, canonical_taxon_id, reason FROM (SELECT name, {RES_COLS} FROM res)"""

ORACLE_SQL["resolve_crosswalk"] = f"""
WITH {PART_REC}, {MATCH},
xw AS (SELECT name_he, first(name_lat ORDER BY source_id) AS xw_lat FROM
        (SELECT DISTINCT name_he, name_lat, source_id FROM part_rec WHERE name_he IS NOT NULL AND name_lat IS NOT NULL)
       GROUP BY name_he),
loc AS (SELECT r.source_id, r.name_he, CASE WHEN r.p_type <> 'SMALL' THEN r.name_lat END AS name_lat FROM part_rec r),
lin AS (SELECT loc.*, coalesce(nullif(loc.name_lat, ''), xw.xw_lat) AS lat_in FROM loc LEFT JOIN xw ON xw.name_he = loc.name_he),
{RESOLVE('lin', 'lat_in', "'lat'", 'res')}
SELECT source_id, status, canonical_taxon_id, reason FROM (SELECT source_id, {RES_COLS} FROM res)"""

ORACLE_SQL["reconcile_rows"] = f"WITH {RECONCILE}\nSELECT {CANON_OUT} FROM canon"

ORACLE_SQL["provenance_rows"] = f"WITH {RECONCILE}, {PROVENANCE}\nSELECT * FROM prov"

ORACLE_SQL["status_layer"] = """
WITH listed AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
pot AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0 AND doc_id NOT IN (SELECT doc_id FROM listed))
SELECT d.doc_id AS canonical_taxon_id,
       CASE WHEN l.doc_id IS NOT NULL THEN 'listed' WHEN p.doc_id IS NOT NULL THEN 'potential' ELSE 'not_listed' END
         AS invasive_status,
       CASE WHEN l.doc_id IS NOT NULL THEN 'curated-il-invasive' WHEN p.doc_id IS NOT NULL THEN 'griis-israel'
            ELSE 'default' END AS status_source
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN pot p ON p.doc_id = d.doc_id"""

ORACLE_SQL["checklist"] = """
WITH it AS (SELECT event_id,
                   CASE WHEN event_type <> 'error' THEN 'Plantae' ELSE 'Animalia' END AS kingdom,
                   CASE WHEN event_type <> 'signup' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS nubKey,
                   coalesce(nullif(CASE WHEN value < 50 THEN 'Taxon ' || CAST(event_id AS VARCHAR) END, ''),
                            'taxon-' || CAST(user_id AS VARCHAR)) AS name
            FROM events)
SELECT nubKey AS canonical_taxon_id, first(name ORDER BY event_id DESC) AS name
FROM it WHERE kingdom = 'Plantae' AND nubKey IS NOT NULL AND nubKey <> 0 GROUP BY nubKey"""

ORACLE_SQL["match_exact"] = f"""
WITH {MATCHED}
SELECT l_orderkey, l_linenumber, canonical_taxon_id FROM matched WHERE how = 'exact'"""

ORACLE_SQL["match_containment"] = f"""
WITH {OFFERS}, {MATCHING('offer_src', 'offer_spine', 'name_he', 'om')}
SELECT name, canonical_taxon_id, how FROM om"""

ORACLE_SQL["unmatched_offers"] = f"""
WITH {MATCHED}
SELECT source_id, name_he, category, price, url FROM matched WHERE canonical_taxon_id IS NULL"""

ORACLE_SQL["offers_by_key"] = f"""
WITH {MATCHED}, {BY_KEY('matched', 'bk')}
SELECT canonical_taxon_id, array_to_string(sold_by, '|') AS sold_by, array_to_string(pot_sizes, '|') AS pot_sizes,
       price_ils, price_band, availability, array_to_string(source_urls, '|') AS source_urls, listings,
       n_prices, conflict FROM bk"""

ORACLE_SQL["offer_values"] = f"""
WITH {MATCHED},
s AS (SELECT canonical_taxon_id, price, availability, unnest(list_distinct(pot_sizes)) AS value FROM matched),
v AS (SELECT canonical_taxon_id, 'url' AS kind, url AS value, price, availability FROM matched
      UNION ALL SELECT canonical_taxon_id, 'size', value, price, availability FROM s)
SELECT canonical_taxon_id, kind, value, count(*) AS listings, min(price) AS price_ils,
       coalesce(bool_or(availability = 'in_stock'), false) AS in_stock
FROM v WHERE canonical_taxon_id IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2, 3"""

ORACLE_SQL["offer_provenance"] = f"""
WITH {MATCHED}, {OFFER_PROV('matched', 'shop', 'op')}, {OFFER_PROV('matched', 'market', 'mp')}
SELECT * FROM op UNION ALL SELECT * FROM mp WHERE field = 'match_method'"""

ORACLE_SQL["attach_layer"] = f"""
WITH {MATCHED}, {BY_KEY('matched', 'bk')}
SELECT s.canonical_taxon_id, s.name_he, array_to_string(bk.sold_by, '|') AS sold_by,
       array_to_string(bk.pot_sizes, '|') AS pot_sizes, bk.price_ils, bk.price_band, bk.availability,
       array_to_string(bk.source_urls, '|') AS source_urls
FROM offer_spine s LEFT JOIN bk ON bk.canonical_taxon_id = s.canonical_taxon_id"""

ORACLE_SQL["offer_gate"] = f"""
WITH {MATCHED}, {BY_KEY('matched', 'bk')},
g AS (SELECT (SELECT count(*) FROM matched) AS seller_products,
             (SELECT count(*) FROM matched WHERE canonical_taxon_id IS NOT NULL) AS matched,
             (SELECT count(*) FROM offer_spine) AS rows_before,
             (SELECT count(*) FROM offer_spine s LEFT JOIN bk ON bk.canonical_taxon_id = s.canonical_taxon_id) AS rows_after,
             (SELECT count(*) FROM bk) AS taxa_with_seller,
             (SELECT count(*) FROM bk WHERE conflict) AS multi_listing_taxa)
SELECT *, seller_products - matched AS unmatched,
       round(matched * 100.0 / seller_products, 0) AS match_pct, rows_before = rows_after AS no_orphans FROM g"""

MEDIA = """spine AS (SELECT p_name AS scientific_name, min(p_partkey) AS canonical_taxon_id FROM part GROUP BY p_name),
pf AS (SELECT p_name AS n, replace(p_name, ' ', '_') || '_' || replace(p_brand, '#', '') ||
               CASE WHEN p_size > 40 THEN '_drawing' ELSE '' END || '.jpg' AS fn, p_type, p_brand FROM part),
pairs AS (SELECT n, min('http://commons.example/wiki/Special:FilePath/' || fn) AS img FROM pf GROUP BY n),
files AS (SELECT fn,
            replace(coalesce(CASE WHEN min(p_type) <> 'SMALL' THEN 'http://thumbs.example/' || fn END,
                             CASE WHEN min(p_type) <> 'MEDIUM' THEN 'http://img.example/' || fn END),
                    'http://', 'https://') AS thumb,
            min(p_brand) AS license, '<b>' || min(p_type) || '</b> &amp; co' AS artist,
            'https://commons.example/page/' || fn AS page
          FROM pf GROUP BY fn),
w AS (SELECT s.canonical_taxon_id, f.thumb, f.license, f.artist, f.page, f.fn,
             regexp_matches(f.fn, '""" + r"""illustration|drawing|sketch|lithograph|engraving|\bplate\b|\btaf\b|\bfig\.|\bpl\.|k[oö]hler|sturm|lindman|thom[eé]|masclef|\bflora\b.*\b(batava|von|der|de)\b|english botany|curtis|botanical magazine|nordens flora|deutschlands flora|atlas|planche|herbarium|herbier|specimen|\.svg$|kunstformen|1[678]\d\d|190\d""" + """', 'i') AS illu
      FROM spine s JOIN pairs p ON p.n = CASE WHEN len(""" + TOKS('s.scientific_name') + """) >= 2
                  THEN array_to_string(list_slice(""" + TOKS('s.scientific_name') + """, 1, 2), ' ') ELSE s.scientific_name END
      JOIN files f ON f.fn = url_decode(regexp_extract(p.img, 'Special:FilePath/(.+)$', 1))
      WHERE f.thumb IS NOT NULL AND f.thumb <> ''),
need AS (SELECT s.canonical_taxon_id FROM spine s LEFT JOIN w ON w.canonical_taxon_id = s.canonical_taxon_id
         WHERE w.canonical_taxon_id IS NULL OR w.illu),
ev AS (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS taxon_key, ts, event_id,
              CASE WHEN event_type IN ('view', 'click') THEN 'http://media.example/' || CAST(event_id AS VARCHAR) END AS identifier,
              event_type AS license,
              CASE WHEN value > 20 THEN 'user' || CAST(user_id AS VARCHAR) END AS rightsHolder,
              'creator' || CAST(user_id AS VARCHAR) AS creator,
              'https://occ.example/' || CAST(event_id AS VARCHAR) AS page
       FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) IN (SELECT canonical_taxon_id FROM need)),
fst AS (SELECT taxon_key, first(identifier ORDER BY ts, event_id) AS identifier,
               first(license ORDER BY ts, event_id) AS license,
               first(coalesce(nullif(rightsHolder, ''), creator) ORDER BY ts, event_id) AS credit,
               first(page ORDER BY ts, event_id) AS page, min({'ts': ts, 'id': event_id}) AS at
        FROM ev WHERE identifier IS NOT NULL AND identifier <> '' GROUP BY taxon_key),
g AS (SELECT f.taxon_key AS canonical_taxon_id, replace(f.identifier, 'http://', 'https://') AS thumb,
             f.license, f.credit, f.page
      FROM fst f WHERE (SELECT count(*) FROM ev e WHERE e.taxon_key = f.taxon_key
                        AND {'ts': e.ts, 'id': e.event_id} < f.at) < 5),
picked AS (
  SELECT s.canonical_taxon_id,
    CASE WHEN w.canonical_taxon_id IS NOT NULL AND NOT w.illu THEN 'w'
         WHEN g.canonical_taxon_id IS NOT NULL THEN 'g'
         WHEN w.canonical_taxon_id IS NOT NULL THEN 'w' END AS pick,
    w.thumb AS w_thumb, w.license AS w_license, """ + CREDIT('w.artist') + """ AS w_credit, w.page AS w_page,
    coalesce(w.illu, false) AS illu,
    g.thumb AS g_thumb, g.license AS g_license, g.credit AS g_credit, g.page AS g_page
  FROM spine s LEFT JOIN w ON w.canonical_taxon_id = s.canonical_taxon_id
               LEFT JOIN g ON g.canonical_taxon_id = s.canonical_taxon_id),
media AS (
  SELECT canonical_taxon_id,
    CASE pick WHEN 'w' THEN w_thumb ELSE g_thumb END AS thumb,
    CASE pick WHEN 'w' THEN 'wikimedia' ELSE 'gbif' END AS source,
    CASE pick WHEN 'w' THEN w_license ELSE g_license END AS license,
    CASE pick WHEN 'w' THEN w_credit ELSE g_credit END AS credit,
    CASE pick WHEN 'w' THEN w_page ELSE g_page END AS page,
    illu AND pick = 'w' AS illustration
  FROM picked WHERE pick IS NOT NULL)"""

ORACLE_SQL["media_pick"] = f"WITH {MEDIA}\nSELECT * FROM media"

ORACLE_SQL["media_coverage"] = f"""WITH {MEDIA}
SELECT count(*) AS total, count(m.source) AS have, count(*) FILTER (WHERE m.source = 'wikimedia') AS wikimedia,
       count(*) FILTER (WHERE m.source = 'gbif') AS gbif,
       count(*) FILTER (WHERE coalesce(m.illustration, false)) AS illustration_fallback
FROM spine s LEFT JOIN media m ON m.canonical_taxon_id = s.canonical_taxon_id"""

ORACLE_SQL["search_text"] = """
SELECT doc_id, lang FROM documents WHERE text ILIKE '%th_t %' OR source ILIKE '%th_t %'"""

ORACLE_SQL["filter_combo"] = f"""
WITH {CATALOG}
SELECT CAST(canonical_taxon_id AS VARCHAR) AS id, name_he, life_form, array_to_string(climate_zone, ', ') AS zones,
       bloom_months_he
FROM catalog
WHERE (name_he ILIKE '%e%' OR scientific_name ILIKE '%e%' OR name_ar ILIKE '%e%' OR family ILIKE '%e%'
       OR habitat_he ILIKE '%e%')
  AND bloom_months_he LIKE '%4%' AND list_contains(climate_zone, 'round') AND edible = true"""

ORACLE_SQL["sorted_page"] = f"""
WITH {CATALOG},
pg AS (SELECT CAST(canonical_taxon_id AS VARCHAR) AS id, name_he, price_ils, price_band,
              array_to_string(sold_by, ', ') AS sold_by, array_to_string(statuses_he, ' · ') AS statuses,
              array_to_string(distribution_regions, ', ') AS regions, red_list, invasive_status, protected
       FROM catalog ORDER BY price_ils DESC NULLS LAST, name_he ASC NULLS LAST, id ASC LIMIT 48)
SELECT id, name_he, price_ils, price_band, sold_by, statuses, regions,
  CASE WHEN regions IS NULL OR regions = '' THEN '—'
       WHEN len(list_filter(string_split_regex(regions, '[,\\s]+'), lambda x: x <> '')) > 3
         THEN list_filter(string_split_regex(regions, '[,\\s]+'), lambda x: x <> '')[1] || '–' ||
              list_filter(string_split_regex(regions, '[,\\s]+'), lambda x: x <> '')[-1]
       ELSE array_to_string(list_filter(string_split_regex(regions, '[,\\s]+'), lambda x: x <> ''), ', ') END
    AS bloom_short,
  CASE WHEN red_list THEN 'red' WHEN invasive_status IN ('listed', 'potential') THEN invasive_status
       WHEN protected THEN 'prot' END AS badge
FROM pg"""

ORACLE_SQL["surface_filters"] = f"""
WITH {CATALOG}
SELECT CAST(canonical_taxon_id AS VARCHAR) AS id, 'life_form' AS filter FROM catalog WHERE life_form = 'device'
UNION ALL SELECT CAST(canonical_taxon_id AS VARCHAR), 'invasive_status' FROM catalog WHERE invasive_status = 'not_listed'
UNION ALL SELECT CAST(canonical_taxon_id AS VARCHAR), 'habitat' FROM catalog WHERE habitat_he = 'PROMO'
UNION ALL SELECT CAST(canonical_taxon_id AS VARCHAR), 'region' FROM catalog WHERE list_contains(distribution_regions, 'ring')
UNION ALL SELECT CAST(canonical_taxon_id AS VARCHAR), 'month' FROM catalog WHERE bloom_months_he LIKE '%4%'
UNION ALL SELECT CAST(canonical_taxon_id AS VARCHAR), 'for_sale' FROM catalog WHERE sold_by IS NOT NULL
UNION ALL SELECT CAST(canonical_taxon_id AS VARCHAR), 'poisonous' FROM catalog WHERE poisonous = true"""

ORACLE_SQL["two_pages"] = f"""
WITH {CATALOG}
SELECT CAST(canonical_taxon_id AS VARCHAR) AS id, scientific_name, name_he, availability FROM catalog
ORDER BY scientific_name NULLS LAST, id LIMIT 10"""

ORACLE_SQL["facets_ranked"] = """
SELECT o_orderpriority, count(*) AS c, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS rank
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1"""

ORACLE_SQL["facets"] = """
SELECT o_orderpriority, count(*) AS c FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1"""

ORACLE_SQL["facet_array"] = f"""
WITH {RECONCILE}
SELECT region, count(*) AS c FROM (SELECT unnest(distribution_regions) AS region FROM canon) GROUP BY region"""

ORACLE_SQL["stats"] = f"""
WITH {CATALOG},
s AS (SELECT count(*) AS total, count(DISTINCT family) AS fams,
             count(*) FILTER (WHERE invasive_status <> 'not_listed') AS invas,
             count(*) FILTER (WHERE sold_by IS NOT NULL) AS sale,
             count(*) FILTER (WHERE life_form IS NOT NULL) AS lifed FROM catalog)
SELECT *, CAST(round(lifed * 100.0 / nullif(total, 0), 0) AS BIGINT) AS pct_classified FROM s"""

ORACLE_SQL["lookup_one"] = f"""
WITH {RECONCILE}, {PROVENANCE}
SELECT * FROM prov WHERE canonical_taxon_id = (SELECT min(canonical_taxon_id) FROM canon)"""

ORACLE_SQL["conflicts"] = f"""
WITH {MATCHED}, {OFFER_PROV('matched', 'shop', 'op')}
SELECT canonical_taxon_id, field, count(DISTINCT value) AS n_values,
       array_to_string(list_sort(list_distinct(list(value))), '|') AS "values"
FROM op WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT value) > 1"""

ORACLE_SQL["conflict_values"] = f"""
WITH {MATCHED}, {OFFER_PROV('matched', 'shop', 'op')},
c AS (SELECT canonical_taxon_id, field, value, count(*) AS n_rows, min(source) AS first_source,
             count(*) OVER (PARTITION BY canonical_taxon_id, field) AS n
      FROM op WHERE value IS NOT NULL GROUP BY 1, 2, 3)
SELECT canonical_taxon_id, field, value, n_rows, first_source FROM c WHERE n > 1"""

ORACLE_SQL["precedence"] = f"""
WITH {MATCHED},
m2 AS (SELECT * REPLACE ('in_stock' AS availability) FROM matched),
{OFFER_PROV('matched', 'shop', 'op1')}, {OFFER_PROV('m2', 'market', 'op2')},
allp AS (SELECT * FROM op1 UNION ALL SELECT * FROM op2),
r AS (SELECT *, CASE source WHEN 'market' THEN 0 WHEN 'shop' THEN 1 ELSE 2 END AS rk FROM allp)
SELECT canonical_taxon_id, field,
       first(value ORDER BY rk, -coalesce(confidence, 0), source, value) AS value,
       first(source ORDER BY rk, -coalesce(confidence, 0), source, value) AS source,
       first(confidence ORDER BY rk, -coalesce(confidence, 0), source, value) AS confidence
FROM r GROUP BY 1, 2"""

ORACLE_SQL["gates"] = f"""
WITH {RECONCILE}, {PROVENANCE}
SELECT 'taxa_in' AS metric, CAST(count(*) AS BIGINT) AS value FROM part_rec
UNION ALL SELECT 'resolved', count(*) FROM res WHERE reason IS NULL
UNION ALL SELECT 'canonical_rows', count(*) FROM canon
UNION ALL SELECT 'invasive_listed', count(*) FILTER (WHERE invasive_status = 'listed') FROM canon
UNION ALL SELECT 'invasive_potential', count(*) FILTER (WHERE invasive_status = 'potential') FROM canon
UNION ALL SELECT 'invasive_not_listed', count(*) FILTER (WHERE invasive_status = 'not_listed') FROM canon
""" + "".join(f"UNION ALL SELECT 'status_{f}', count(*) FILTER (WHERE {f}) FROM canon\n" for f in FLAGS) + """
UNION ALL SELECT 'with_region', count(*) FILTER (WHERE len(distribution_regions) > 0) FROM canon
UNION ALL SELECT 'review', count(*) FROM res WHERE reason IS NOT NULL
UNION ALL SELECT 'provenance_rows', count(*) FROM prov"""

ORACLE_SQL["resolver_gate"] = f"""
WITH {MATCH},
lab AS (SELECT DISTINCT p_name AS input_name, 'lat' AS input_lang,
          CASE WHEN split_part(p_name, ' ', 1) IN ('cold', 'large', 'red') THEN 'review' ELSE 'resolve' END
            AS expected_bucket FROM part),
{RESOLVE('lab', 'input_name', 'input_lang', 'res')},
g AS (SELECT count(*) FILTER (WHERE expected_bucket = 'resolve') AS resolve_total,
             count(*) FILTER (WHERE expected_bucket = 'resolve' AND reason IS NULL) AS resolve_ok,
             count(*) FILTER (WHERE expected_bucket = 'review') AS review_total,
             count(*) FILTER (WHERE expected_bucket = 'review' AND reason IS NOT NULL) AS review_ok FROM res)
SELECT *, round(resolve_ok * 100.0 / resolve_total, 0) AS resolve_pct,
       round(review_ok * 100.0 / review_total, 0) AS review_pct,
       (round(resolve_ok * 100.0 / resolve_total, 0) >= 90.0 AND review_ok = review_total) AS pass
FROM g"""

ORACLE_SQL["phase1_gate"] = f"""
WITH {RECONCILE}, {PROVENANCE},
g AS (SELECT (SELECT count(*) FROM part_rec) AS staged, (SELECT count(*) FROM res WHERE reason IS NULL) AS resolved,
             (SELECT count(*) FROM canon) AS canonical_rows, (SELECT count(*) FROM res WHERE reason IS NOT NULL) AS review,
             (SELECT count(*) FROM prov) AS provenance_rows)
SELECT *, round(resolved * 100.0 / staged, 0) AS resolved_pct, round(review * 100.0 / staged, 0) AS review_pct FROM g"""

ORACLE_SQL["phase2_gate"] = f"""
WITH {RECONCILE}
SELECT count(*) AS canonical,
       count(*) FILTER (WHERE invasive_status IN ('listed', 'potential', 'not_listed')) AS covered,
       count(*) FILTER (WHERE invasive_status = 'listed') AS listed,
       count(*) FILTER (WHERE invasive_status = 'potential') AS potential,
       count(*) FILTER (WHERE invasive_status = 'not_listed') AS not_listed,
       """ + ", ".join(f"count(*) FILTER (WHERE {f}) AS {f}" for f in FLAGS) + """,
       count(*) FILTER (WHERE len(distribution_regions) > 0) AS with_region,
       count(*) FILTER (WHERE invasive_status IN ('listed', 'potential', 'not_listed')) = count(*) AS coverage_ok
FROM canon"""
