"""Oracle SQL (DuckDB dialect) of ``surface_queries``: scans, windows and set
operations in place of the indexes."""

from __future__ import annotations

from verdant.plans.store_sql import DOCS, MOVED, TOXIC
from verdant.plans.surface_queries import AS_OF, FILTERS, PATTERNS

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["search_indexed"] = "\nUNION ALL ".join(
    f"SELECT '{p}' AS pattern, doc_id FROM documents WHERE text ILIKE '%{p}%' OR source ILIKE '%{p}%'" for p in PATTERNS)

FACET = {"status": "[o_orderstatus]", "priority": "[o_orderpriority]", "year": "[CAST(year(o_orderdate) AS VARCHAR)]",
         "months": "[strftime(o_orderdate, '%m'), CASE WHEN day(o_orderdate) > 28 THEN 'late' END]"}


def _under(active: dict) -> str:
    return " AND ".join(["true", *(f"list_has_any({FACET[f]}, {v})" for f, v in active.items())])


ORACLE_SQL["facet_counts"] = "\nUNION ALL ".join(
    f"SELECT '{f}' AS field, value, count(*) AS c, CAST({i} AS INTEGER) AS state FROM "
    f"(SELECT unnest(list_distinct({x})) AS value FROM orders WHERE {_under({g: v for g, v in a.items() if g != f})}) "
    f"WHERE value IS NOT NULL GROUP BY value" for i, a in enumerate(FILTERS) for f, x in FACET.items())

ORACLE_SQL["facet_keys"] = "\nUNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS state, o_orderkey FROM orders WHERE {_under(a)}" for i, a in enumerate(FILTERS) if a)

ORACLE_SQL["ranked_rows"] = """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rank FROM orders"""

ORACLE_SQL["ranked_facet"] = """
SELECT o_custkey, c, row_number() OVER (ORDER BY c DESC, o_custkey) AS rank
FROM (SELECT o_custkey, count(*) AS c FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)"""

ORACLE_SQL["page_three"] = """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 48 OFFSET 96"""

HISTORY = """e AS (SELECT CAST(user_id AS VARCHAR) AS source_id, CAST(ts AS DATE) AS day, event_type, json_extract_string(props, '$.k') AS k
           FROM events),
v AS (SELECT source_id, day, 'event' AS attribute, min(event_type) AS value FROM e GROUP BY ALL
      UNION ALL SELECT source_id, day, 'key', min(k) FROM e GROUP BY ALL),
f AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR value IS DISTINCT FROM lag(value) OVER w THEN 1 ELSE 0 END AS starts
      FROM v WINDOW w AS (PARTITION BY source_id, attribute ORDER BY day)),
g AS (SELECT *, sum(starts) OVER (PARTITION BY source_id, attribute ORDER BY day) AS island FROM f),
i AS (SELECT source_id, attribute, any_value(value) AS value, min(day) AS valid_from, CAST(count(*) AS INTEGER) AS snapshots
      FROM g GROUP BY source_id, attribute, island),
hist AS (SELECT source_id, attribute, value, valid_from,
                lead(valid_from) OVER (PARTITION BY source_id, attribute ORDER BY valid_from) AS valid_to, snapshots FROM i)"""

ORACLE_SQL["value_history"] = f"WITH {HISTORY}\nSELECT * FROM hist"

# the last snapshot of each value up to the day, without intervals
ORACLE_SQL["history_as_of"] = f"""
WITH {HISTORY},
b AS (SELECT * FROM g WHERE day <= DATE '{AS_OF}'),
l AS (SELECT source_id, attribute, arg_max(island, day) AS island FROM b GROUP BY source_id, attribute)
SELECT source_id, attribute, any_value(value) AS value, min(day) AS since
FROM b JOIN l USING (source_id, attribute, island) GROUP BY source_id, attribute"""

ORACLE_SQL["table_changes"] = f"""
WITH a AS ({DOCS()}),
b AS ({DOCS(1, f"NOT {MOVED} AND NOT {TOXIC}")} UNION ALL {DOCS(3, f"{MOVED} AND NOT {TOXIC}")} UNION ALL {DOCS(1, "lang = 'de'")}),
u AS (SELECT *, 1 AS l, 0 AS r FROM a UNION ALL SELECT *, 0, 1 FROM b)
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, sum(l)::BIGINT AS n_left, sum(r)::BIGINT AS n_right
FROM u GROUP BY ALL HAVING sum(l) <> sum(r)"""
