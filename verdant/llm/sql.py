"""DuckDB oracles of the operators that SQL can express."""

from __future__ import annotations

from verdant.llm import lexical_search as X, ngram_jaccard as J, quality_rules as Q, vector_search as V

_WS = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_WS}'), lambda x: x <> '')"


def _lists() -> str:
    cases = " ".join(f"WHEN lang = '{g}' THEN [{', '.join(repr(x) for x in w)}]" for g, w in Q.WORDS.items())
    return f"CASE {cases} ELSE [{', '.join(repr(x) for x in Q.ALL_WORDS)}] END"


def _term(a: str, b: str) -> str:
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
    return f"({part.format(a, b)} + {part.format(b, a)})"


def _classes() -> str:
    """Chained removals of the character classes; what is left are symbols."""
    out, before = [], "chars"
    for k, (_, pattern) in enumerate(Q.CLASSES):
        pattern = pattern.replace("'", "''").replace(r"\x00", r"\x{0}").replace(r"\x7F", r"\x{7F}")
        out.append(f"r{k} AS (SELECT *, regexp_replace(t{k}, '{pattern}', '', 'g') AS t{k + 1} FROM "
                   + ("(SELECT *, chars AS t0 FROM w)" if k == 0 else f"r{k - 1}") + ")")
    return ",\n".join(out)


def quality_rules() -> str:
    n = len(Q.CLASSES)
    plain = n - 1
    classes = ", ".join([f"length(t{k}) - length(t{k + 1})" for k in range(n)] + [f"length(t{n})"])
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_words('t')} AS w, array_to_string({_words('t')}, '') AS chars,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
{_classes()},
tri AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
f AS (SELECT rid, doc_id, lang, len(w)::BIGINT AS n_words, length(chars)::BIGINT AS word_chars,
             (length(t{plain}) - length(regexp_replace(t{plain}, '{Q.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, [{classes}] AS classes,
             list_transform({_lists()}, lambda x: len(list_filter(w, lambda y: y = x))) AS common
      FROM r{n - 1} LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT} * n_words AS base_failed,
             n_words - coalesce(list_sum(common), 0) AS other FROM f),
ok AS (SELECT * FROM b WHERE NOT base_failed),
tot AS (SELECT lang, sum(n_words) AS n, sum(word_chars) AS c, sum(other) AS o FROM ok GROUP BY lang HAVING sum(n_words) >= {Q.REF_GUARD}),
rc AS (SELECT lang, i, sum(classes[i]) AS s FROM ok, (SELECT unnest(range(1, {n + 2})) AS i) GROUP BY ALL),
rw AS (SELECT lang, i, sum(common[i]) AS s FROM ok, (SELECT unnest(range(1, {len(Q.ALL_WORDS) + 1})) AS i) GROUP BY ALL),
dc AS (SELECT b.rid, sqrt(greatest(0, sum({_term('(classes[rc.i] / b.word_chars)', '(rc.s / tot.c)')}) / 2)) AS d
       FROM b JOIN tot ON b.lang IS NOT DISTINCT FROM tot.lang JOIN rc ON rc.lang IS NOT DISTINCT FROM b.lang
       WHERE b.word_chars >= {Q.CLASS_GUARD} GROUP BY b.rid),
dw AS (SELECT b.rid, sqrt(greatest(0, (sum({_term('(common[rw.i] / b.n_words)', '(rw.s / tot.n)')})
              + any_value({_term('(b.other / b.n_words)', '(tot.o / tot.n)')})) / 2)) AS d
       FROM b JOIN tot ON b.lang IS NOT DISTINCT FROM tot.lang
              JOIN rw ON rw.lang IS NOT DISTINCT FROM b.lang AND rw.i <= len(b.common)
       WHERE b.n_words >= {Q.WORD_GUARD} GROUP BY b.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(dc.d, 0) <= {Q.CLASS_LIMIT} AND coalesce(dw.d, 0) <= {Q.WORD_LIMIT} AS kept
FROM b LEFT JOIN dc USING (rid) LEFT JOIN dw USING (rid)"""


def ngram_jaccard() -> str:
    k = J.WORDS
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
             ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' ')))) END AS s
      FROM w),
n AS (SELECT doc_id, s, len(s)::BIGINT AS n, min(doc_id) OVER (PARTITION BY s) AS rep FROM s),
u AS (SELECT doc_id, n, unnest(s) AS x FROM n WHERE doc_id = rep AND n > 0),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
          FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id AND {J.DEN} * least(a.n, b.n) >= {J.NUM} * greatest(a.n, b.n)
          GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE {J.DEN} * c >= {J.NUM} * (na + nb - c)),
reach(id, r) AS (SELECT doc_id, doc_id FROM n WHERE doc_id = rep AND n > 0
                 UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.id),
comp AS (SELECT id, min(r) AS c FROM reach GROUP BY id)
SELECT n.doc_id, n.n AS n_shingles, CASE WHEN n.n = 0 THEN n.doc_id ELSE comp.c END AS component_id,
       CASE WHEN n.n = 0 THEN n.doc_id ELSE n.rep END AS set_id
FROM n LEFT JOIN comp ON comp.id = n.rep"""


def vector_search() -> str:
    """The exact neighbours: what the search finds where its sample holds the whole table."""
    return f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: isfinite(e))) = len(embedding)
             AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
q AS (SELECT vec_id AS query_id, min(x) AS y FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
d AS (SELECT query_id, vec_id, min(sqrt(list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))) AS score
      FROM q JOIN v ON vec_id <> query_id GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {V.TOP}"""


def lexical_search() -> str:
    def terms(text: str) -> str:
        lower = f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"
        return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {terms('text')} AS t FROM documents WHERE text IS NOT NULL),
n AS (SELECT rid, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
f AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, g GROUP BY term),
i AS (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL GROUP BY item_id),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({terms('text')}) AS term FROM i) GROUP BY ALL),
s AS (SELECT item_id, rid, doc_id,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // terms)))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN n USING (rid), g WHERE doc_id IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {X.TOP}"""


ORACLE_SQL = {"op2_ngram_jaccard": ngram_jaccard(), "op4_quality_rules": quality_rules(),
              "op11_vector_search": vector_search(), "op13_lexical_search": lexical_search()}
