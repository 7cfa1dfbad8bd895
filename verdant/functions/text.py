"""String normalisation as Column builders (JVM-side except the two UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.functions.udf import html_unescape, nfkc

WS = r"(?U)\s+"
TAG = r"<[^>]+>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ustrip(c) -> Column:
    """Strip Unicode whitespace at both ends (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def collapse_ws(c) -> Column:
    """Runs of Unicode whitespace -> one space, then trim."""
    return F.trim(F.regexp_replace(_c(c), WS, " "))


def clean_text(c) -> Column:
    """EXT4: strip tags, then decode entities, collapse whitespace, trim."""
    return collapse_ws(html_unescape(F.regexp_replace(_c(c), TAG, "")))


def clean_credit(c, max_chars: int = L.ARTIST_MAX_CHARS) -> Column:
    """EXT12: decode entities, then strip tags, collapse, cut; '' -> null."""
    s = collapse_ws(F.regexp_replace(html_unescape(_c(c)), TAG, ""))
    return F.nullif(F.substring(s, 1, max_chars), F.lit(""))


def nfkc_text(c) -> Column:
    """NFKC; ASCII texts are their own normal form and stay out of Python."""
    return F.coalesce(nfkc(F.when(_c(c).rlike(r"[^\x00-\x7F]"), _c(c))), _c(c))


def normalize_name(c) -> Column:
    """NRM1: NFKC, strip, collapse whitespace; null -> ''."""
    return F.coalesce(collapse_ws(nfkc_text(c)), F.lit(""))


def is_latin(c) -> Column:
    """NRM2: has an ASCII letter and no character of the Hebrew block."""
    c = _c(c)
    return c.rlike("[A-Za-z]") & ~c.rlike("[֐-׿]")


def strip_cultivar(c) -> Column:
    """NRM3: remove quoted cultivar epithets and the blanks before them."""
    return F.regexp_replace(_c(c), L.CULTIVAR_PATTERN, "")


def tokens(c) -> Column:
    """Whitespace tokens, empty ones dropped (Python ``str.split()``)."""
    return F.filter(F.split(_c(c), WS), lambda x: x != "")


def bare_binomial(c) -> Column:
    """NRM4: first two tokens, lower-cased; null -> ''."""
    return F.array_join(F.slice(tokens(F.lower(F.coalesce(_c(c), F.lit("")))), 1, 2), " ")


def bare_name(c) -> Column:
    """NRM5: first two tokens with case kept; fewer than two -> unchanged."""
    c = F.coalesce(_c(c), F.lit(""))
    t = tokens(c)
    return F.when(F.size(t) >= 2, F.array_join(F.slice(t, 1, 2), " ")).otherwise(c)


def norm_local_name(c) -> Column:
    """NRM6: NFKC, drop marks, pot tokens and punctuation to blanks, collapse."""
    s = nfkc_text(c)
    s = F.regexp_replace(s, L.MARKS_PATTERN, "")
    s = F.regexp_replace(s, L.POT_TOKENS_PATTERN, " ")
    s = F.regexp_replace(s, L.PUNCT_PATTERN, " ")
    return F.coalesce(collapse_ws(s), F.lit(""))


def url_decode_literal_plus(c) -> Column:
    """Percent-decode but keep '+' (``url_decode`` would turn it into a space)."""
    return F.try_url_decode(F.replace(_c(c), F.lit("+"), F.lit("%2B")))


def https(c) -> Column:
    """EXT14."""
    return F.replace(_c(c), F.lit("http://"), F.lit("https://"))


def file_name(c) -> Column:
    """EXT13: decoded name after ``Special:FilePath/``; no match -> null."""
    m = F.regexp_extract(_c(c), r"Special:FilePath/(.+)$", 1)
    return F.when(m != "", url_decode_literal_plus(m))


def url_from_id(c, prefix: str) -> Column:
    """NRM12."""
    return F.concat(F.lit(prefix), _c(c))


def record_json(c) -> Column:
    """NRM13: the record's field map as JSON text (audit column)."""
    return F.to_json(_c(c))


def with_clean_list(df, src: str, out: str):
    """EXT4 over a list column, element-wise, order kept.

    Three projections (tag strip, Arrow UDF decode of the whole list, space
    collapse): Spark does not accept a Python UDF inside a higher-order
    function, so the UDF gets its own projection between the two lambdas.
    """
    from verdant.functions.udf import html_unescape_all
    tmp = f"__{out}_raw"
    df = df.withColumn(tmp, F.transform(F.col(src), lambda x: F.regexp_replace(x, TAG, "")))
    df = df.withColumn(tmp, html_unescape_all(F.col(tmp)))
    return df.withColumn(out, F.transform(F.col(tmp), lambda x: collapse_ws(x))).drop(tmp)
