"""Field extraction from raw pages (EXT1-EXT11).

A page is one row; every extraction is a row-local expression over its HTML
(``regexp_extract_all`` + higher-order functions), so extraction is a pure
map stage: no shuffle, no regrouping of a page's fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.functions.text import clean_text, url_decode_literal_plus, with_clean_list


def _first_per_label(labels: Column, values: Column) -> Column:
    """Entries (k, v) with non-empty k, first occurrence of each k kept."""
    z = F.arrays_zip(labels.alias("k"), values.alias("v"))
    return F.filter(z, lambda e, i: (e["k"] != "") &
                    (F.array_position(labels, e["k"]) == i + 1))


def with_page_fields(df: DataFrame, html_col: str = "html", pattern: str = L.PAIR_PATTERN,
                     out: str = "_entries") -> DataFrame:
    """EXT1+EXT2: ordered (k, v) entries of label/value pairs, first value wins.

    Labels are cleaned and lose a trailing ':'; empty labels are dropped.
    Row-local: a page's pairs never leave its row.
    """
    # one regex pass over the page for whole pair matches; both groups are
    # then taken from the short match strings, not from the page again
    df = df.withColumn("__m", F.regexp_extract_all(F.col(html_col), F.lit(pattern), 0))
    df = df.withColumn("__k", F.transform("__m", lambda m: F.regexp_extract(m, pattern, 1)))
    df = df.withColumn("__v", F.transform("__m", lambda m: F.regexp_extract(m, pattern, 2))).drop("__m")
    df = with_clean_list(with_clean_list(df, "__k", "__k"), "__v", "__v")
    k = F.transform(F.col("__k"), lambda x: F.trim(F.regexp_replace(x, ":+$", "")))
    return df.withColumn(out, _first_per_label(k, F.col("__v"))).drop("__k", "__v")


def page_pairs(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               pattern: str = L.PAIR_PATTERN) -> DataFrame:
    """Long form of ``with_page_fields``: (id, pos, label, value)."""
    df = with_page_fields(pages.select(id_col, html_col), html_col, pattern)
    return (df.select(id_col, F.posexplode("_entries").alias("pos", "kv"))
              .select(id_col, "pos", F.col("kv.k").alias("label"), F.col("kv.v").alias("value")))


def with_status_text(df: DataFrame, html_col: str = "html", pattern: str = L.STATUS_ALT_PATTERN,
                     out: str = "_statuses") -> DataFrame:
    """EXT3: cleaned non-empty labels, distinct, sorted, joined by '; '
    (null when there are none)."""
    df = df.withColumn("__s", F.regexp_extract_all(F.col(html_col), F.lit(pattern), 1))
    df = with_clean_list(df, "__s", "__s")
    s = F.array_sort(F.array_distinct(F.filter(F.col("__s"), lambda x: x != "")))
    return df.withColumn(out, F.when(F.size(s) > 0, F.array_join(s, "; "))).drop("__s")


def page_outcome(html: Column, fields: Column, name_labels,
                 block_marker: str = L.BLOCK_MARKER) -> Column:
    """EXT5: 'blocked' | 'no_fields' | 'ok'."""
    labels = F.array(*[F.lit(x) for x in name_labels])
    has_name = F.exists(fields, lambda e: F.array_contains(labels, e["k"]))
    return (F.when(F.lower(html).contains(block_marker.lower()), "blocked")
             .when(~has_name, "no_fields").otherwise("ok"))


def extract_records(pages: DataFrame, source: str, scraped_at: str,
                    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                    profile: L.Profile = L.REFERENCE_PROFILE,
                    pair_pattern: str = L.PAIR_PATTERN,
                    status_pattern: str = L.STATUS_ALT_PATTERN,
                    block_marker: str = L.BLOCK_MARKER, keep=()) -> DataFrame:
    """EXT1-EXT6: pages -> snapshot records plus an ``outcome`` column.

    Rows with outcome 'ok' are records; the others are the rejects table.
    ``fields`` is a map in page order with the synthetic statuses entry last.
    ``keep`` names input columns passed through (e.g. the HTML for a second
    extraction in the same pass).
    """
    df = pages.select(F.col(id_col).cast("string").alias("source_id"), F.col(url_col).alias("url"),
                      F.col(html_col).alias("html"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    df = with_status_text(with_page_fields(df, "html", pair_pattern), "html", status_pattern, "_st")
    st = F.col("_st")
    extra = F.when(st.isNotNull(), F.array(F.struct(F.lit(profile.label_statuses).alias("k"),
                                                    st.alias("v")))) \
             .otherwise(F.array().cast("array<struct<k:string,v:string>>"))
    # the synthetic entry replaces a page's own label of that name
    own = F.when(st.isNotNull(), F.filter("_entries", lambda e: e["k"] != profile.label_statuses)).otherwise(F.col("_entries"))
    df = df.withColumn("_entries", F.concat(own, extra))
    df = df.withColumn("outcome", page_outcome(
        F.col("html"), F.col("_entries"), [profile.label_name_he, profile.label_name_lat], block_marker))
    m = F.map_from_entries("_entries")
    return df.select(
        F.lit(source).alias("source"), "source_id", "url",
        F.lit(scraped_at).cast("date").alias("scraped_at"),
        F.try_element_at(m, F.lit(profile.label_name_he)).alias("name_he"),
        F.try_element_at(m, F.lit(profile.label_name_lat)).alias("name_lat"),
        m.alias("fields"), "outcome", *[F.col(f"_keep_{c}").alias(c) for c in keep])


def outcome_counts(records: DataFrame) -> DataFrame:
    """EXT5 statistics: rows per outcome."""
    return records.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def extract_price(text: Column, block_pattern: str = L.PRICE_BLOCK_PATTERN,
                  amount_pattern: str = L.AMOUNT_PATTERN) -> Column:
    """EXT8: first price block -> first amount -> digits and dots -> double."""
    block = F.regexp_extract(text, block_pattern, 1)
    amount = F.regexp_extract(block, amount_pattern, 1)
    digits = F.regexp_replace(clean_text(amount), r"(?U)[^\d.]", "")
    return F.nullif(digits, F.lit("")).try_cast("double")


def with_pot_sizes(df: DataFrame, html_col: str = "html", pattern: str = L.POT_PATTERN,
                   out: str = "pot_sizes") -> DataFrame:
    """EXT9: distinct sorted (cleaned) matches anywhere in the page."""
    df = df.withColumn("__p", F.regexp_extract_all(F.col(html_col), F.lit(pattern), 0))
    df = with_clean_list(df, "__p", "__p")
    return df.withColumn(out, F.array_sort(F.array_distinct(F.col("__p")))).drop("__p")


def extract_products(pages: DataFrame, source: str, scraped_at: str,
                     id_col: str = "source_id", url_col: str = "url", html_col: str = "html",
                     category_col: str | None = "category",
                     title_pattern: str = L.TITLE_PATTERN,
                     price_text: Column | None = None,
                     block_pattern: str = L.PRICE_BLOCK_PATTERN,
                     amount_pattern: str = L.AMOUNT_PATTERN,
                     pot_pattern: str = L.POT_PATTERN,
                     out_marker: str = L.OUT_OF_STOCK_MARKER, keep=()) -> DataFrame:
    """EXT7-EXT11: product pages -> seller records; no title -> outcome 'no_name'.

    ``keep`` names input columns passed through unchanged.
    """
    html = F.col(html_col)
    title = F.nullif(clean_text(F.regexp_extract(html, title_pattern, 1)), F.lit(""))
    cat = F.col(category_col) if category_col else F.lit(None).cast("string")
    pages = with_pot_sizes(pages, html_col, pot_pattern, "__pots")
    out = pages.select(
        F.lit(source).alias("source"), F.col(id_col).cast("string").alias("source_id"),
        url_decode_literal_plus(F.col(url_col)).alias("url"), cat.alias("category"),
        F.lit(scraped_at).cast("date").alias("scraped_at"),
        title.alias("name_he"),
        extract_price(price_text if price_text is not None else html,
                      block_pattern, amount_pattern).alias("price"),
        F.lit("ILS").alias("currency"),
        F.col("__pots").alias("pot_sizes"),
        F.when(html.contains(out_marker), "out_of_stock").otherwise("in_stock").alias("availability"),
        *[F.col(c) for c in keep])
    return out.withColumn("outcome", F.when(F.col("name_he").isNull(), "no_name").otherwise("ok"))
