"""Sitemap product list (SRC9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.functions.text import url_decode_literal_plus


def url_segments(url: Column) -> Column:
    """Decoded URL split on '/', empty segments dropped."""
    return F.filter(F.split(url_decode_literal_plus(url), "/"), lambda x: x != "")


def products_from_urls(df: DataFrame, url_col: str = "loc", anchor: str = L.SHOP_SEGMENT,
                       categories=L.PLANT_CATEGORIES) -> DataFrame:
    """(url, category, slug) for URLs with ``anchor`` followed by a category and
    a slug; ``categories=None`` keeps every category."""
    parts = url_segments(F.col(url_col))
    i = F.array_position(parts, anchor)
    out = df.select("*", parts.alias("_parts"), i.alias("_i"))
    out = out.where((F.col("_i") > 0) & (F.size("_parts") >= F.col("_i") + 2))
    out = out.select("*", F.element_at("_parts", (F.col("_i") + 1).cast("int")).alias("category"),
                     F.element_at("_parts", -1).alias("slug"))
    if categories is not None:
        out = out.where(F.col("category").isin(*categories))
    return out.drop("_parts", "_i")


def sitemap_urls(xml: DataFrame, text_col: str = "value") -> DataFrame:
    """Every ``<loc>`` of sitemap documents, one row each."""
    return xml.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit("(?s)<loc>(.*?)</loc>"), 1))
                      .alias("loc"))
