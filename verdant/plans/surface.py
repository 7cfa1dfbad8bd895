"""Query surface over the published catalogue (QRY1-QRY18).

``CatalogQuery`` turns a filter state into Column predicates with bound
literals (no SQL text is built), so Catalyst sees plain filters: equality on
scalar columns reaches the Parquet scan as pushed filters, and ``limit`` after
``orderBy`` plans as ``TakeOrderedAndProject`` (a per-partition top-k, no
global sort).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.functions.display import key_text, list_text
from verdant.operators.layers import MEDIA_COLUMNS, OFFER_COLUMNS, with_layer_columns

KEY = "canonical_taxon_id"
SPECIAL_COLUMNS = ("protected", "red_list", "nectar", "edible", "medicinal", "poisonous",
                   "allergenic")
SORTS = ("name_he", "scientific_name", "family", "price")


def like_literal(text: str) -> str:
    """Make user text safe for Spark LIKE: ``%``/``_`` stay wildcards (as in
    the original surface), a backslash stays a literal backslash."""
    return text.replace("\\", "\\\\")


@dataclass(frozen=True)
class CatalogQuery:
    """Filter state of the catalogue surface (QRY1-QRY7, QRY9-QRY11)."""

    search: str = ""
    life_form: str = ""
    invasive_status: str = ""
    family: str = ""
    month: str = ""
    habitat: str = ""
    zone: str = ""
    region: str = ""
    special: str = ""
    for_sale: bool = False
    sort: str = "name_he"
    limit: int = L.PAGE_SIZE
    search_columns: tuple = L.SEARCH_COLUMNS

    def predicates(self) -> list[Column]:
        """Active predicates only; an inactive filter adds nothing (QRY7)."""
        p: list[Column] = []
        if self.search:
            pat = f"%{like_literal(self.search)}%"
            p.append(reduce(lambda a, b: a | b,
                            [F.col(c).ilike(pat) for c in self.search_columns]))
        for col, val in (("life_form", self.life_form), ("invasive_status", self.invasive_status),
                         ("family", self.family)):
            if val:
                p.append(F.col(col) == F.lit(val))
        if self.month:
            p.append(F.col("bloom_months_he").like(f"%{like_literal(self.month)}%"))
        if self.habitat:
            p.append(F.col("habitat_he") == F.lit(self.habitat))
        if self.zone:
            p.append(F.array_contains("climate_zone", F.lit(self.zone)))
        if self.region:
            p.append(F.array_contains("distribution_regions", F.lit(self.region)))
        if self.special in SPECIAL_COLUMNS:
            p.append(F.col(self.special) == F.lit(True))
        if self.for_sale:
            p.append(F.col("sold_by").isNotNull())
        return p

    def where(self, df: DataFrame) -> DataFrame:
        p = self.predicates()
        return df.where(reduce(lambda a, b: a & b, p)) if p else df

    def order(self) -> list[Column]:
        """QRY9/QRY10, with the key as the final tie-break (stable pages)."""
        if self.sort == "price":
            return [F.col("price_ils").desc_nulls_last(), F.col("name_he").asc_nulls_last(),
                    F.col("id").asc()]
        col = self.sort if self.sort in SORTS else "name_he"
        return [F.col(col).asc_nulls_last(), F.col("id").asc()]

    def matches(self, table: DataFrame) -> DataFrame:
        """All matching rows, projected (QRY8), unordered."""
        return project(self.where(with_layer_columns(
            with_layer_columns(table, OFFER_COLUMNS), MEDIA_COLUMNS)))

    def page(self, table: DataFrame, pages: int = 1) -> DataFrame:
        """QRY11: the first ``pages`` pages in sort order."""
        return self.matches(table).orderBy(*self.order()).limit(self.limit * pages)

    def count(self, table: DataFrame) -> DataFrame:
        """The match count shown beside a page (one row)."""
        return self.where(with_layer_columns(table, OFFER_COLUMNS)).agg(
            F.count(F.lit(1)).alias("matched"))

    def but(self, **kw) -> "CatalogQuery":
        return replace(self, **kw)


def project(df: DataFrame) -> DataFrame:
    """QRY8: the fixed 40-field projection (lists rendered as text, NRM14)."""
    return df.select(
        key_text(F.col(KEY)).alias("id"), "name_he", "name_ar", "scientific_name", "family",
        "genus", "life_form", "native_status", "invasive_status", "bloom_months_he",
        "habitat_he", "distribution_il", *SPECIAL_COLUMNS,
        list_text("statuses_he", " · ").alias("statuses"),
        list_text("distribution_regions", ", ").alias("regions"),
        list_text("climate_zone", ", ").alias("zones"),
        "leaf_shape", "leaf_margin", "stem_shape", "petals",
        list_text("common_names_en", ", ").alias("common_en"),
        list_text("synonyms_latin", ", ").alias("synonyms"),
        list_text("sold_by", ", ").alias("sold_by"),
        list_text("pot_sizes", ", ").alias("pot_sizes"),
        "price_ils", "price_band", "availability",
        list_text("source_urls", " ").alias("source_urls"), "source_url",
        *MEDIA_COLUMNS)


def facet(table: DataFrame, col: str) -> DataFrame:
    """QRY12: non-null values with counts (count desc, value asc)."""
    return (table.where(F.col(col).isNotNull()).groupBy(col)
                 .agg(F.count(F.lit(1)).alias("c")))


def facet_sorted(table: DataFrame, col: str) -> DataFrame:
    return facet(table, col).orderBy(F.col("c").desc(), F.col(col).asc())


def facet_ranked(table: DataFrame, col: str) -> DataFrame:
    """QRY12 with its order as a column: rank 1 is the most frequent value,
    ties by value.  The list holds a facet's distinct values, as the surface does."""
    rows = facet(table, col).agg(F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("minus"), col))).alias("v"))
    return rows.select(F.posexplode("v").alias("p", "x")).select(
        F.col(f"x.{col}").alias(col), (-F.col("x.minus")).alias("c"), (F.col("p") + 1).cast("bigint").alias("rank"))


def array_facet(table: DataFrame, col: str, alias: str) -> DataFrame:
    """QRY13: unnest a list column and count its elements."""
    return (table.select(F.explode(col).alias(alias)).groupBy(alias)
                 .agg(F.count(F.lit(1)).alias("c")))


def stats(table: DataFrame) -> DataFrame:
    """QRY14 + QRY15: totals and the classified share, one row."""
    t = with_layer_columns(table, OFFER_COLUMNS)
    row = t.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct("family").alias("fams"),
        F.count_if(F.col("invasive_status") != "not_listed").alias("invas"),
        F.count_if(F.col("sold_by").isNotNull()).alias("sale"),
        F.count_if(F.col("life_form").isNotNull()).alias("lifed"))
    pct = F.round(F.try_divide(F.col("lifed") * 100.0, F.col("total")), 0).cast("bigint")
    return row.withColumn("pct_classified", pct)


def lookup(table: DataFrame, key) -> DataFrame:
    """QRY16: one entity by key."""
    return table.where(F.col(KEY) == F.lit(key))


def provenance_of(prov: DataFrame, key) -> DataFrame:
    """QRY17: the provenance rows of one key."""
    return prov.where(F.col(KEY) == F.lit(key))


def row_count(df: DataFrame) -> DataFrame:
    """QRY18 as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n"))
