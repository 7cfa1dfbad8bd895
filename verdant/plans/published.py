"""The whole build over published tables (phases 1 to 3, SNK1-SNK9).

Spine, offer layer, media layer, status and the joined catalogue are published
bucketed and sorted by key with one bucket count.  The layers are attached by
joins of co-partitioned tables: the spine is read bucket by bucket and never
shuffled, whatever its size.  Provenance is bucketed without a shuffle: its hot
keys stay spread over the tasks that made them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.operators import media as M
from verdant.operators import offers as O
from verdant.operators.layers import MEDIA_COLUMNS, OFFER_COLUMNS, attach_layer, replace_provenance
from verdant.operators.staging import crosswalk
from verdant.plans import publish as P
from verdant.plans.build import build_catalog
from verdant.session import written

BUCKETS = 64


@dataclass
class Inputs:
    """What a build reads."""
    eav: DataFrame
    match: DataFrame
    status: DataFrame
    offers: DataFrame
    seller: str
    pairs: DataFrame
    files: DataFrame
    occurrences: DataFrame
    occurrence_limit: int | None = None


class Published:
    """Published tables under ``base``."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS):
        self.spark, self.base, self.buckets = spark, base, buckets

    def table(self, name: str) -> DataFrame:
        return P.read_bucketed(self.spark, self.base, name)

    def put(self, name: str, df: DataFrame) -> None:
        """A table with one row a key, or few."""
        P.write_bucketed(df, self.base, name, self.buckets)

    def put_as_is(self, name: str, df: DataFrame) -> None:
        P.write_bucketed_as_is(df, self.base, name, self.buckets)

    def attached(self) -> DataFrame:
        """The 41 published columns: spine with both layers, no shuffle (JON7)."""
        out = attach_layer(self.table("spine"), self.table("offers"), OFFER_COLUMNS)
        return P.ensure_columns(attach_layer(out, self.table("media"), MEDIA_COLUMNS))


def build(spark: SparkSession, base: str, given: Inputs, profile: L.Profile = L.REFERENCE_PROFILE,
          buckets: int = BUCKETS, name_col: str = "name_he") -> Published:
    """Phases 1 to 3: every sink of the catalogue, each table read back from its sink."""
    out = Published(spark, base, buckets)
    P.write_eav(given.eav, base)                                                        # SNK1
    eav = P.read_current(spark, base, "eav")
    P.write_csv(crosswalk(eav), base, "crosswalk", order_by=["name_he", "name_lat", "source_id"])   # SNK2
    made = build_catalog(eav, given.match, given.status, profile, keep=written)
    out.put("spine", made.canonical)                                                    # SNK4
    P.write_csv(made.review, base, "review", order_by=["source_id"])                    # SNK3
    out.put_as_is("provenance_spine", made.provenance)                                  # SNK5

    spine = out.table("spine")
    out.put_as_is("matched", O.match_offers(given.offers, spine, name_col, keep=written))
    matched = out.table("matched")
    out.put("offers", O.offers_by_key(matched, given.seller))
    P.write_csv(O.unmatched(matched), base, "unmatched", order_by=["source_id"])        # SNK6
    out.put("picked", M.pick_media(spine, given.pairs, given.files, given.occurrences,
                                   occurrence_limit=given.occurrence_limit))
    picked = out.table("picked")
    out.put("media", M.media_layer(picked))                                             # MED4
    P.write_json(picked, base, "media_records")                                         # SNK9

    prov = replace_provenance(out.table("provenance_spine"), O.offer_provenance(matched, given.seller),
                              source=given.seller)                                      # OFR5
    prov = replace_provenance(prov, M.media_provenance(picked), field="image")          # MED5
    out.put_as_is("provenance", prov)
    out.put("catalogue", out.attached())                                                # SNK7
    return out


def coverage(out: Published) -> DataFrame:
    """MED6 over the published tables."""
    return M.media_coverage(out.table("spine").select(P.KEY), out.table("picked"))


def unmatched_of(out: Published) -> DataFrame:
    """SNK6 read back."""
    return P.read_csv(out.spark, out.base, "unmatched",
                      "source_id string, name_he string, category string, price double, url string")


def review_of(out: Published) -> DataFrame:
    """SNK3 read back."""
    return P.read_csv(out.spark, out.base, "review",
                      "source_id string, name_he string, name_lat string, reason string, "
                                 "confidence int, matchType string")


def crosswalk_of(out: Published) -> DataFrame:
    """SNK2 read back."""
    return P.read_csv(out.spark, out.base, "crosswalk",
                      "name_he string, name_lat string, source string, source_id string")


def tally_of(out: Published, names=("spine", "offers", "media", "provenance", "catalogue")) -> DataFrame:
    """Rows of the published tables, one row a table."""
    parts = [out.table(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table"), "n") for n in names]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows
