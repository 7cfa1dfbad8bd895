"""Facet bitmaps (QRY2-QRY7 with QRY12 and QRY13).

The surface shows, for each facet, its values with their counts under the
filters that are active on the *other* facets.  Here a stored index answers any
combination of filters:

* each row of the catalogue gets a number; a block is 32,768 numbers;
* ``bits``: one bitmap a (field, value, block), made by the native bitmap
  aggregates; list columns give a bit to each of their values.

For a set of filters the bitmaps of a block are ANDed (values of one field are
alternatives and are ORed first), and the facet's own bitmaps are ANDed with the
result and counted.  All of it is keyed by block and combined map-side; nothing
grows with the rows of a value but the number of its blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.plans import publish as P
from verdant.plans.surface import SPECIAL_COLUMNS

ALL = "*"                     # the field whose one value every row has


@dataclass(frozen=True)
class Field:
    """A facet: its name and the SQL expression of a row's values (an array of strings)."""
    name: str
    values: str


def scalar(name: str, col: str | None = None) -> Field:
    return Field(name, f"array(cast({col or name} AS string))")


def listed(name: str, col: str | None = None) -> Field:
    return Field(name, f"cast({col or name} AS array<string>)")


def surface_fields() -> list[Field]:
    """The facets of the catalogue surface."""
    special = ", ".join(f"IF({c}, '{c}', NULL)" for c in SPECIAL_COLUMNS)
    return [scalar("life_form"), scalar("invasive_status"), scalar("family"), scalar("habitat", "habitat_he"),
            listed("zone", "climate_zone"), listed("region", "distribution_regions"),
            Field("special", f"array({special})"), Field("for_sale", "array(IF(sold_by IS NOT NULL, 'yes', NULL))")]


class FacetIndex:
    """A stored facet index of a table."""

    def __init__(self, spark: SparkSession, base: str, name: str = "facets"):
        self.spark, self.base, self.name = spark, base, name

    def build(self, table: DataFrame, key: str, fields: list[Field]) -> "FacetIndex":
        """Number the rows (kept with their key) and write the bitmaps."""
        pairs = F.concat(*[F.transform(F.coalesce(F.expr(f.values), F.array().cast("array<string>")), _tagged(f.name))
                           for f in fields], F.array(F.struct(F.lit(ALL).alias("field"), F.lit(ALL).alias("value"))))
        numbered = table.select(F.col(key).alias("key"), F.array_distinct(pairs).alias("pairs"),
                                F.monotonically_increasing_id().alias("row"))
        P.write_version(numbered, self.base, f"{self.name}_rows")
        rows = P.read_current(self.spark, self.base, f"{self.name}_rows")
        bits = (rows.select(F.bitmap_bucket_number("row").alias("block"), F.bitmap_bit_position("row").alias("bit"),
                            F.explode("pairs").alias("p"))
                .where(F.col("p.value").isNotNull())
                .groupBy("p.field", "p.value", "block").agg(F.bitmap_construct_agg("bit").alias("bits")))
        P.write_version(bits.repartitionByRange("field", "value", "block").sortWithinPartitions("field", "value", "block"),
                        self.base, f"{self.name}_bits")
        return self

    def _bits(self) -> DataFrame:
        return P.read_current(self.spark, self.base, f"{self.name}_bits")

    def mask(self, active: dict[str, list[str]]) -> DataFrame:
        """``(block, bits)`` of the rows that pass all filters: of each field one of its values."""
        wanted = {ALL: [ALL], **active}
        cond = F.lit(False)
        for field, values in wanted.items():
            cond = cond | ((F.col("field") == field) & F.col("value").isin(values))
        return (self._bits().where(cond)
                .groupBy("block", "field").agg(F.bitmap_or_agg("bits").alias("bits"))
                .groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.bitmap_and_agg("bits").alias("bits"))
                .where(F.col("n") == len(wanted)).select("block", "bits"))

    def counts(self, field: str, active: dict[str, list[str]] | None = None) -> DataFrame:
        """``(field, value, c)``: the facet's values with their counts under the
        filters of the other fields; values without a row under them are left out."""
        others = {f: v for f, v in (active or {}).items() if f != field}
        own = self._bits().where(F.col("field") == field)
        both = (own.join(self.mask(others).withColumnRenamed("bits", "mask"), "block")
                .select("field", "value", "block", F.explode(F.array("bits", "mask")).alias("bits"))
                .groupBy("field", "value", "block").agg(F.bitmap_and_agg("bits").alias("bits")))
        return (both.groupBy("field", "value").agg(F.sum(F.bitmap_count("bits")).alias("c")).where("c > 0"))

    def count(self, active: dict[str, list[str]]) -> DataFrame:
        """The match count shown beside a page (one row)."""
        return self.mask(active).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("matched"))

    def keys(self, active: dict[str, list[str]]) -> DataFrame:
        """The keys of the rows that pass all filters."""
        rows = P.read_current(self.spark, self.base, f"{self.name}_rows").select(
            "key", F.bitmap_bucket_number("row").alias("block"), F.bitmap_bit_position("row").alias("bit"))
        byte = "cast(conv(hex(substring(bits, cast(bit div 8 + 1 AS int), 1)), 16, 10) AS int)"
        set_ = F.expr(f"bit_get({byte}, cast(bit % 8 AS int)) = 1")
        return rows.join(self.mask(active), "block").where(set_).select("key")


def _tagged(name: str):
    return lambda x: F.struct(F.lit(name).alias("field"), x.alias("value"))
