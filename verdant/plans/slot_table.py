"""Tables dealt to slots by a hash of their key, rewritten slot by slot.

A *manifest* maps each slot to the version that holds its rows.  An update
writes only the slots it touches, as a new version, and returns a manifest that
keeps pointing at the old files of all other slots.  Whoever publishes the
manifest makes the update visible; until then, and after a failure, readers of
the old manifest see the old rows.

The number of slots bounds every manifest and every list of touched slots (the
only thing that reaches the driver).  A hot slot is written by several tasks:
``rebalance`` splits it by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

Manifest = dict[int, str]


class SlotTable:
    def __init__(self, spark: SparkSession, base: str, name: str, slots: int):
        self.spark, self.home, self.slots = spark, f"{base.rstrip('/')}/{name}", slots

    def slot(self, *key: str | Column) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.slots)).cast("int")

    def touched(self, df: DataFrame, *key: str | Column) -> list[int]:
        """The slots of the keys of ``df`` (at most ``slots`` rows are collected)."""
        return sorted(r.slot for r in df.select(self.slot(*key).alias("slot")).distinct().collect())

    def read(self, manifest: Manifest, schema: StructType, slots: list[int] | None = None) -> DataFrame:
        """The rows of all slots, or of some: other slots' files are not listed."""
        paths = [f"{self.home}/v={v}/slot={s}" for s, v in sorted(manifest.items()) if slots is None or s in slots]
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = StructType([*schema.fields, StructField("v", StringType()), StructField("slot", IntegerType())])
        return (self.spark.read.schema(full).option("basePath", self.home).parquet(*paths)
                .select(*schema.fieldNames()))

    def rewrite(self, manifest: Manifest, rows: DataFrame, slot: Column, touched: list[int], version: str) -> Manifest:
        """Write ``rows``, the new content of the ``touched`` slots; the new manifest."""
        path = f"{self.home}/v={version}"
        (rows.withColumn("slot", slot).hint("rebalance", "slot")
         .write.mode("errorifexists").partitionBy("slot").parquet(path))
        # slots left without rows have no folder and leave the manifest
        filled = (self.spark.read.schema("slot int").option("basePath", path).parquet(path).distinct().collect()
                  if touched else [])
        kept = {s: v for s, v in manifest.items() if s not in set(touched)}
        return kept | {r.slot: version for r in filled}
