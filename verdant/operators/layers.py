"""Layer plumbing: attach a keyed layer to the spine, replace provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "canonical_taxon_id"

OFFER_COLUMNS = {"sold_by": "array<string>", "pot_sizes": "array<string>",
                 "price_ils": "double", "price_band": "string",
                 "availability": "string", "source_urls": "array<string>"}
MEDIA_COLUMNS = {"image_thumb": "string", "image_source": "string",
                 "image_license": "string", "image_credit": "string",
                 "image_page": "string"}


def attach_layer(spine: DataFrame, layer: DataFrame, columns: dict, key: str = KEY) -> DataFrame:
    """JON7: drop the layer's columns from the spine, left-join the new ones.

    ``layer`` must be unique per key (every layer builder aggregates by key),
    so the spine keeps exactly its rows; keys without a layer get typed nulls.
    Re-running with the same layer gives the same table (idempotent).
    """
    base = spine.drop(*[c for c in columns if c in spine.columns])
    lay = layer.select(key, *[F.col(c).cast(t).alias(c) for c, t in columns.items()])
    return base.join(lay, key, "left")


def with_layer_columns(df: DataFrame, columns: dict) -> DataFrame:
    """Typed null columns for layers that have not run (query surface needs all)."""
    for c, t in columns.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    return df


def replace_provenance(prov: DataFrame, new: DataFrame, *, source: str | None = None,
                       field: str | None = None) -> DataFrame:
    """OFR5 / MED5: drop the rows of one source (or field), append the new ones."""
    if source is not None:
        keep = F.col("source").isNull() | (F.col("source") != source)
    else:
        keep = F.col("field").isNull() | (F.col("field") != field)
    return prov.where(keep).unionByName(new.select(*prov.columns))
