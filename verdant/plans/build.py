"""The catalogue build as one lazy plan per phase.

Phase 1+2: records -> EAV -> pivot -> resolve -> reconcile (+status)
Phase 3:   offers matched onto the published spine
Media:     media records attached by key

Two frames are materialised, each read twice downstream: the pivoted
records (distinct names and the join back of the resolve) and the resolved
records (canonical rows and review queue).  The materialisation is a
reliable checkpoint in the folder named by ``spark.checkpoint.dir``, so a
lost executor does not force a re-run from the raw pages.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from verdant import lookups as L
from verdant.operators import offers as O
from verdant.operators import media as M
from verdant.operators.layers import MEDIA_COLUMNS, OFFER_COLUMNS, attach_layer, replace_provenance
from verdant.operators.reconcile import canonical_table, provenance, reconcile
from verdant.operators.resolve import resolve_records, split_review
from verdant.operators.staging import pivot_records
from verdant.session import cut_lineage


@dataclass
class CatalogBuild:
    canonical: DataFrame
    provenance: DataFrame
    review: DataFrame
    resolved: DataFrame
    records: DataFrame


def build_catalog(eav: DataFrame, match: DataFrame, status: DataFrame | None = None,
                  profile: L.Profile = L.REFERENCE_PROFILE,
                  materialize: bool = True, keep: Callable[[DataFrame], DataFrame] | None = None) -> CatalogBuild:
    """STG3 -> RES -> REC (+STA3): the spine, its provenance and review queue.

    ``keep`` (a written table) takes the place of the checkpoint and also keeps the
    reconciled rows, which the spine and its provenance read."""
    # the pivot is the largest aggregate of the build and resolve reads
    # its output twice (distinct names, then the join back): keep it once
    cut = keep or (cut_lineage if materialize else lambda df: df)
    records = cut(pivot_records(eav, profile.labels))
    res = cut(resolve_records(records, match, "name_lat", "lat", profile))
    ok, review = split_review(res)
    rec = reconcile(ok, status, profile)
    rec = keep(rec) if keep else rec
    return CatalogBuild(canonical=canonical_table(rec), provenance=provenance(rec, profile),
                        review=review, resolved=ok, records=records)


def add_offers(canonical: DataFrame, prov: DataFrame, offers: DataFrame, seller: str):
    """Phase 3: (new canonical, new provenance, unmatched offers, per-key offers)."""
    matched = O.match_offers(offers, canonical)
    by_key = O.offers_by_key(matched, seller)
    canon2 = attach_layer(canonical, by_key, OFFER_COLUMNS)
    prov2 = replace_provenance(prov, O.offer_provenance(matched, seller), source=seller)
    return canon2, prov2, O.unmatched(matched), by_key


def add_media(canonical: DataFrame, prov: DataFrame, pairs: DataFrame, files: DataFrame,
              occ: DataFrame):
    """Media phase: (new canonical, new provenance, picked records)."""
    picked = M.pick_media(canonical, pairs, files, occ)
    canon2 = attach_layer(canonical, M.media_layer(picked), MEDIA_COLUMNS)
    prov2 = replace_provenance(prov, M.media_provenance(picked), field="image")
    return canon2, prov2, picked
