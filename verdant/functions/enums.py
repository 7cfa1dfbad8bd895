"""Lookup-driven enum, list and flag mappings as Column builders."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.functions.text import _c, ustrip


def ordered_enum(c, ordered_map) -> Column:
    """NRM7: first map entry whose token occurs in the text wins; none -> null."""
    c = _c(c)
    expr = None
    for token, value in ordered_map:
        cond = c.contains(token)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return F.when((c.isNotNull()) & (c != ""), expr)


def split_regions(c, region_zone: dict) -> Column:
    """NRM8: split on Latin/Arabic comma, drop notes, keep known, first-seen order."""
    parts = F.split(F.coalesce(_c(c), F.lit("")), r"(?U)[,،]\s*")
    cleaned = F.transform(parts, lambda x: ustrip(F.regexp_replace(x, r"(?U)\s*\(.*?\)\s*", "")))
    known = F.array(*[F.lit(k) for k in region_zone])
    return F.array_distinct(F.filter(cleaned, lambda x: (x != "") & F.array_contains(known, x)))


def zones(regions, region_zone: dict) -> Column:
    """NRM9: regions -> zones, distinct, sorted."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(region_zone.items())])
    return F.array_sort(F.array_distinct(F.transform(_c(regions), lambda r: F.try_element_at(m, r))))


def split_statuses(c) -> Column:
    """NRM10 (list part): split on ';', strip, drop empty."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), ";"), lambda x: ustrip(x))
    return F.filter(parts, lambda x: x != "")


def status_flags(statuses, status_map: dict, flags=L.STATUS_FLAGS) -> list[Column]:
    """NRM10 (flags): one boolean per flag, true if any mapped label is present."""
    out = []
    for flag in flags:
        labels = [k for k, v in status_map.items() if v == flag]
        if labels:
            lab = F.array(*[F.lit(x) for x in labels])
            out.append(F.exists(_c(statuses), lambda x: F.array_contains(lab, x)).alias(flag))
        else:
            out.append(F.lit(False).alias(flag))
    return out


def price_band(c, bands=L.PRICE_BANDS, top=L.TOP_BAND) -> Column:
    """NRM11: half-open bands; null price -> null band."""
    c = _c(c)
    expr = None
    for upper, name in bands:
        expr = F.when(c < upper, name) if expr is None else expr.when(c < upper, name)
    return F.when(c.isNotNull(), expr.otherwise(top))


def any_of(cols) -> Column:
    return reduce(lambda a, b: a | b, cols)
