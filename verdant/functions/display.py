"""Display-side derivations of the query surface (list text, short forms)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdant.functions.text import _c


def list_text(c, sep: str) -> Column:
    """NRM14: list -> text; a null list stays null (unlike ``concat_ws``)."""
    return F.array_join(_c(c), sep)


def key_text(c) -> Column:
    """NRM15."""
    return _c(c).cast("string")


def bloom_short(c) -> Column:
    """NRM16: tokens on commas/blanks; more than 3 -> 'first–last'; empty -> '—'."""
    c = _c(c)
    t = F.filter(F.split(c, r"(?U)[,\s]+"), lambda x: x != "")
    return (F.when(c.isNull() | (c == ""), F.lit("—"))
             .when(F.size(t) > 3, F.concat(F.element_at(t, 1), F.lit("–"), F.element_at(t, -1)))
             .otherwise(F.array_join(t, ", ")))


def badge(red_list, invasive_status, protected) -> Column:
    """NRM17: red list > listed/potential > protected > none."""
    inv = _c(invasive_status)
    return (F.when(_c(red_list), F.lit("red"))
             .when(inv.isin("listed", "potential"), inv)
             .when(_c(protected), F.lit("prot")))


def display_list(c, pattern: str = r"(?U)[,،]\s*") -> Column:
    """NRM18: text -> list on commas, empty items dropped."""
    return F.filter(F.split(F.coalesce(_c(c), F.lit("")), pattern), lambda x: x != "")
