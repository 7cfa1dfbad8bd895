"""The driver's tables as inputs of the kept-state queries.

``documents`` and ``pages`` become part-like rows (the shape of
:mod:`~verdant.plans.demo_inputs`, so that its rules for records, match table
and profile apply), with names that grow with the data: an adjective and a noun
by the row's size, so that every rung of the ladder occurs, and a word of the
text.  The same rules are written in SQL in ``store_sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.functions.text import bare_name
from verdant.operators.staging import eav_from_records
from verdant.operators.status import potential_keys, status_frame
from verdant.plans.demo_inputs import SELLER, match_table, media_inputs, offers, part_records, table
from verdant.plans.published import Inputs
from verdant.session import written

# FIXED VALUES of the demo: the name tokens and types of ``part``
ADJECTIVES = ["small", "large", "red", "blue", "old", "new", "hot", "cold"]
NOUNS = ["ring", "widget", "bolt", "gear", "rod", "plate", "anvil", "gizmo"]
TYPES = ["PROMO", "ECONOMY", "SMALL", "LARGE", "MEDIUM"]
PAGE_IDS = 1_000_000_000           # ids of page records start here
H1 = r"(?s)<h1>(.*?)</h1>"


def word(text: Column, i: int) -> Column:
    """The ASCII letters of the ``i``-th blank-separated piece of a text; only the text up
    to that piece is looked at."""
    piece = F.regexp_extract(F.coalesce(text, F.lit("")), rf"^(?:[^ ]*+ ){{{i - 1}}}([^ ]*+)", 1)
    return F.lower(F.regexp_replace(piece, "[^A-Za-z]", ""))


def _pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))


def part_like(key: Column, text: Column, n: Column, brand: Column, first: int = 1) -> list[Column]:
    """Part columns from a key, a text, a size and a brand; the name is of word ``first``."""
    n = F.coalesce(n, F.lit(0)).cast("long")
    w = word(text, first)
    return [key.cast("long").alias("p_partkey"),
            F.concat_ws(" ", _pick(ADJECTIVES, n), _pick(NOUNS, F.length(w)), w).alias("p_name"),
            F.concat(F.lit("Brand#"), F.coalesce(brand, F.lit(""))).alias("p_brand"),
            _pick(TYPES, n).alias("p_type"), (n % 50 + 1).alias("p_size"), n.alias("p_retailprice")]


def part_of_doc(first: int = 1) -> list[Column]:
    return part_like(F.col("doc_id"), F.col("text"), F.col("n_chars"), F.col("lang"), first)


def doc_parts(docs: DataFrame, first: int = 1) -> DataFrame:
    return docs.select(*part_of_doc(first))


def page_parts(pages: DataFrame) -> DataFrame:
    return pages.select(*part_like(F.col("page_id") + PAGE_IDS, F.regexp_extract("html", H1, 1), F.length("html"),
                                   F.lit("page")))


def changes(spark, sf):
    """The batches of the incremental build: (id, part-like rows, ids that go).

    All documents; the documents of quality 0 under another name; the toxic ones
    go; all pages come, and with them the toxic documents of quality 1 as at first."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")

    def those(cond: str) -> DataFrame:
        return docs.join(labels.where(cond).select("doc_id"), "doc_id", "left_semi")

    moved, toxic, back = those("quality = 0"), those("toxic = 1"), those("toxic = 1 and quality = 1")
    none = doc_parts(docs).limit(0)
    return [("0-all", doc_parts(docs), None), ("1-moved", doc_parts(moved, 3), moved), ("2-gone", none, toxic),
            ("3-pages", page_parts(table(spark, sf, "pages")).unionByName(doc_parts(back)), None)]


def record_ids(docs: DataFrame) -> DataFrame:
    return docs.select(F.lit("part").alias("source"), F.col("doc_id").cast("string").alias("source_id"))


def eav_of(parts: DataFrame) -> DataFrame:
    return eav_from_records(part_records(parts))


def known_names(spark, sf) -> DataFrame:
    """The match table over the names of every batch."""
    docs = table(spark, sf, "documents")
    parts = doc_parts(docs).unionByName(doc_parts(docs, 3)).unionByName(page_parts(table(spark, sf, "pages")))
    return written(match_table(parts), "match")


def typo(name: Column) -> Column:
    """A name without its third character."""
    return F.concat(F.substring(name, 1, 2), F.substring(name, 4, 1000))


def build_inputs(spark, sf, occurrence_limit: int) -> Inputs:
    """The whole build's inputs: documents are the records, line items their offers,
    labels the status lists, events the occurrences; an image stands for all names
    that share its first two tokens."""
    parts = written(doc_parts(table(spark, sf, "documents")), "parts")
    labels = table(spark, sf, "labels")
    key = F.col("doc_id").alias("canonical_taxon_id")
    listed = labels.where("toxic = 1").select(key)
    status = status_frame(listed, potential_keys(labels.where("quality = 0").select(key), listed))
    shop = offers(table(spark, sf, "lineitem"), parts).withColumn("name_he", F.col("part_name"))
    _, pairs, files, occ = media_inputs(parts, table(spark, sf, "events"))
    return Inputs(eav_of(parts), match_table(parts), status, shop, SELLER, pairs.withColumn("n", bare_name("n")),
                  files, occ, occurrence_limit)
