"""Registered queries of the stored indexes, the value history and the table
comparison.  Indexes are built in a new folder under the shared one and the
result is read through them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.operators import history as H
from verdant.plans import compare as C
from verdant.plans.demo_inputs import table
from verdant.plans.facets import FacetIndex, Field, scalar
from verdant.plans.paging import Ordered, Sort, after, last_of
from verdant.plans.search_index import SearchIndex
from verdant.plans.store_inputs import part_of_doc
from verdant.plans.surface import facet
from verdant.session import work_dir, written

# FIXED VALUES of the demo: patterns with trigrams, with wildcards and without a trigram
PATTERNS = ("the and", "th_t ", "erhe%on", "on", "%", "été", "no such text", "a_b%c")
# facets of orders, and filter states of up to two of them
ORDER_FACETS = [scalar("status", "o_orderstatus"), scalar("priority", "o_orderpriority"),
                Field("year", "array(cast(year(o_orderdate) AS string))"),
                Field("months", "array(date_format(o_orderdate, 'MM'), IF(day(o_orderdate) > 28, 'late', NULL))")]
FILTERS = [{}, {"status": ["F"]}, {"months": ["late"]}, {"status": ["O", "P"], "priority": ["1-URGENT"]},
           {"year": ["1997"], "months": ["02", "03"]}, {"status": ["none"]}]
BY_PRICE = [Sort("o_totalprice", True), Sort("o_orderkey")]
AS_OF = "2024-01-15"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def search_indexed(spark, sf):
    """QRY1 through the stored trigram index: the documents each pattern finds."""
    docs = table(spark, sf, "documents")
    index = SearchIndex(spark, work_dir(spark), "doc_id", ("text", "source")).build(docs)
    return _union([index.search(p).select(F.lit(p).alias("pattern"), "doc_id") for p in PATTERNS])


def facet_counts(spark, sf):
    """QRY2-QRY7 with QRY12: every facet's counts under the filters of the other facets."""
    index = FacetIndex(spark, work_dir(spark)).build(table(spark, sf, "orders"), "o_orderkey", ORDER_FACETS)
    return _union([index.counts(f.name, a).withColumn("state", F.lit(i).cast("int"))
                   for i, a in enumerate(FILTERS) for f in ORDER_FACETS])


def facet_keys(spark, sf):
    """QRY2-QRY7: the orders that pass each filter state, by the bitmaps."""
    index = FacetIndex(spark, work_dir(spark)).build(table(spark, sf, "orders"), "o_orderkey", ORDER_FACETS)
    return _union([index.keys(a).select(F.lit(i).cast("int").alias("state"), F.col("key").alias("o_orderkey"))
                   for i, a in enumerate(FILTERS) if a])


def ranked_rows(spark, sf):
    """QRY9/QRY10: the global rank of every order by price."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return Ordered(spark, work_dir(spark), "orders").build(rows, BY_PRICE).ranked()


def ranked_facet(spark, sf):
    """QRY12 with global ranks, for a facet of any number of values: customers by their orders."""
    counts = facet(table(spark, sf, "orders"), "o_custkey")
    return Ordered(spark, work_dir(spark), "facet").build(counts, [Sort("c", True), Sort("o_custkey")]).ranked()


def page_three(spark, sf):
    """QRY11: the third page by price, sought from the last rows of the pages before."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    last = None
    for _ in range(2):
        last = last_of(after(rows, BY_PRICE, last), BY_PRICE)
    return after(rows, BY_PRICE, last)


def _event_values(spark, sf) -> DataFrame:
    """Events as snapshots: a user's latest kinds of event, and what they carried, day by day."""
    ev = table(spark, sf, "events")
    pairs = F.array(F.struct(F.lit("event").alias("attribute"), F.col("event_type").alias("value")),
                    F.struct(F.lit("key").alias("attribute"), F.get_json_object("props", "$.k").alias("value")))
    return ev.select(F.lit("events").alias("source"), F.col("user_id").cast("string").alias("source_id"),
                     F.col("ts").cast("date").alias("scraped_at"), F.explode(pairs).alias("p")).select(
        "source", "source_id", "p.attribute", "p.value", "scraped_at")


def value_history(spark, sf):
    """SRC1/STG1 over all dates: the validity intervals of every value."""
    return H.intervals(_event_values(spark, sf)).drop("source")


def history_as_of(spark, sf):
    """QRY17 as of a day, from the intervals."""
    return H.as_of(H.intervals(_event_values(spark, sf)), AS_OF).drop("source")


def table_changes(spark, sf):
    """GAT6: the rows that differ between the documents' records and a copy in which
    documents of quality 0 have another name, toxic ones are gone and German ones
    stand a second time."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    # narrow rows, made once from the texts: the document's own and those under another name
    both = written(docs.select("lang", F.struct(*part_of_doc()).alias("own"), F.struct(*part_of_doc(3)).alias("other")), "parts")
    marks = labels.groupBy(F.col("doc_id").alias("p_partkey")).agg(
        F.max(F.coalesce(F.col("quality") == 0, F.lit(False))).alias("moved"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("gone"))
    marked = both.withColumn("p_partkey", F.col("own.p_partkey")).join(marks, "p_partkey", "left")
    kept = marked.where(~F.coalesce("gone", F.lit(False)))
    right = kept.select(F.when(F.coalesce("moved", F.lit(False)), F.col("other")).otherwise(F.col("own")).alias("p"))
    right = right.unionByName(both.where("lang = 'de'").select(F.col("own").alias("p")))
    left, right = both.select("own.*"), written(right.select("p.*"), "copy")
    return C.differences(left, right)


QUERIES = {f.__name__: f for f in (search_indexed, facet_counts, facet_keys, ranked_rows, ranked_facet, page_three,
                                   value_history, history_as_of, table_changes)}
