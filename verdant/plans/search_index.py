"""Indexed substring search (QRY1): a stored trigram index.

The surface's search is ``ILIKE '%text%'`` over several columns, where ``%`` and
``_`` of the user's text stay wildcards.  The index answers it without reading
all rows:

* ``rows``: the table's key and search columns, dealt to blocks of about
  :data:`BLOCK_ROWS` rows by a hash of the key, sorted by block;
* ``postings``: the keys of a block's rows whose lower-cased column holds a trigram,
  one row or a few a (trigram, column, block), sorted by trigram, so that file
  statistics leave only the row groups of the trigrams asked for.  A task lists the
  keys of the rows that it reads one after the other: what is shuffled and sorted
  are lists, not one row a trigram of a text.

A pattern is reduced to a Boolean query: between wildcards, each run of three
characters or more must stand in the text, hence all its trigrams must; the
columns are alternatives.  Keys in all posting lists of one (column, block) are
candidates, and ``ILIKE`` on their rows decides.  A pattern without a trigram
reads all rows.  Both tables are immutable versions
(:mod:`verdant.plans.publish`).

What keeps it bounded: a posting list holds the keys of one block only, and the
lists that meet in one group are the pattern's trigrams times that.  Candidate
blocks are pushed to the scan of ``rows`` when they are few (at most
:data:`PUSHED_BLOCKS`, which is all that reaches the driver); otherwise a join
selects the rows; the answer is the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from verdant import lookups as L
from verdant.plans import publish as P
from verdant.plans.surface import like_literal

BLOCK_ROWS = 4096
PUSHED_BLOCKS = 512
_AT_ONCE = 1 << 22                  # trigrams of texts that a task lists at once, and characters cut at once
_BITS = 21                          # of a code point


def trigrams_of(pattern: str) -> list[str]:
    """The trigrams that every text that matches the (lower-cased) pattern holds."""
    runs = re.split("[%_]", pattern.lower())
    return sorted({r[i:i + 3] for r in runs for i in range(len(r) - 2)})


def trigrams(text: str) -> np.ndarray:
    """The distinct trigrams of a text, sorted, each as one number of its code points."""
    found = []
    for at in range(0, len(text) - 2, _AT_ONCE):
        code = np.frombuffer(text[at:at + _AT_ONCE + 2].encode("utf-32-le"), dtype="<u4").astype(np.int64)
        found.append(np.unique(code[:-2] << 2 * _BITS | code[1:-1] << _BITS | code[2:]))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found or [np.empty(0, dtype=np.int64)]))


def spelled(grams: np.ndarray) -> list[str]:
    """Trigrams as texts."""
    code = np.stack([grams >> 2 * _BITS, grams >> _BITS & (1 << _BITS) - 1, grams & (1 << _BITS) - 1], axis=1)
    text = code.astype("<u4").tobytes().decode("utf-32-le")
    return [text[i:i + 3] for i in range(0, len(text), 3)]


def _lists(columns: int):
    """Rows ``(gram, col, block, keys)`` of rows ``(block, key, t0, t1, ...)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.sort_by("block")
            blocks, keys = batch.column("block").to_numpy(), batch.column("key")
            for col in range(columns):
                grams, places, size = [], [], 0
                for i, text in enumerate(batch.column(f"t{col}")):
                    got = trigrams(text.as_py() or "")
                    grams.append(got)
                    places.append(np.full(len(got), i))
                    size += len(got)
                    if size >= _AT_ONCE or i == batch.num_rows - 1:
                        yield listed(col, np.concatenate(grams), np.concatenate(places), blocks, keys)
                        grams, places, size = [], [], 0

    def listed(col, grams, places, blocks, keys) -> pa.RecordBatch:
        order = np.argsort(grams, kind="stable")        # places, and so blocks, keep their order within a trigram
        grams, places = grams[order], places[order]
        new = np.ones(len(grams), dtype=bool)
        new[1:] = (grams[1:] != grams[:-1]) | (blocks[places[1:]] != blocks[places[:-1]])
        first = np.flatnonzero(new)
        ends = np.append(first, len(grams)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(spelled(grams[first]), pa.string()), pa.array(np.full(len(first), col), pa.int32()),
             pa.array(blocks[places[first]], pa.int64()), pa.ListArray.from_arrays(ends, keys.take(pa.array(places)))],
            names=["gram", "col", "block", "keys"])
    return run


def matches(columns, pattern: str) -> Column:
    """The surface's own predicate."""
    return reduce(lambda a, b: a | b, [F.col(c).ilike(f"%{like_literal(pattern)}%") for c in columns])


class SearchIndex:
    """A stored index of ``columns`` of a table, by ``key`` (unique, not null)."""

    def __init__(self, spark: SparkSession, base: str, key: str, columns=L.SEARCH_COLUMNS, name: str = "search"):
        self.spark, self.base, self.key, self.columns, self.name = spark, base, key, tuple(columns), name

    def build(self, table: DataFrame, block_rows: int = BLOCK_ROWS, files: int | None = None) -> "SearchIndex":
        """Write both tables as new versions."""
        blocks = max(1, -(-table.count() // block_rows))
        rows = table.select(F.pmod(F.xxhash64(self.key), F.lit(blocks)).alias("block"), self.key, *self.columns)
        files = files or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        P.write_version(rows.repartitionByRange(files, "block").sortWithinPartitions("block"),
                        self.base, f"{self.name}_rows")
        kept = P.read_current(self.spark, self.base, f"{self.name}_rows", schema=rows.schema)
        texts = [F.lower(F.col(c).cast("string")).alias(f"t{i}") for i, c in enumerate(self.columns)]
        key = rows.schema[self.key].dataType
        lists = (kept.where(F.col(self.key).isNotNull()).select("block", F.col(self.key).alias("key"), *texts)
                 .mapInArrow(_lists(len(texts)), StructType(
                     [StructField("gram", StringType()), StructField("col", IntegerType()),
                      StructField("block", LongType()), StructField("keys", ArrayType(key))])))
        # written before they are sorted: a sort by ranges reads its input twice
        made = P.write_version(lists, self.base, f"{self.name}_lists", repoint=False)
        P.write_version(self.spark.read.schema(lists.schema).parquet(made).repartitionByRange(files, "gram", "col", "block")
                        .sortWithinPartitions("gram", "col", "block"), self.base, f"{self.name}_postings")
        return self

    def _read(self, what: str) -> DataFrame:
        return P.read_current(self.spark, self.base, f"{self.name}_{what}")

    def candidates(self, grams: list[str]) -> DataFrame:
        """``(block, key)`` of the rows with a column that holds all ``grams``."""
        lists = self._read("postings").where(F.col("gram").isin(grams))
        both = F.aggregate(F.col("lists"), F.get("lists", 0), lambda a, b: F.array_intersect(a, b))
        lists = lists.groupBy("col", "block", "gram").agg(F.flatten(F.collect_list("keys")).alias("keys"))
        return (lists.groupBy("col", "block").agg(F.collect_list("keys").alias("lists"))
                .where(F.size("lists") == len(grams))
                .select("block", F.explode(both).alias(self.key)).distinct())

    def search(self, pattern: str) -> DataFrame:
        """The keys of the rows that match ``pattern`` as ``CatalogQuery(search=pattern)`` does."""
        rows, grams = self._read("rows"), trigrams_of(pattern)
        if grams:
            cand = self.candidates(grams)
            few = [r.block for r in cand.select("block").distinct().limit(PUSHED_BLOCKS + 1).collect()]
            if len(few) <= PUSHED_BLOCKS:
                rows = rows.where(F.col("block").isin(few))
            rows = rows.join(cand, ["block", self.key], "left_semi")
        return rows.where(matches(self.columns, pattern)).select(self.key)

    def where(self, table: DataFrame, query) -> DataFrame:
        """``query.where(table)`` with its search answered by the index."""
        if not query.search:
            return query.where(table)
        if tuple(query.search_columns) != self.columns:
            raise ValueError("the query searches other columns than the index holds")
        return query.but(search="").where(table).join(self.search(query.search), self.key, "left_semi")
