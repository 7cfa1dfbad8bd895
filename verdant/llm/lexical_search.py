"""Ranked lexical search (operator 13): multi-query common-subexpression evaluation.

All documents are ranked for each of many items by an integer BM25-like score,
a sum over the item's terms, repeats included.

1. Terms are maximal runs of letters, digits and non-ASCII characters; a pass
   over the documents keeps each document's length and the counts of the terms
   that any item asks for (:func:`term_counts`, staged).  Document frequencies,
   the number of documents and the total length come from that table.
2. Mining (:func:`share`).  The items' term multisets are compared: while some
   pair of symbols stands in two items or more, the pair that most items share
   becomes a symbol of its own.  The result is a graph of binary sums: every
   set of terms that items share is one node, nodes are built from nodes, and
   an item is the sum of the few symbols left to it.
3. Evaluation.  A block of documents fills one row per term; each level of the
   graph is one vectorised addition, so a shared set's partial scores are made
   once for all items that hold it; the items' scores are sums of node rows.
4. Each task keeps the best ``k`` documents an item, and one keyed ranking over
   the tasks' bests gives the result.

Items are the stated query set, taken in blocks of at most ``block_chars``
characters (a single longer item is a block of its own); each block is one
scan of the documents.  Mining effort is linear in the items' length: symbols
are paired within windows of :data:`WINDOW` symbols, sorted by how many items
hold them.  The graph only saves work, the scores do not depend on it.

Edge cases: null and term-less texts are no documents (they count in no
statistic) and items without terms have no rows; rows with a null doc_id count
in the statistics and are not ranked; repeated rows are documents of their own;
of rows that repeat an item_id the least text counts, and a null item_id is
left out.  Empty tables give an empty result.  Texts are read whole and
further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import staged

TOP, BLOCK_CHARS, WINDOW = 10, 1 << 19, 64
CELLS = 1 << 22            # 8-byte cells of the score matrix a task holds
_KEEP = {c: c for c in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100))}
_TABLE = bytes(_KEEP.get(c, c + 32 if 0x41 <= c <= 0x5A else 32) for c in range(256))
RESULT = "item_id long, rank int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass
class Shared:
    """The query-sharing graph of a block of items.

    Symbols 0..len(terms)-1 are the terms, then ``copies`` (a term's second,
    third ... occurrence in an item, equal in value to ``base``), then the
    nodes, by level; node = left + right.  ``items`` are the symbols left."""
    ids: list[int]
    terms: list[bytes]
    base: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    items: list[list[int]] = field(default_factory=list)

    @property
    def symbols(self) -> int:
        return len(self.terms) + len(self.base) + sum(len(n) for n, _, _ in self.levels)


def share(items: list[tuple[int, list[bytes]]]) -> Shared:
    """Mine the term sets that items share into a graph of binary sums."""
    counts = [Counter(t) for _, t in items]
    terms = sorted({t for c in counts for t in c})
    number = {t: i for i, t in enumerate(terms)}
    extra: dict[tuple[bytes, int], int] = {}
    sets = []
    for c in counts:
        s = [number[t] for t in c]
        s += [extra.setdefault((t, j), len(terms) + len(extra)) for t, k in c.items() for j in range(2, k + 1)]
        sets.append(s)
    support = Counter(x for s in sets for x in s)
    # windows: the units within which symbols are paired
    units, unit_item = [], []
    for i, s in enumerate(sets):
        s.sort(key=lambda x: (-support[x], x))
        for lo in range(0, len(s), WINDOW):
            units.append(set(s[lo:lo + WINDOW]))
            unit_item.append(i)
    held: dict[tuple[int, int], set[int]] = defaultdict(set)
    for u, s in enumerate(units):
        known = sorted(x for x in s if support[x] > 1)
        for a, x in enumerate(known):
            for y in known[a + 1:]:
                held[x, y].add(u)
    heap = [(-len(us), p) for p, us in held.items() if len(us) > 1]
    heapq.heapify(heap)
    nodes: list[tuple[int, int]] = []
    first = len(terms) + len(extra)
    while heap:
        size, pair = heapq.heappop(heap)
        now = held.get(pair, ())
        if len(now) < 2:
            continue
        if len(now) != -size:
            heapq.heappush(heap, (-len(now), pair))
            continue
        new, (x, y) = first + len(nodes), pair
        nodes.append(pair)
        fresh: dict[int, set[int]] = defaultdict(set)
        for u in sorted(now):
            s = units[u]
            s -= {x, y}
            for z in s:
                if support[z] > 1:
                    for old in ((min(x, z), max(x, z)), (min(y, z), max(y, z))):
                        held[old].discard(u)
                    fresh[z].add(u)
            s.add(new)
        support[new] = len(now)
        del held[pair]
        for z, us in fresh.items():
            held[z, new] = us
            if len(us) > 1:
                heapq.heappush(heap, (-len(us), (z, new)))
    return _leveled([i for i, _ in items], terms, extra, number, nodes, units, unit_item, len(items))


def _leveled(ids, terms, extra, number, nodes, units, unit_item, n) -> Shared:
    """Number the nodes by level, so that a level is one range of rows."""
    first, depth = len(terms) + len(extra), {}
    for k, (a, b) in enumerate(nodes):
        depth[first + k] = 1 + max(depth.get(a, 0), depth.get(b, 0))
    order = sorted(depth, key=lambda x: (depth[x], x))
    at = {x: first + k for k, x in enumerate(order)}
    levels: dict[int, list[int]] = defaultdict(list)
    for x in order:
        levels[depth[x]].append(x)
    out = Shared(ids, terms, np.array([number[t] for t, _ in extra], dtype=np.int64))
    for d in sorted(levels):
        pairs = [nodes[x - first] for x in levels[d]]
        out.levels.append((np.array([at[x] for x in levels[d]]), np.array([at.get(a, a) for a, _ in pairs]),
                           np.array([at.get(b, b) for _, b in pairs])))
    out.items = [[] for _ in range(n)]
    for u, i in zip(units, unit_item, strict=True):
        out.items[i] += sorted(at.get(x, x) for x in u)
    return out


def term_counts(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``(doc_id, n, terms, counts)`` of every document with a term: its length, and
    the wanted terms (as numbers) that it holds."""
    number = {t: i for i, t in enumerate(terms)}
    wanted = number.keys()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, lengths, ends, found, times = [], [], [0], [], []
            for row, text in enumerate(batch.column("text")):
                words = terms_of(text.as_py())
                if not words:
                    continue
                here = Counter(words)
                for t in here.keys() & wanted:
                    found.append(number[t])
                    times.append(here[t])
                keep.append(row)
                lengths.append(len(words))
                ends.append(len(found))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))], ["doc_id", "n", "terms", "counts"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The best ``k`` (score, then least doc_id) of each of ``n`` items."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.ones(n, dtype=np.int64)
        self.item = self.doc = self.score = np.zeros(0, dtype=np.int64)

    def add(self, doc_ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: items x documents."""
        item, at = np.nonzero(scores >= self.floor[:, None])
        if not len(item):
            return
        item, doc, score = (np.concatenate([a, b]) for a, b in (
            (self.item, item), (self.doc, doc_ids[at]), (self.score, scores[item, at])))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        starts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.r_[starts, len(item)]))
        keep = place < self.k
        self.item, self.doc, self.score = item[keep], doc[keep], score[keep]
        last = place == self.k - 1
        self.floor[item[last]] = score[last]


def _scored(counts: DataFrame, graph: Shared, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    ids = np.array(graph.ids, dtype=np.int64)
    flat = np.concatenate([np.array(s, dtype=np.int64) for s in graph.items])
    starts = np.cumsum([0, *(len(s) for s in graph.items[:-1])])
    first, base, levels, rows = len(graph.terms), graph.base, graph.levels, graph.symbols
    width = max(16, min(1024, CELLS // (rows + len(flat))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, table = Best(len(ids), k), np.zeros((rows, width), dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, width):
                part = batch.slice(lo, width)
                terms, tf = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                             for c in ("terms", "counts"))
                m = np.array([25 + 75 * n * n_docs // n_terms for n in part.column("n").to_pylist()], dtype=np.int64)
                at = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(part.column("terms").offsets)))
                table[:] = 0
                table[terms, at] = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m[at]))
                table[first:first + len(base)] = table[base]
                for node, left, right in levels:
                    table[node] = table[left] + table[right]
                scores = np.add.reduceat(table[flat], starts, axis=0)[:, :part.num_rows]
                best.add(np.asarray(part.column("doc_id")), scores)
        if len(best.item):
            yield pa.RecordBatch.from_arrays([pa.array(ids[best.item]), pa.array(best.doc), pa.array(best.score)],
                                             ["item_id", "doc_id", "score"])

    return counts.where("doc_id is not null and size(terms) > 0").mapInArrow(
        run, "item_id long, doc_id long, score long")


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    rows = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
            .where("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
            .orderBy("item_id"))
    block, chars = [], 0
    for r in rows.toLocalIterator():
        if block and chars + len(r.text) > block_chars:
            yield block
            block, chars = [], 0
        words = terms_of(r.text)
        if words:
            block.append((r.item_id, words))
            chars += len(r.text)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The ``k`` highest-scoring documents of each item (:data:`RESULT`)."""
    found = None
    for block in _blocks(items, block_chars):
        graph = share(block)
        counts = staged(term_counts(docs, graph.terms), "lexical-counts")
        total = counts.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not total.docs:
            continue
        holders = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator())
        weights = np.array([weight(total.docs, holders.get(t, 0)) for t in range(len(graph.terms))], dtype=np.int64)
        part = _scored(counts, graph, weights, total.docs, total.terms, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
