"""Approximate nearest neighbours (operator 11): adaptive dimension scan.

Index (:func:`build`).  Every row is dealt to the nearest of at most
:data:`MAX_LISTS` centroids and written to the shared folder.  Centroids, the
number of lists to probe and the queries' first radius come from a sample of at
most :data:`SAMPLE` rows, chosen by a hash of the id; the number of probed lists
is the least that finds :data:`TARGET_RECALL` of the sample's own neighbours.

Search (:func:`search`).  A query probes its nearest lists and those of its
nearest sample rows.  Within a list, vectors are rotated by one random
orthogonal matrix and read in blocks of :data:`COLUMNS` columns.  After a block
the partial distance, scaled to all dimensions, is tested against the radius:
a candidate whose scaled distance exceeds ``(1 + EPS / sqrt(columns seen))``
times the radius is abandoned.  Most candidates are left after a part of the
columns.  What survives gets its exact distance from the original vectors, in
double precision.  The first radius is the distance of the ``k + 1``-th sample
row, which bounds the answer from above; those rows themselves are never
abandoned, so a query always gets its ``k`` rows.

What keeps it bounded: a list is split by a hash of the vector into parts of
about :data:`PART_ROWS` rows, so that a list that holds a third of all rows is
many parts, and the queries of a list are copied to its parts.  A task streams
parts sorted by (list, part): one part is in memory, its queries pass by in
chunks.  Of equal vectors only the ``k + 1`` smallest ids can ever be answers
(ties go to the smaller id), so copies fold to these, map-side and again in the
part; equal query vectors are searched once.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite
entry, and rows with a null id, take no part.  A query's own row is every row
with its id; an id that several rows share is listed once, at its nearest, and
as a query it stands for its least vector.  With fewer than ``k`` candidates
all come back, empty tables give an empty result, vectors of unequal length are
an error, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import staged
from verdant.llm.vectors import digest, finite, lists, matrix

TOP = 10
SAMPLE, MAX_LISTS, ROUNDS, TRIALS = 16384, 1024, 8, 256
TARGET_RECALL = 0.96
COLUMNS, EPS = 16, 2.1
PART_ROWS, CELLS = 16384, 1 << 20
SEED = 11
RESULT = "query_id long, rank int, vec_id long, score double"
_STREAM = "list int, part int, kind int, id long, vec array<double>, qkey binary, radius2 double, seeds array<long>"


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal d x d matrix, the same for a seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def _nearest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    step = max(1, CELLS // max(1, len(b)))
    return np.concatenate([squared(a[i:i + step], b).argmin(1) for i in range(0, len(a), step)] or [np.zeros(0, int)])


def centroids(x: np.ndarray, k: int, seed: int = SEED) -> np.ndarray:
    """k-means of the sample; a centroid without rows stays where it was."""
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        own = _nearest(x, c)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def probes_needed(x: np.ndarray, c: np.ndarray, k: int, target: float = TARGET_RECALL) -> int:
    """The least number of nearest lists that hold ``target`` of the ``k`` nearest
    sample rows, over at most TRIALS sample rows as queries."""
    if len(x) < 2:
        return len(c)
    at = np.unique(np.linspace(0, len(x) - 1, TRIALS).astype(int))
    own, place = _nearest(x, c), []
    for i in at:
        d = squared(x[i:i + 1], x)[0]
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(x) - 1)]
        order = np.empty(len(c), dtype=int)
        order[squared(x[i:i + 1], c)[0].argsort()] = np.arange(len(c))
        place.append(order[own[near]])
    share = np.bincount(np.concatenate(place), minlength=len(c)).cumsum() / sum(map(len, place))
    return int(np.searchsorted(share, target) + 1)


@dataclass
class Index:
    rows: DataFrame                # list int, hash long, id long, vec array<double>
    sizes: DataFrame               # list int, parts int (at most MAX_LISTS rows)
    parts: np.ndarray              # parts of each list
    centroids: np.ndarray
    rotation: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    probes: int
    k: int


def fold(vecs: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Rows that can be answers: of equal vectors, one row of each of the ``keep``
    smallest ids."""
    raw = np.ascontiguousarray(vecs + 0.0)                    # -0.0 equals 0.0
    raw = raw.view(np.dtype((np.void, raw.shape[1] * 8)))[:, 0]
    _, group = np.unique(raw, return_inverse=True)
    order = np.lexsort((ids, group))
    g, i = group[order], ids[order]
    fresh = np.r_[True, (g[1:] != g[:-1]) | (i[1:] != i[:-1])]
    order, g = order[fresh], g[fresh]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    place = np.arange(len(g)) - np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    return np.sort(order[place < keep])


def valid(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, vec)`` of the rows that take part."""
    vec = F.col(vec_col)
    return (rows.where(F.col(id_col).isNotNull() & finite(vec) & F.exists(vec, lambda e: e != 0))
            .select(F.col(id_col).cast("long").alias("id"), F.transform(vec, lambda e: e.cast("double")).alias("vec")))


def build(rows: DataFrame, k: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding",
          sample: int = SAMPLE, max_lists: int = MAX_LISTS, part_rows: int = PART_ROWS,
          target: float = TARGET_RECALL) -> Index | None:
    """Index every valid row; None if there is none."""
    spark, base = rows.sparkSession, valid(rows, id_col, vec_col)
    total = base.count()
    if not total:
        return None
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    drawn = (base.where(draw < F.lit(int(min(1.0, 1.05 * sample / total) * (1 << 30))))
             .orderBy(draw, "id", "vec").limit(sample).collect()) or base.limit(sample).collect()
    by_id = {}
    for r in drawn:
        by_id.setdefault(r.id, r.vec)
    ids = np.array(sorted(by_id), dtype=np.int64)
    x = np.array([by_id[i] for i in ids.tolist()], dtype=np.float64)
    distinct = np.unique(x, axis=0)
    n_lists = max(1, min(max_lists, round(total ** 0.5), len(distinct) // 8))
    c = centroids(distinct, n_lists)
    keep = k + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v, own = matrix(batch.column("vec"), np.float64), np.asarray(batch.column("id"))
                left = fold(v, own, keep)
                v = v[left]
                yield pa.RecordBatch.from_arrays([pa.array(_nearest(v, c).astype(np.int32)), pa.array(own[left]),
                                                  lists(v, pa.float64())], ["list", "id", "vec"])

    dealt = staged(base.mapInArrow(deal, "list int, id long, vec array<double>")
                   .withColumn("hash", F.xxhash64("vec")), "vectors")
    parts = np.ones(n_lists, dtype=np.int64)
    for r in dealt.groupBy("list").count().collect():          # a row a list, at most max_lists
        parts[r["list"]] = -(-r["count"] // part_rows)
    sizes = spark.createDataFrame(list(enumerate(parts.tolist())), "list int, parts int")
    return Index(dealt, sizes, parts, c, rotation(x.shape[1]), ids, x, probes_needed(distinct, c, k, target), k)


def _probing(queries: DataFrame, index: Index) -> DataFrame:
    """The stream rows of the distinct query vectors: one a probed part."""
    c, x, ids, parts, need, k = index.centroids, index.sample, index.sample_ids, index.parts, index.probes, index.k
    homes = _nearest(x, c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                v = matrix(batch.column("vec").slice(row, 1), np.float64)
                d = squared(v, x)[0]
                near = np.argsort(d, kind="stable")[:k + 1]
                radius = float(((x[near[-1]] - v[0]) ** 2).sum()) if len(near) > k else float("inf")
                asked = np.union1d(squared(v, c)[0].argsort(kind="stable")[:need], homes[near])
                where = np.repeat(asked, parts[asked])
                part = np.concatenate([np.arange(parts[p]) for p in asked])
                n, key = len(where), batch.column("qkey")[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array([1] * n, pa.int32()),
                     pa.nulls(n, pa.int64()), lists(np.repeat(v, n, 0), pa.float64()), pa.array([key.as_py()] * n),
                     pa.array([radius] * n), lists(np.repeat(ids[near][None], n, 0), pa.int64())],
                    ["list", "part", "kind", "id", "vec", "qkey", "radius2", "seeds"])

    return queries.mapInArrow(run, _STREAM)


def scan(cells: np.ndarray, queries: np.ndarray, radius2: np.ndarray, eps: float = EPS,
         columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Adaptive scan of rotated vectors: the (query, vector) places that no test
    abandoned.  Blocks of columns are read for all pairs as long as many are left,
    then for the pairs left."""
    d = cells.shape[1]
    total = np.zeros((len(queries), len(cells)))
    q = v = far = None
    for lo in range(0, d, columns):
        hi = min(d, lo + columns)
        limit = radius2 * (hi / d) * ((1 + eps / hi ** 0.5) ** 2 if hi < d else 1 + 1e-9)
        if q is None:
            total += squared(queries[:, lo:hi], cells[:, lo:hi])
            left = total <= limit[:, None]
            if np.count_nonzero(left) * 8 < left.size:
                q, v = np.nonzero(left)
                far = total[q, v]
        else:
            far = far + ((queries[q, lo:hi] - cells[v, lo:hi]) ** 2).sum(1)
            left = far <= limit[q]
            q, v, far = q[left], v[left], far[left]
    return np.nonzero(left) if q is None else (q, v)


class Part:
    """The vectors of one part, folded while they arrive, and their scan."""

    def __init__(self, keep: int, turn: np.ndarray, part_rows: int):
        self.keep, self.turn, self.most = keep, turn, 2 * part_rows
        self.clear()

    def clear(self) -> None:
        self.ids, self.vecs, self.rows, self.turned = [], [], 0, None

    def add(self, ids: np.ndarray, vecs: np.ndarray) -> None:
        self.ids.append(ids)
        self.vecs.append(vecs)
        self.rows += len(ids)
        if self.rows > self.most:
            self._fold()
            self.most = max(self.most, 2 * self.rows)

    def _fold(self) -> None:
        ids, vecs = np.concatenate(self.ids), np.concatenate(self.vecs)
        left = fold(vecs, ids, self.keep)
        order = left[np.argsort(ids[left], kind="stable")]
        self.ids, self.vecs, self.rows = [ids[order]], [vecs[order]], len(order)

    def close(self) -> None:
        self._fold()
        self.turned = self.vecs[0] @ self.turn

    def answers(self, queries: np.ndarray, radius2: np.ndarray, seeds: list[np.ndarray]):
        """Of each query the ``keep`` nearest found here: (query place, ids, squared distances)."""
        ids, vecs, step = self.ids[0], self.vecs[0], max(1, CELLS // len(self.ids[0]))
        for lo in range(0, len(queries), step):
            part = queries[lo:lo + step]
            q, v = scan(self.turned, part @ self.turn, radius2[lo:lo + step])
            named = seeds[lo:lo + step]
            sq, sid = np.repeat(np.arange(len(named)), [len(s) for s in named]), np.concatenate(named)
            first, past = np.searchsorted(ids, sid, "left"), np.searchsorted(ids, sid, "right")
            runs = past - first                               # an id may have several vectors
            q = np.r_[q, np.repeat(sq, runs)]
            v = np.r_[v, np.repeat(first, runs) + np.arange(runs.sum()) - np.repeat(runs.cumsum() - runs, runs)]
            q, v = np.divmod(np.unique(q * len(ids) + v), len(ids))
            far = np.empty(len(q))
            for i in range(0, len(q), 1 << 15):               # in pieces; entries are added from first to last
                s = slice(i, i + (1 << 15))
                far[s] = np.add.reduce(np.ascontiguousarray(((vecs[v[s]] - part[q[s]]) ** 2).T), axis=0)
            order = np.lexsort((ids[v], far, q))
            q, v, far = q[order], v[order], far[order]
            starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, int)
            place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
            left = self._first_of_ids(q, ids[v], place)
            yield lo + q[left], ids[v[left]], far[left]

    def _first_of_ids(self, q, ids, place):
        """Places kept: an id counts once, at its nearest."""
        _, first = np.unique(np.stack([q, ids], 1), axis=0, return_index=True) if len(q) else (None, np.zeros(0, int))
        once = np.zeros(len(q), dtype=bool)
        once[first] = True
        rank = np.cumsum(once) - 1
        if len(q):
            start = np.flatnonzero(place == 0)
            rank = rank - np.repeat(rank[start], np.diff(np.r_[start, len(q)]))
        return np.flatnonzero(once & (rank < self.keep))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    keys = np.stack([np.asarray(batch.column(c)) for c in ("list", "part", "kind")], 1)
    cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, len(keys)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield (int(keys[a, 0]), int(keys[a, 1])), int(keys[a, 2]), batch.slice(a, b - a)


def found(queries: DataFrame, index: Index, part_rows: int = PART_ROWS) -> DataFrame:
    """``(qkey, id, score)``: the nearest of every probed part, at most ``k + 1`` each."""
    turn, keep = index.rotation, index.k + 1
    cells = (index.rows.join(F.broadcast(index.sizes), "list")          # at most MAX_LISTS rows
             .select("list", F.pmod("hash", F.col("parts").cast("long")).cast("int").alias("part"),
                     F.lit(0).alias("kind"), "id", "vec", F.lit(None).cast("binary").alias("qkey"),
                     F.lit(None).cast("double").alias("radius2"), F.lit(None).cast("array<long>").alias("seeds")))
    stream = (cells.unionByName(_probing(queries, index)).repartition("list", "part")
              .sortWithinPartitions("list", "part", "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = None, Part(keep, turn, part_rows)
        for batch in batches:
            for key, kind, rows in _runs(batch) if batch.num_rows else ():
                if key != at:
                    at = key
                    part.clear()
                if kind == 0:
                    part.add(np.asarray(rows.column("id")), matrix(rows.column("vec"), np.float64))
                    continue
                if not part.rows:
                    continue
                if part.turned is None:
                    part.close()
                names = rows.column("qkey")
                for q, ids, far in part.answers(matrix(rows.column("vec"), np.float64),
                                                np.asarray(rows.column("radius2")),
                                                [np.asarray(s.values) for s in rows.column("seeds")]):
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(q)), pa.array(ids), pa.array(np.sqrt(far))],
                                                     ["qkey", "id", "score"])

    return stream.mapInArrow(run, "qkey binary, id long, score double")


def search(rows: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding",
           **options) -> DataFrame:
    """The ``k`` nearest rows of each query (:data:`RESULT`)."""
    spark = rows.sparkSession
    index = build(rows, k, id_col, vec_col, **options)
    if index is None:
        return spark.createDataFrame([], RESULT)
    asked = (valid(queries, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec"))
             .withColumn("qkey", digest(F.col("vec"))))
    asked = staged(asked, "vector-queries")
    distinct = asked.groupBy("qkey").agg(F.any_value("vec").alias("vec"))
    near = found(distinct, index, options.get("part_rows", PART_ROWS)).groupBy("qkey", "id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("qkey").orderBy("score", "id")
    best = (near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
            .groupBy("qkey").agg(F.array_sort(F.collect_list(F.struct("score", "id"))).alias("best")))
    own = asked.select(F.col("id").alias("query_id"), "qkey").join(best, "qkey")
    picked = F.slice(F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(picked).alias("p", "b")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.score").alias("score"))
