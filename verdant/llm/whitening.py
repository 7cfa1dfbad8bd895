"""Embedding whitening (operator 12): weighted multiplicity covariance.

1. Entries are scaled and floored to whole numbers x, and rows with the same x
   vector are grouped: a SHA-256 of the entries and the entries themselves are
   the key, copies are counted map-side, so a vector that a third of all rows
   hold costs one row a task.
2. The distinct vectors are the fit list.  Each weighs one, or (``weight =
   "copies"``) its number of rows.  Weighted sums S are whole numbers; a second
   pass adds up the centred products ``(x - S/n)' w (x - S/n)``, one matrix
   multiplication a batch.  The partial matrices (d x d, one a task) are added
   in :data:`TREE_WIDTH` tasks before the driver takes the eigenvectors.
3. Each distinct vector is whitened once, and the rows join their vector's
   result by the key (an equi-join, which AQE splits where it is skewed).
4. The covariance of the whitened fit list is measured by the same pass;
   ``identity_error`` is its largest departure from the identity.

Edge cases: rows whose vector is null, empty, or holds a null or non-finite
entry are dropped; rows with a null id stay, under a null id; repeated rows
are repeated in the result.  Components whose variance is zero to double
precision are left out, as they cannot be scaled to one: fewer than asked for
come back, none where all vectors are equal or the table is empty.  Vectors of
unequal length, and whole numbers or deviations beyond 64 bits, are errors.
Further columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import staged
from verdant.llm.vectors import digest, finite, lists, matrix

COMPONENTS, SCALE = 4, 256
TREE_WIDTH = 16
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


@dataclass(frozen=True)
class Model:
    """Fit list size (weighted), sums, and the kept components, by falling variance."""
    n: int
    sums: list[int]
    axes: np.ndarray        # d x k, unit columns
    variances: np.ndarray   # k
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _weights(batch: pa.RecordBatch, weight: str) -> np.ndarray:
    copies = np.asarray(batch.column("copies"))
    return copies if weight == "copies" else np.ones_like(copies)


def _added(df: DataFrame, step: Callable[[pa.RecordBatch], np.ndarray], columns: list[str], kind: str) -> np.ndarray | None:
    """Sum of ``step`` over all batches; None for an empty table.  Each task adds its
    batches, TREE_WIDTH tasks add the tasks' results, the driver adds the rest."""
    arrow, dtype = (pa.float64(), np.float64) if kind == "double" else (pa.int64(), np.int64)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = step(batch)
                total = part if total is None else _plus(total, part)
        if total is not None:
            yield pa.RecordBatch.from_arrays([lists(total.reshape(1, -1), arrow)], ["part"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in matrix(batch.column(0), dtype):
                total = part if total is None else _plus(total, part)
        if total is not None:
            yield pa.RecordBatch.from_arrays([lists(total.reshape(1, -1), arrow)], ["part"])

    schema = f"part array<{kind}>"
    rows = (df.select(*columns).mapInArrow(per_task, schema).repartition(TREE_WIDTH)
            .mapInArrow(again, schema).collect())
    total = None
    for r in rows:
        part = np.array(r.part, dtype=dtype)
        total = part if total is None else _plus(total, part)
    return total


def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.shape != b.shape:
        raise ValueError(f"vectors of unequal length in one table ({a.size} and {b.size} sums)")
    if a.dtype == np.int64 and max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) >= 1 << 62:
        raise OverflowError("sums beyond 64 bits")
    return a + b


def _whole(batch: pa.RecordBatch, weight: str) -> np.ndarray:
    """The weight and the weighted sums of a batch, exact."""
    x, w = matrix(batch.column("x"), np.int64), _weights(batch, weight)
    if max(int(x.max()), -int(x.min())) * int(w.sum()) >= 1 << 62:
        raise OverflowError("sums beyond 64 bits")
    return np.concatenate([[w.sum()], w @ x])


def _products(column: str, mean: np.ndarray, weight: str) -> Callable[[pa.RecordBatch], np.ndarray]:
    """Centred weighted products of a batch, flat."""
    def step(batch: pa.RecordBatch) -> np.ndarray:
        c = matrix(batch.column(column), np.float64) - mean
        return (c.T @ (c * _weights(batch, weight)[:, None])).reshape(-1)
    return step


def _covariance(df: DataFrame, column: str, mean: np.ndarray, n: int, weight: str) -> np.ndarray:
    flat = _added(df, _products(column, mean, weight), [column, "copies"], "double")
    v = flat.reshape(len(mean), len(mean)) / n
    return (v + v.T) / 2


def distinct_vectors(rows: DataFrame, vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(key, x, copies)``: every distinct x vector of the valid rows and its number of rows."""
    return _keyed(rows, vec_col, scale).groupBy("key", "x").agg(F.count(F.lit(1)).alias("copies"))


def _keyed(rows: DataFrame, vec_col: str, scale: int, *more) -> DataFrame:
    x = F.transform(vec_col, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    return rows.where(finite(F.col(vec_col))).select(*more, x.alias("x")).withColumn("key", digest(F.col("x")))


def fit(distinct: DataFrame, components: int = COMPONENTS, weight: str = "one") -> Model | None:
    """The components of the fit list; None where it is empty."""
    if weight not in ("one", "copies"):
        raise ValueError("weight is 'one' or 'copies'")
    whole = _added(distinct, lambda b: _whole(b, weight), ["x", "copies"], "long")
    if whole is None:
        return None
    n, sums = int(whole[0]), [int(s) for s in whole[1:]]
    mean = np.array([s / n for s in sums])
    v = _covariance(distinct, "x", mean, n, weight)
    e, u = np.linalg.eigh(v)
    trace = float(np.trace(v))
    falling = np.argsort(-e, kind="stable")[:components]
    falling = falling[e[falling] > trace * len(e) * np.finfo(float).eps]
    return Model(n, sums, u[:, falling], e[falling], trace)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Exact sum over dimensions of (n x - S)^2."""
    most = n * max(int(x.max()), -int(x.min())) + max(abs(s) for s in sums)
    if most * most * x.shape[1] < 1 << 63:
        gap = n * x - np.array(sums, dtype=np.int64)
        return (gap * gap).sum(axis=1)
    exact = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x.tolist()]
    if max(exact) >= 1 << 63:
        raise OverflowError("a deviation beyond 64 bits")
    return np.array(exact, dtype=np.int64)


def transform(distinct: DataFrame, model: Model) -> DataFrame:
    """``(key, copies, deviation, whitened)`` of every distinct vector."""
    mean, scaled, n, sums = model.mean, model.axes / np.sqrt(model.variances), model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("copies"), pa.array(_deviation(x, n, sums)),
                     lists((x - mean) @ scaled, pa.float64())], ["key", "copies", "deviation", "whitened"])

    return distinct.select("key", "copies", "x").mapInArrow(
        run, "key binary, copies long, deviation long, whitened array<double>")


def identity_error(white: DataFrame, model: Model, weight: str = "one") -> float:
    """Largest departure of the whitened fit list's covariance from the identity."""
    def sums(batch: pa.RecordBatch) -> np.ndarray:
        return _weights(batch, weight) @ matrix(batch.column("whitened"), np.float64)

    mean = _added(white, sums, ["whitened", "copies"], "double") / model.n
    return float(np.abs(_covariance(white, "whitened", mean, model.n, weight) - np.eye(len(mean))).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           weight: str = "one", scale: int = SCALE) -> DataFrame:
    """One row per valid row and component (:data:`RESULT`)."""
    spark = rows.sparkSession
    distinct = staged(distinct_vectors(rows, vec_col, scale), "whitening-distinct")
    model = fit(distinct, components, weight)
    if model is None or not len(model.variances):
        return spark.createDataFrame([], RESULT)
    white = staged(transform(distinct, model), "whitening-result")
    off = identity_error(white, model, weight)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.variances])
    own = _keyed(rows, vec_col, scale, F.col(id_col).cast("long").alias("vec_id")).select("vec_id", "key")
    return (own.join(white, "key").select("vec_id", "deviation", F.posexplode("whitened").alias("p", "whitened"))
            .select("vec_id", (F.col("p") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(shares, F.col("p")).alias("explained"),
                    F.lit(off).alias("identity_error")))
