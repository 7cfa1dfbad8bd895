"""Quality classifier: a factorisation machine (operator 8).

Features of a text: hashed words (sub-linear counts, unit length), structure
statistics and its length as metadata.  A factorisation machine adds to the
linear part all pairwise interactions through rank-8 factors; the sum-of-
squares identity ``1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)`` makes
a score linear in the number of features.

The machine is fitted on a documented, bounded sample of labelled rows
(``sample_rows``, by a hash of the id; the held-out fold is never read).
Only those rows' features reach the driver.  Scoring is one map over whole
texts.

Edge cases: a null or empty text has no words and is scored by its
statistics; of several labels of a document the smallest counts, a null label
is none; without two classes of labels every score is the share of label 1
(0.5 without labels); rows with null or repeated ids are scored each; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import held_out

SAMPLE_ROWS = 8_000
WORD_BITS, RANK, EPOCHS, BATCH, RATE, DECAY = 14, 8, 12, 128, 0.05, 1e-4
MIN_STEPS = 800                       # of gradient descent, over more epochs if need be
THRESHOLD = 0.7
_KINDS = np.full(256, 6, dtype=np.int64)      # bytes: other
for _k, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t\n\r\v\f", b".,;:!?'\"()-",
                             b"#*$%&|<>@^~=+_/\\{}[]`", range(128, 256))):
    _KINDS[list(_chars)] = _k if _k < 6 else 7
N_STATS = 17


def statistics(text: str, counts: Counter, n: int) -> list[float]:
    """Structure statistics of a whole text, all of the order of 1."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    kind = np.bincount(_KINDS[raw], minlength=8) / max(1, len(raw))
    lines = text.split("\n")
    top = counts.most_common(3)
    short = sum(c for w, c in counts.items() if len(w) <= 3)
    shout = sum(c for w, c in counts.items() if w.isupper())
    return [
        *kind, 1.0, math.log1p(n) / 8, math.log1p(len(text)) / 10,
        (len(text) / n - 1) / 6 if n else 0.0,
        len(counts) / n if n else 0.0,
        top[0][1] / n if top else 0.0,
        sum(c for _, c in top) / n if n else 0.0,
        short / n if n else 0.0,
        shout / n + (1 - len(set(lines)) / len(lines)) if n else 0.0,
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): statistics first, then hashed words."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    hashed: dict[int, float] = {}
    mask = (1 << WORD_BITS) - 1
    for w, c in counts.items():
        k = N_STATS + (zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) & mask)
        hashed[k] = hashed.get(k, 0.0) + 1.0 + math.log(c)
    stats = statistics(text, counts, len(words))
    index = np.fromiter([*range(N_STATS), *hashed], dtype=np.int32, count=N_STATS + len(hashed))
    value = np.fromiter([*stats, *hashed.values()], dtype=np.float32, count=N_STATS + len(hashed))
    tail = value[N_STATS:]
    if len(tail):
        tail /= np.sqrt(np.dot(tail, tail))
    return index, value


@dataclass
class Machine:
    prior: float                      # the score without weights
    bias: float = 0.0
    linear: np.ndarray | None = None
    factors: np.ndarray | None = None

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[index] * value[:, None]
        s = v.sum(axis=0)
        return float(self.bias + self.linear[index] @ value + 0.5 * (s @ s - (v * v).sum()))

    def score(self, text: str | None) -> float:
        if self.linear is None:
            return self.prior
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.margin(*features(text))))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], rank: int = RANK, epochs: int = EPOCHS,
          seed: int = 11) -> Machine:
    """Logistic factorisation machine by mini-batch Adagrad."""
    y = np.array([r[2] for r in rows], dtype=np.float64)
    if not len(rows) or y.min() == y.max():
        return Machine(float(y.mean()) if len(rows) else 0.5)
    size = N_STATS + (1 << WORD_BITS)
    rng = np.random.RandomState(seed)
    linear, factors = np.zeros(size), rng.normal(0, 0.02, (size, rank))
    g_lin, g_fac, bias, g_bias = np.full(size, 1e-2), np.full((size, rank), 1e-2), math.log(y.mean() / (1 - y.mean())), 1e-2
    for _ in range(max(epochs, -(-MIN_STEPS * BATCH // len(rows)))):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            part = [rows[i] for i in order[lo:lo + BATCH]]
            lens = np.array([len(p[0]) for p in part])
            starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
            ix = np.concatenate([p[0] for p in part])
            x = np.concatenate([p[1] for p in part]).astype(np.float64)
            row = np.repeat(np.arange(len(part)), lens)
            v = factors[ix] * x[:, None]
            s = np.add.reduceat(v, starts, axis=0)
            margin = (bias + np.add.reduceat(linear[ix] * x, starts)
                      + 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((v * v).sum(axis=1), starts)))
            err = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - np.array([p[2] for p in part])) / len(part)
            e = err[row] * x
            used, inverse = np.unique(ix, return_inverse=True)
            grad_l = np.bincount(inverse, e, len(used)) + DECAY * linear[used]
            each = e[:, None] * (s[row] - v)
            grad_f = np.stack([np.bincount(inverse, each[:, f], len(used)) for f in range(rank)], axis=1)
            grad_f += DECAY * factors[used]
            g_lin[used] += grad_l * grad_l
            g_fac[used] += grad_f * grad_f
            linear[used] -= RATE * grad_l / np.sqrt(g_lin[used])
            factors[used] -= RATE * grad_f / np.sqrt(g_fac[used])
            g = err.sum()
            g_bias += g * g
            bias -= RATE * g / math.sqrt(g_bias)
    return Machine(float(y.mean()), bias, linear.astype(np.float32), factors.astype(np.float32))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([g[0].tobytes() for g in got], pa.binary()),
             pa.array([g[1].tobytes() for g in got], pa.binary()), batch.column("label")],
            names=["doc_id", "ix", "x", "label"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    total = known.count()
    share = min(1.0, sample_rows / max(1, total))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 20))
    sample = known.where(draw < int(share * (1 << 20)))           # about sample_rows rows: small enough to broadcast
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")
            .mapInArrow(_featurise, "doc_id long, ix binary, x binary, label int")
            .orderBy("doc_id", "ix", "x").collect())
    return train([(np.frombuffer(r.ix, np.int32), np.frombuffer(r.x, np.float32), int(r.label > 0)) for r in rows])


def _score(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: Machine = shared.value
        for batch in batches:
            scores = [machine.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(_score(spark.sparkContext.broadcast(machine), threshold),
                           "doc_id long, held_out boolean, score double, predicted int")
