"""Packing by cutting-stock column generation (operator 10).

A document's token ids (its text, then the end id 1) are cut into pieces of
the full 2048 and one remainder, so a document of up to 2048 tokens stays
whole.  How the pieces share sequences is a cutting-stock problem over the
histogram of their lengths, rounded up to classes of 4 tokens:

* the histogram (512 counts at most, from all documents) is all the driver
  sees;
* a linear program picks how often to use each pattern (a multiset of
  classes that fits 2048); new patterns are priced by an unbounded-knapsack
  dynamic program over the duals, until no pattern improves the program by
  more than 0.1 %;
* the rounded-down pattern counts cover all pieces but a bounded rest, which
  greedy patterns take;
* pieces are ranked within their class (by hashed sub-buckets, so that a class
  with a third of all pieces is spread) and a rank is looked up in the
  patterns' intervals.

Edge cases: a null or empty text is the end id alone; rows with a null or
repeated ``doc_id`` are packed each; an empty table gives an empty result;
ties between equal pieces are broken by (doc_id, start, checksum) and equal
rows are interchangeable.  Texts are read whole; only ``doc_id`` and
``text`` are read.  ``tiktoken`` raises on a text with a white-space run of
some 700,000 characters and more; exactly these texts are encoded by
``tokenizers`` from the vocabulary's JSON file, which gives the same ids.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import staged

CAPACITY, UNIT, END_ID = 2048, 4, 1
SUB_BUCKETS = 1024
SPECIAL = {"<|endoftext|>": 50256}
# fixed value: the split pattern that belongs to the vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """The byte-level BPE of a rank file, once a process."""
    if path not in _ENCODERS:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _ENCODERS[path]


def plain_encoder(path: str):
    """The same BPE by ``tokenizers``, from the JSON file beside the rank file."""
    path = path.removesuffix(".tiktoken") + ".json"
    if path not in _ENCODERS:
        from tokenizers import Tokenizer
        _ENCODERS[path] = Tokenizer.from_file(path)
    return _ENCODERS[path]


def token_ids(text: str | None, path: str) -> np.ndarray:
    """The ids of a text and the end id; the special token's string is its id."""
    try:
        ids = encoder(path).encode(text, allowed_special="all", disallowed_special=()) if text else []
    except ValueError:                   # the split pattern's stack ends on a long white-space run
        ids = plain_encoder(path).encode(text, add_special_tokens=False).ids
    ids.append(END_ID)
    return np.array(ids, dtype="<u4")


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, cls int"


def _cut(path: str, capacity: int, unit: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = token_ids(text, path)
                for start in range(0, len(ids), capacity):
                    part = ids[start:start + capacity]
                    row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids), -(-len(part) // unit), part)
                    for c, v in zip(cols, row):
                        c.append(v)
            kinds = [pa.int64()] * 5 + [pa.int32()]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "cls"]
            if with_ids:
                arrays.append(pa.array([p.astype(np.int32) for p in cols[6]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def _best_pattern(size: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of ``size`` within ``capacity``."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1, dtype=np.int64)
    upto = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        n = upto[c]
        if n:
            v = best[c - size[:n]] + value[:n]
            k = int(np.argmax(v))
            if v[k] > best[c]:
                best[c], pick[c] = v[k], k
        if best[c - 1] >= best[c]:
            best[c], pick[c] = best[c - 1], -1
    pattern, c = np.zeros(len(size), dtype=np.int64), capacity
    while c > 0:
        k = pick[c]
        if k < 0:
            c -= 1
        else:
            pattern[k] += 1
            c -= size[k]
    return float(best[capacity]), pattern


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots, a rank-one update a column (some hundred
    rows; no threaded library calls in the driver)."""
    m = len(matrix)
    a = np.concatenate([matrix.astype(np.float64), np.eye(m)], axis=1)
    for k in range(m):
        p = k + int(np.argmax(np.abs(a[k:, k])))
        if p != k:
            a[[k, p]] = a[[p, k]]
        a[k] /= a[k, k]
        rows = np.flatnonzero(a[:, k])
        rows = rows[rows != k]
        a[rows] -= a[rows, k][:, None] * a[k]
    return a[:, m:].copy()


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", matrix, vector)


def _greedy_basis(size: np.ndarray, need: np.ndarray, capacity: int) -> np.ndarray:
    """First basis: fill largest first, as often as the demand (in fractions)
    lasts.  Each pattern ends one class's demand and later ones do not hold
    that class, so the matrix is triangular up to order."""
    m, left = len(size), need.copy()
    basis = np.diag(capacity // size).astype(np.float64)         # column k ends class k
    while (left > 0).any():
        pattern, room = np.zeros(m, dtype=np.int64), capacity
        for k in np.flatnonzero(left > 0)[::-1]:
            pattern[k] = room // size[k]
            room -= pattern[k] * size[k]
        on = np.flatnonzero(pattern)
        times = left[on] / pattern[on]
        end = on[int(np.argmin(times))]
        left[on] -= times.min() * pattern[on]
        left[end] = 0
        left[left < 1e-9] = 0
        basis[:, end] = pattern
    return basis


def solve(demand: dict[int, int], capacity: int, tolerance: float = 1e-3,
          max_rounds: int = 3_000) -> list[tuple[dict[int, int], int]]:
    """Patterns ``({class: pieces}, times)`` that use every piece of ``demand``
    exactly once; classes and capacity in units.

    Column generation with smoothed prices (half the duals, half each class's
    share of the capacity); it ends when the program is within ``tolerance``
    of the lower bound that the prices prove, or after ``max_rounds``."""
    size = np.array(sorted(k for k, d in demand.items() if d > 0), dtype=np.int64)
    if not len(size):
        return []
    need = np.array([demand[int(k)] for k in size], dtype=np.float64)
    m = len(size)
    share = size / capacity
    basis = _greedy_basis(size, need, capacity)
    inverse = _inverse(basis)
    x = np.maximum(_times(inverse, need), 0)
    bound = float((share * need).sum())                                  # no sequence holds more than the capacity
    for i in range(max_rounds):
        if x.sum() <= (1 + tolerance) * bound:
            break
        if i % 200 == 199:                                       # against rounding
            inverse = _inverse(basis)
            x = np.maximum(_times(inverse, need), 0)
        duals = inverse.sum(axis=0)                              # every pattern costs one sequence
        for price in ((np.maximum(duals, 0) + share) / 2, np.maximum(duals, 0)):
            value, pattern = _best_pattern(size, price, capacity)
            bound = max(bound, float((price * need).sum()) / value)
            if float((duals * pattern).sum()) > 1 + 1e-7:
                break
        else:
            break                                                # no pattern improves the program
        enter = _times(inverse, pattern)
        ratio = np.where(enter > 1e-9, x / np.where(enter > 1e-9, enter, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        step = ratio[out]
        x = np.maximum(x - step * enter, 0)
        x[out] = step
        row = inverse[out] / enter[out]
        inverse -= np.outer(enter, row)
        inverse[out] = row
        basis[:, out] = pattern
    basis = basis.astype(np.int64)
    left = need.astype(np.int64)
    out_patterns: list[tuple[dict[int, int], int]] = []

    def use(pattern: np.ndarray, times: int) -> None:
        if times > 0:
            left[:] -= pattern * times
            out_patterns.append(({int(size[k]): int(pattern[k]) for k in np.flatnonzero(pattern)}, int(times)))

    for p in np.argsort(-x, kind="stable"):
        pattern = basis[:, p]
        on = pattern > 0
        use(pattern, min(int(x[p] + 1e-6), int((left[on] // pattern[on]).min())))
    while left.any():                                            # the bounded rest: largest first
        pattern, room = np.zeros(m, dtype=np.int64), capacity
        for k in range(m - 1, -1, -1):
            pattern[k] = min(left[k], room // size[k])
            room -= pattern[k] * size[k]
        on = pattern > 0
        use(pattern, int((left[on] // pattern[on]).min()))
    return out_patterns


def intervals(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(cls, lo, hi, base, per, slot)``: ranks lo..hi-1 of a class go to the
    sequences from ``base`` on, ``per`` each, at the places from ``slot`` on."""
    used: dict[int, int] = {}
    base, out = 0, []
    for pattern, times in patterns:
        slot = 0
        for cls in sorted(pattern, reverse=True):
            per, lo = pattern[cls], used.get(cls, 0)
            out.append((cls, lo, lo + per * times, base, per, slot))
            used[cls] = lo + per * times
            slot += per
        base += times
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, unit: int = UNIT,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` (and ``ids`` with ``with_ids``).

    ``tokenizer_path`` is a rank file that every executor has, with its JSON
    file beside it (vocabularies are installed, not shipped); ``capacity`` is a
    multiple of ``unit``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = PIECES + (", ids array<int>" if with_ids else "")
    pieces = staged(docs.mapInArrow(_cut(tokenizer_path, capacity, unit, with_ids), schema), "pieces")
    hist = {r.cls: r["count"] for r in pieces.groupBy("cls").count().collect()}     # capacity / unit rows at most
    table = spark.createDataFrame(
        intervals(solve(hist, capacity // unit)),
        "cls int, lo long, hi long, base long, per long, slot long").withColumnRenamed("cls", "__cls")

    # rank within the class: a running count over hashed sub-buckets, then within one
    pieces = pieces.withColumn("sub", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SUB_BUCKETS)).cast("int"))
    before = (pieces.groupBy("cls", "sub").agg(F.count("*").alias("c"))
              .withColumn("before", F.sum("c").over(Window.partitionBy("cls").orderBy("sub")) - F.col("c")).drop("c"))
    order = Window.partitionBy("cls", "sub").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (pieces.withColumn("r", F.row_number().over(order) - 1)
              .join(before, ["cls", "sub"]).withColumn("rank", F.col("r") + F.col("before")))
    # the intervals of some hundred patterns: bounded by capacity / unit, not by the corpus
    at = ranked.join(F.broadcast(table), (F.col("cls") == F.col("__cls")) & (F.col("rank") >= F.col("lo"))
                     & (F.col("rank") < F.col("hi")))
    k = F.col("rank") - F.col("lo")
    at = at.withColumn("sequence_id", (F.col("base") + F.floor(k / F.col("per"))).cast("long")).withColumn(
        "place", F.col("slot") + F.pmod(k, F.col("per")))
    run = Window.partitionBy("sequence_id").orderBy("place")
    out = at.withColumn("offset", (F.sum("length").over(run) - F.col("length")).cast("long"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                      *(["ids"] if with_ids else []))
