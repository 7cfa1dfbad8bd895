"""Helpers shared by the training-data operators.

* :func:`staged` writes an intermediate table to the shared folder named by
  ``spark.checkpoint.dir`` and reads it back: lineage is cut and a lost
  executor costs one re-read.  :func:`scratch` deletes the tables of a step
  that has its result.
* :func:`id_filter` turns a set of ids of any size into a fixed-size bitmap
  that prunes a scan before an exact join (never a replacement for it).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIRS: dict[str, str] = {}
_BLOCKS: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())      # paths staged in the open blocks
# bits of an id filter: 8 Mi bits, 1 MiB as a bitmap, at most 131,072 words collected
FILTER_BITS = 1 << 23


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables (``spark.checkpoint.dir``).

    Unset on a ``local`` master (tests): one private folder per application.
    Unset on a cluster: an error, because executors do not share local folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="verdant-llm-")
    return _LOCAL_DIRS[app]


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.  Within a
    :func:`scratch` block the table goes with the block, with ``keep`` with the block around it."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    blocks = _BLOCKS.get()[:-1] if keep else _BLOCKS.get()
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged within the block are deleted at its end.  What leaves the block may
    read kept tables only."""
    paths: list[str] = []
    outer = _BLOCKS.set(_BLOCKS.get() + (paths,))
    try:
        yield
    finally:
        _BLOCKS.reset(outer)
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, *by: str) -> DataFrame:
    """``(doc, key)``: each row of ``docs`` as a struct, so that no column of a verdict can
    clash with its columns, and a 64-bit hash of its ``by`` columns (those it has).

    Verdicts that depend on these columns alone are joined back by the key, whatever
    the ids: rows without an id have one, rows that share an id have their own, and
    rows that are equal in all of them share a verdict."""
    cols = [F.col(f"`{c}`") for c in by if c in docs.columns]
    key = F.xxhash64(*[x for c in cols for x in (c.isNull(), c)])
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("key"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_bucket(col: Column | str) -> Column:
    """crc32 of an id's decimal text, mod 4 (2 marks the held-out rows)."""
    return F.pmod(F.crc32(F.col(col) if isinstance(col, str) else col).cast("long"), F.lit(4))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold_bucket(F.col(doc_id).cast("string").cast("binary")) == 2, F.lit(False))


def id_filter(ids: DataFrame, col: str, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of ``pmod(col, bits)`` over all rows: ``bits / 64`` words at most
    reach the driver, whatever the number of ids."""
    bit = F.pmod(F.col(col), F.lit(bits))
    words = (ids.select(bit.alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set")))
    out = np.zeros(bits // 64, dtype=np.int64)
    found = words.toArrow()                        # two arrays, not a Python row for each word
    out[found.column("word").to_numpy()] = found.column("set").to_numpy()
    return out


def in_filter(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Mask of the (int64) ids whose bit is set; false positives are possible."""
    bit = np.mod(ids, bitmap.size * 64)
    return (bitmap[bit >> 6] >> (bit & 63)) & 1 == 1


def cut(values: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Consecutive pieces of ``values`` that end at ``ends``."""
    return np.split(values, ends[:-1]) if len(ends) else []


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces: what a task decodes and sends at once stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (uint64 in, uint64 out)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def bitmap_of(elements: np.ndarray, floor_bits: int = 64) -> bytes:
    """Hashed bitmap signature of a set: about 4 to 8 bits per element."""
    bits = max(floor_bits, 1 << int(max(1, 4 * len(elements)) - 1).bit_length())
    out = np.zeros(bits // 8, dtype=np.uint8)
    pos = elements.view(np.uint64) & np.uint64(bits - 1)
    np.bitwise_or.at(out, (pos >> np.uint64(3)).astype(np.int64),
                     np.left_shift(1, (pos & np.uint64(7)).astype(np.int64)).astype(np.uint8))
    return out.tobytes()
