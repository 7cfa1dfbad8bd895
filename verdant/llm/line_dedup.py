"""Fuzzy line dedup by MinHash (operator 9).

Lines of all documents are near-duplicates when their sets of character
6-grams (lower-cased, white-space runs as one space) have a Jaccard
similarity of 0.8 or more.  One line of each connected component stays: the
first by (doc_id, line number).

* MinHash: 60 values a line, 12 bands of 5.  A pair at similarity 0.8 meets
  in a band with probability ``1 - (1 - 0.8**5)**12`` = 0.9916, at 0.9 with
  0.9998.
* A line goes by a 63-bit hash of its normalised text, so equal lines of all tasks are
  one member of the join from the start; a task sends a line's bands once.  A further
  32-bit mark is compared where a row takes its line's component, so a row is only
  removed for a text equal in 95 bits.
* Band keys are dealt in lists, one a bucket and task, not row by row; those that
  come under one line only in their bucket end there.  A list has 32 bits of each key,
  its bucket comes from the others: keys of a bucket that agree in them give candidates
  more, never links.
* Of equal lines one, at its place in a document, is fetched and compared for all.
* What the join moves and verifies is the line itself; its shingles are cut
  where two lines meet.
* :mod:`verdant.llm.setjoin` verifies candidates by the exact Jaccard of the
  shingle sets and :mod:`verdant.llm.graph` joins them to components.

* Short lines (footers, menus, headings), which repeat most, are lines like others.

Guard: ``min_chars`` (0 by default, which guards no line that holds a word) keeps
shorter lines (code points, trimmed).  Blank lines always stay.  Lines are split
at ``\\n``.

Edge cases: null text has no lines and stays null.  :func:`dedup_lines` treats each
row by its own text: rows without an id (they come last in ties) and rows that
share an id are documents like others; rows equal in id and text count as one.
:func:`duplicate_lines` names lines by ``doc_id``: rows without one are left out,
and a line number is reported once for rows that share an id.  Lines repeated
within a document count as copies.  Ties go to the smaller (doc_id, line).
Further columns pass through, whatever their names.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import id_filter, in_filter, mix64, packed, pieces, scratch, staged
from verdant.llm.setjoin import resolve

NUM, DEN = 80, 100
GRAM, BANDS, ROWS = 6, 12, 5
_STEP = 1 << 16                     # characters hashed at once
_SEEN = 1 << 20                     # lines a task remembers
_DEALT = 1 << 19                    # band keys that a task deals out at once, and of a partition's buckets, about
_BUCKETS = 4                        # buckets of a partition
_MOST = 1 << 22                     # band keys of a bucket that are sorted at once

_C = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0x9E3779B97F4A7C15 ** 2 & (1 << 64) - 1)

_rng = np.random.RandomState(20240229)
_MUL = (_rng.randint(0, 1 << 31, BANDS * ROWS).astype(np.uint32) << np.uint32(1)) | np.uint32(1)


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def gram_hashes(lines: list[str], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """uint64 hashes of all character n-grams of normalised lines, and where
    each line's hashes start; a line shorter than ``gram`` counts as padded to
    one gram with line feeds, which no line holds (``gram`` is even)."""
    padded = [x if len(x) >= gram else x + "\n" * (gram - len(x)) for x in lines]
    size = np.array([len(x) for x in padded], dtype=np.int64)
    code = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    # the polynomial of a gram in Horner's form, two characters at a time
    two = code[:-1] * _C
    two += code[1:]
    h = two[:len(code) - gram + 1].copy()
    for k in range(2, gram, 2):
        h *= _C2
        h += two[k:len(code) - gram + 1 + k]
    inside = np.ones(len(code), dtype=bool)
    ends = np.cumsum(size)
    for k in range(1, gram):
        inside[ends - k] = False
    starts = np.concatenate([[0], np.cumsum(size - gram + 1)[:-1]])
    return mix64(h[inside[:len(h)]]), starts


def band_keys(lines: list[str]) -> np.ndarray:
    """``len(lines) x BANDS`` int64 band keys of the lines' MinHash signatures."""
    full, starts = gram_hashes(lines)
    h = (full >> np.uint64(32)).astype(np.uint32)
    least = np.empty((BANDS * ROWS, len(lines)), dtype=np.uint32)
    x = np.empty_like(h)
    for k in range(BANDS * ROWS):
        np.multiply(h, _MUL[k], out=x)
        np.minimum.reduceat(x, starts, out=least[k])
    least = least.reshape(BANDS, ROWS, len(lines))
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], len(lines), axis=1)
    for k in range(ROWS):
        keys = mix64(keys * _C + least[:, k])
    return np.ascontiguousarray(keys.T).view(np.int64)


def _lines(batch: pa.RecordBatch, min_chars: int):
    for doc_id, rank, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "rank", "text"))):
        if text:
            for no, line in enumerate(text.split("\n")):
                if len(line) >= min_chars and len(line.strip()) >= max(min_chars, 1):
                    yield doc_id, rank, no, line


def _name(payload: bytes) -> tuple[int, int]:
    """The id (63 bits, not negative) and the mark (32 bits) of a normalised line."""
    name, mark = struct.unpack("<qi", xxhash.xxh3_128_digest(payload)[:12])
    return name & (1 << 63) - 1, mark


_HEADS = "id long, mark int, doc_id long, rank long, line_no int, keys binary"


def _heads(min_chars: int):
    """One row a line: its id and mark and, in the first row of the same line in this
    task, its band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int]] = {}
        for batch in batches:
            names, marks, docs, ranks, nos, keys, fresh, fresh_at, size = [], [], [], [], [], [], [], [], 0

            def sign():
                for row, key in zip(fresh_at, band_keys(fresh) if fresh else ()):
                    keys[row] = key.tobytes()
                fresh.clear()
                fresh_at.clear()

            for doc_id, rank, no, line in _lines(batch, min_chars):
                digest = xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))
                found = seen.get(digest)
                if found is None:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    x = normal(line)
                    found = seen[digest] = _name(x.encode("utf-8", "surrogatepass"))
                    fresh.append(x)
                    fresh_at.append(len(names))
                    size += len(x)
                names.append(found[0])
                marks.append(found[1])
                docs.append(doc_id)
                ranks.append(rank)
                nos.append(no)
                keys.append(None)
                if size > _STEP:
                    sign()
                    size = 0
            sign()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(marks, pa.int32()), pa.array(docs, pa.int64()),
                 pa.array(ranks, pa.int64()), pa.array(nos, pa.int32()), pa.array(keys, pa.binary())],
                names=["id", "mark", "doc_id", "rank", "line_no", "keys"])
    return run


_LISTS = "bucket int, keys binary, ids binary"


def _deal(buckets: int):
    """The rows ``(id, keys)`` of a task as lists: the keys of a bucket and their ids."""
    def lists(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        bucket = ((keys.view(np.uint64) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keys, ids, bucket = keys[order].astype(np.uint32), ids[order], bucket[order]
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1), len(bucket)]
        rows = [(bucket[lo], keys[lo:hi].tobytes(), ids[lo:hi].tobytes()) for lo, hi in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                                          names=["bucket", "keys", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.int64)
            held.append((keys, np.repeat(batch.column("id").to_numpy(), BANDS)))
            size += len(keys)
            if size > _DEALT:
                yield lists(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield lists(*map(np.concatenate, zip(*held)))
    return run


def _met(batches: Iterator[pa.RecordBatch], distinct: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, id)`` of the keys that come twice or more in their bucket (rows come by
    bucket), with ``distinct`` under several ids and each once; what is beyond :data:`_MOST`
    keys of a bucket, and these, go on as they are."""
    def rows(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], names=["key", "id"])

    def twice(held: list) -> pa.RecordBatch:
        keys, ids = map(np.concatenate, zip(*held))
        order = np.argsort(keys)
        if distinct:                        # of the keys that come again only: few of them all
            near = keys[order]
            near = np.concatenate([[False], near[1:] == near[:-1], [False]])
            order = order[near[1:] | near[:-1]]
            order = order[np.lexsort((ids[order], keys[order]))]
            again = (keys[order][1:] == keys[order][:-1]) & (ids[order][1:] == ids[order][:-1])
            order = order[np.concatenate([[True], ~again])] if len(order) else order
        keys = keys[order]
        same = np.concatenate([[False], keys[1:] == keys[:-1], [False]])
        mark = same[1:] | same[:-1]
        return rows(keys[mark], ids[order[mark]])

    now, held, size = None, [], 0
    for batch in batches:
        for bucket, keys, ids in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "ids"))):
            if bucket != now:
                if held:
                    yield twice(held)
                now, held, size = bucket, [], 0
            held.append((np.frombuffer(keys, np.uint32).astype(np.int64) | bucket << 32, np.frombuffer(ids, np.int64)))
            size += len(held[-1][0])
            if size > _MOST:
                for part in held:
                    yield rows(*part)
                held = []
    if held:
        yield twice(held)


def grams(payloads: Iterable[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct gram hashes of each normalised line; lines are cut some at a time."""
    def cut(lines: list[str]) -> Iterator[np.ndarray]:
        h, starts = gram_hashes(lines)
        for x in np.split(h.view(np.int64), starts[1:]):
            x.sort()
            yield x[np.concatenate([[True], x[1:] != x[:-1]])]

    lines, size = [], 0
    for p in payloads:
        lines.append(p.decode("utf-8", "surrogatepass"))
        size += len(lines[-1])
        if size > _STEP:
            yield from cut(lines)
            lines, size = [], 0
    if lines:
        yield from cut(lines)


def _spot(doc_id: int, line_no: int) -> int:
    """Place of a line for the id filter; the query writes the same in SQL."""
    return zlib.crc32(b"%d:%d" % (doc_id, line_no))


_FOUND = "id long, mark int, doc_id long, line_no int, payload binary"


def _sets(wanted, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = wanted.value
        for batch in pieces(batches):
            todo = list(_lines(batch, min_chars))
            spots = np.array([_spot(d, n) for d, _, n, _ in todo], dtype=np.int64)
            hit = np.flatnonzero(in_filter(bitmap, spots))
            payloads = [normal(todo[i][3]).encode("utf-8", "surrogatepass") for i in hit]
            names = [_name(x) for x in payloads]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in names], pa.int64()), pa.array([x for _, x in names], pa.int32()),
                 pa.array([todo[i][0] for i in hit], pa.int64()), pa.array([todo[i][2] for i in hit], pa.int32()),
                 pa.array(payloads, pa.binary())], names=["id", "mark", "doc_id", "line_no", "payload"])
    return run


def duplicate_lines(docs: DataFrame, min_chars: int = 0, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per removed line: ``doc_id, line_no, kept_doc_id, kept_line_no``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return (_duplicates(docs.withColumn("rank", F.col("doc_id")), min_chars, num, den)
            .select("doc_id", "line_no", F.col("kept.doc_id").alias("kept_doc_id"),
                    F.col("kept.line_no").alias("kept_line_no")).distinct())


def _duplicates(docs: DataFrame, min_chars: int, num: int, den: int) -> DataFrame:
    """``doc_id, rank, line_no, kept`` of every removed line of ``docs`` (doc_id, rank, text);
    the first line of a component, by (rank, doc_id, line number), is kept."""
    docs = docs.select("doc_id", "rank", "text").where("text is not null")
    with scratch(docs.sparkSession):
        return staged(_removed(docs, min_chars, num, den), "removed", keep=True)


def _removed(docs: DataFrame, min_chars: int, num: int, den: int) -> DataFrame:
    spark = docs.sparkSession
    heads = staged(docs.mapInArrow(_heads(min_chars), _HEADS), "lines")
    signed = heads.where("keys is not null").select("id", "keys")
    # equal lines of all tasks: one place and how many they are (all of one row: `first` takes them from the same)
    ones = staged(heads.groupBy("id").agg(*[F.first(c).alias(c) for c in ("mark", "doc_id", "line_no")],
                                          F.count("*").alias("copies")), "ones")
    parts = -(-BANDS * signed.count() // _DEALT) or 1
    members = (signed.mapInArrow(_deal(_BUCKETS * parts), _LISTS).repartition(parts, "bucket")
               .sortWithinPartitions("bucket").mapInArrow(partial(_met, distinct=True), "key long, id long"))

    def fetch(ids: DataFrame) -> DataFrame:
        places = staged(ones.drop("copies").join(ids.hint("shuffle_hash"), "id", "left_semi"), "places")
        spots = places.select(F.crc32(F.concat_ws(":", "doc_id", "line_no").cast("binary")).alias("spot"))
        wanted = spark.sparkContext.broadcast(id_filter(spots, "spot"))
        # rows may share an id, so the text itself has to be the one that is wanted
        return docs.mapInArrow(_sets(wanted, min_chars), _FOUND).join(places, places.columns).select("id", "payload")

    comps = resolve(members, fetch, num, den, grams)
    # lines of one row alone have no copy: linked ones and those that come again
    known = (ones.select("id", "mark", "copies").join(comps.hint("shuffle_hash"), "id", "left")
             .where("component is not null or copies > 1")
             .select("id", "mark", F.coalesce("component", "id").alias("component")))
    # the place of each line among the copies it stands for
    lines = staged(heads.drop("keys").join(known.hint("shuffle_hash"), ["id", "mark"])
                   .select("doc_id", "rank", "line_no", "component"), "copied")
    place = F.struct("rank", "doc_id", "line_no")
    groups = (lines.groupBy("component").agg(F.min(place).alias("kept"), F.max(place).alias("last"))
              .where("kept < last").select("component", "kept"))
    return (lines.join(groups, "component").where("struct(rank, doc_id, line_no) != kept")
            .select("doc_id", "rank", "line_no", "kept"))


def dedup_lines(docs: DataFrame, drop_emptied: bool = False, min_chars: int = 0, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` without its removed lines, in its own columns.

    ``n_chars``, where present, follows the text.  With ``drop_emptied``
    documents left without any word by the removal go; documents that had
    no line removed always stay.
    """
    rows = packed(docs, "doc_id", "text")
    rank = F.coalesce(F.col("doc.doc_id").cast("long"), F.lit((1 << 63) - 1))
    gone = (_duplicates(rows.select(F.col("key").alias("doc_id"), rank.alias("rank"), F.col("doc.text").alias("text")),
                        min_chars, num, den)
            .groupBy(F.col("doc_id").alias("key")).agg(F.collect_set("line_no").alias("gone")))
    out = rows.join(gone, "key", "left")
    cut = F.expr("array_join(filter(split(doc.text, '\\n', -1), (x, i) -> not array_contains(gone, i)), '\\n')")
    out = out.withColumn("left", F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(cut))
    if drop_emptied:
        out = out.where(F.col("gone").isNull() | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = None
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("gone").isNull(), F.col("doc.n_chars")).otherwise(
            F.char_length("left").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col("left").alias("text") if c == "text" else n_chars.alias(c) if c == "n_chars"
                        else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
