"""N-gram Jaccard self-join of documents, as components (operator 2).

A document's set holds the 64-bit hashes of its distinct word 4-grams (A-Z
lowered, words split at ASCII white space); a shorter document has its whole
word sequence as one element, a document without words the empty set.  Two
documents link when ``100 |A & B| >= 85 |A | B|``.

* Equal sets collapse first: a group of copies of any size is one
  representative (``min`` by digest, combined map-side).
* Candidates share one of the rarest elements of both sets: for a Jaccard of
  t, the ``n - ceil(t n) + 1`` first elements in any global order must meet.
  The order is (estimated count, hash); the counts come from one fixed-size
  count sketch over all documents, so elements of passages that many
  documents share come last and rarely enter a prefix.  The sketch only
  orders, so its errors cost time, never links.
* Prefixes are half as long again.  A linked pair shares not one but
  :func:`needed` elements of these, so a document with fewer elements that any
  other document's prefix holds has no partner and leaves all lists: a
  passage that many documents share does not bring them together.
* The lists of a shared element are cut into size bands (documents whose
  sizes differ by more than the threshold never meet): a document stands in
  the tile of its own band and of the band below.
* :mod:`verdant.llm.setjoin` compares within tiles: hashed bitmaps bound the
  overlap from above, then sorted arrays are intersected.

Edge cases: null or blank text: empty set, linked with nothing, its own
component.  Rows with a null ``doc_id`` are left out (there is no id to
report); a repeated ``doc_id`` takes the smallest set digest.  Empty tables
give an empty result; further columns are ignored.  Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import id_filter, in_filter, mix64, packed, pieces, scratch, staged
from verdant.llm.setjoin import SETS, resolve

NUM, DEN, WORDS = 85, 100, 4
SKETCH_BITS = 20                     # counters of the ordering sketch (4 MiB)
_CHUNK = 1 << 14


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct uint64 hashes of the word n-grams of a whole text."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter(map(digest, w), dtype=np.uint64, count=len(w))
    size = min(words, len(w))
    g = h[:len(h) - size + 1]
    for k in range(1, size):
        g = mix64(g) + h[k:len(h) - size + 1 + k]
    return np.unique(mix64(g + np.uint64(size)))


def _texts(batch: pa.RecordBatch):
    return zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())


def _sketch(bits: int, words: int):
    """Each task adds up all its documents' elements, then sends the counters in chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            held, size = [], 0
            for _, text in _texts(batch):
                held.append(shingles(text, words) >> np.uint64(64 - bits))
                size += len(held[-1])
                if size > 1 << 20:
                    total += np.bincount(np.concatenate(held).astype(np.int64), minlength=1 << bits)
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held).astype(np.int64), minlength=1 << bits)
        for k in range(0, 1 << bits, _CHUNK):
            part = total[k:k + _CHUNK]
            if part.any():
                part = np.minimum(part, np.iinfo(np.uint32).max).astype("<u4")
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([k], pa.int64()), "counts": pa.array([part.tobytes()], pa.binary())})
    return run


def _add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            x = np.frombuffer(counts, "<u4").astype(np.int64)
            out[chunk] = out[chunk] + x if chunk in out else x
    for chunk, x in out.items():
        x = np.minimum(x, np.iinfo(np.uint32).max).astype("<u4")
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()),
                                          "counts": pa.array([x.tobytes()], pa.binary())})


def order_sketch(docs: DataFrame, bits: int = SKETCH_BITS, words: int = WORDS) -> np.ndarray:
    """Element counts over all documents, hashed to ``2**bits`` counters."""
    parts = docs.mapInArrow(_sketch(bits, words), "chunk long, counts binary")
    sums = parts.repartition("chunk").mapInArrow(_add_chunks, "chunk long, counts binary")
    total = np.zeros(1 << bits, dtype=np.uint32)
    for r in sums.collect():                       # the whole sketch: 4 * 2**bits bytes at any input size
        total[r.chunk:r.chunk + _CHUNK] = np.frombuffer(r.counts, "<u4")
    return total


_HEADS = "doc_id long, n long, digest binary, prefix array<long>"


def core(n: int, num: int, den: int) -> int:
    """Elements of which a linked pair shares one: ``n - ceil(t n) + 1``."""
    return n - -(-num * n // den) + 1


def extra(n: int, num: int, den: int) -> int:
    """Further elements of a prefix."""
    return -(-core(n, num, den) // 2)


def needed(n: int, num: int, den: int) -> int:
    """Prefix elements that a set of ``n`` shares with any linked one: the
    first ``k + 1`` common elements stand in both prefixes, ``k`` the fewer of
    their further elements; the least is that of the smallest partner."""
    least = -(-num * n // den)
    return min(extra(least, num, den) + 1, -(-num * least // den))


def _heads(sketch, bits: int, words: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in pieces(batches):
            ids, ns, digests, prefixes = [], [], [], []
            for doc_id, text in _texts(batch):
                s = shingles(text, words)
                n = len(s)
                k = core(n, num, den) + extra(n, num, den) if n else 0
                rank = counts[(s >> np.uint64(64 - bits)).astype(np.int64)]
                first = s[np.lexsort((s, rank))[:k]]           # also a whole set: its first places are the rarest
                ids.append(doc_id)
                ns.append(n)
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                prefixes.append(first.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64()))], names=["doc_id", "n", "digest", "prefix"])
    return run


def _sets(wanted, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = wanted.value
        for batch in pieces(batches):
            batch = batch.filter(pa.array(in_filter(bitmap, batch.column("doc_id").to_numpy())))
            ids, payloads, digests = [], [], []
            for doc_id, text in _texts(batch):
                u = shingles(text, words)
                ids.append(doc_id)
                payloads.append(np.sort(u.view(np.int64)).tobytes())
                digests.append(xxhash.xxh3_128_digest(u.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(payloads, pa.binary()), pa.array(digests, pa.binary())],
                names=["id", "payload", "digest"])
    return run


def jaccard_components(docs: DataFrame, num: int = NUM, den: int = DEN, words: int = WORDS,
                       sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """``doc_id, n_shingles, component_id, set_id`` for every document.

    ``set_id`` is the smallest document with the same set (the exact class);
    ``component_id`` the smallest document reachable by links, itself
    included.  Documents with the empty set stand alone.
    """
    with scratch(docs.sparkSession):
        return staged(_classes(docs, num, den, words, sketch_bits), "classes", keep=True)


def _classes(docs: DataFrame, num: int, den: int, words: int, sketch_bits: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    sketch = spark.sparkContext.broadcast(order_sketch(docs, sketch_bits, words))
    heads = staged(docs.mapInArrow(_heads(sketch, sketch_bits, words, num, den), _HEADS), "heads")

    # one row a document (a repeated id takes its smallest digest), one representative a set
    base = heads.groupBy("doc_id").agg(F.min(F.struct("digest", "n")).alias("s")).select(
        "doc_id", F.col("s.digest").alias("digest"), F.col("s.n").alias("n"))
    reps = base.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("set_id"))
    base = staged(base.join(reps, "digest", "left")
                  .select("doc_id", "n", "digest", F.coalesce("set_id", "doc_id").alias("set_id")), "sets")

    own = base.where("n > 0 and doc_id = set_id").select("doc_id", "digest")
    # the bounds of core() and needed() as expressions, in whole numbers
    up = "((({num}) * {n} + {den} - 1) div {den})"
    least = up.format(num=num, den=den, n="n")
    least2 = up.format(num=num, den=den, n=least)
    need = f"least((({least} - {least2} + 1) + 1) div 2 + 1, {least2})"
    # sizes of a linked pair differ by the threshold at most: same or neighbouring band
    # (a thousandth wider, so that rounding cannot part a pair at the very threshold)
    band = F.floor(F.log("n") / float(np.log(den / num) * 1.001))
    docs_of = heads.join(own, ["doc_id", "digest"], "left_semi")
    # what is shuffled by element is no more than element, document and whether it is in the core
    posts = docs_of.select("doc_id", F.posexplode("prefix").alias("place", "element"), F.expr(f"n - {least} + 1").alias("core"))
    posts = posts.select("doc_id", "element", F.expr("place < core").alias("core"))
    twice = posts.groupBy("element").agg(F.count("*").alias("c")).where("c > 1").select("element")
    met = staged(posts.join(twice, "element"), "met")
    sizes = base.where("n > 0 and doc_id = set_id").select("doc_id", band.alias("band"), F.expr(need).alias("need"))
    open_docs = (met.groupBy("doc_id").agg(F.count("*").alias("c")).join(sizes, "doc_id").where("c >= need")
                 .select("doc_id", "band"))
    members = met.where("core").select("doc_id", "element").join(open_docs, "doc_id").select(
        "element", F.col("doc_id").alias("id"), F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band")).select(
        F.xxhash64("element", "band").alias("key"), "id")

    def fetch(ids: DataFrame) -> DataFrame:
        # the sets that the kept digests stand for (a repeated id may have others)
        ids = staged(ids.join(own.withColumnRenamed("doc_id", "id"), "id"), "ids")
        wanted = spark.sparkContext.broadcast(id_filter(ids, "id"))
        rows = docs.mapInArrow(_sets(wanted, words), SETS + ", digest binary")
        return rows.join(ids, ["id", "digest"], "left_semi").drop("digest")

    comps = resolve(members, fetch, num, den)
    return (base.join(comps.withColumnRenamed("id", "set_id"), "set_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "set_id").alias("component_id"), "set_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component: its smallest id (null ids last).

    Each row is compared by its own text, whatever its id; rows equal in id and
    text are one document and stay or go together."""
    rows = packed(docs, "doc_id", "text")
    with scratch(docs.sparkSession):
        comps = jaccard_components(rows.select(F.col("key").alias("doc_id"), F.col("doc.text").alias("text")), **options)
        ids = rows.select("key", F.coalesce(F.col("doc.doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("rank")).distinct()
        ranked = staged(comps.select(F.col("doc_id").alias("key"), F.col("component_id").alias("comp")).join(ids, "key"), "ranked")
        least = staged(ranked.groupBy("comp").agg(F.min(F.struct("rank", "key")).alias("one")).select(F.col("one.key").alias("key")),
                       "least", keep=True)
    return rows.join(least, "key", "left_semi").select("doc.*")
