"""Benchmark decontamination (operator 3): fuzzy passages of benchmark items.

An item leaks into a document when some passage of it is within ``k =
floor(0.2 n)`` word edits of the item's ``n`` words (lower-cased, outer
punctuation stripped).

1. Windows.  ``k`` edits leave an unedited run of at least
   ``(n - k) // (k + 1)`` words, so every passage within reach shares a word
   q-gram (q = 3 at most, less for short items) at a known place of the item:
   each such meeting fixes one item-sized window of the document.  This is
   lossless and leaves the windows worth embedding.
2. CGK embedding.  A random walk over the window copies its current word to
   each of ``3 n`` output places and steps on if the shared random bit of
   (place, word) is set.  Edit distance becomes Hamming distance.
3. Bit sampling.  Per walk, keys of sampled places; a window whose key meets
   its item's in any repetition becomes a candidate.
4. Candidates are verified by the exact edit distance of the item to the best
   passage around the window.

Items are the stated query set, broadcast in blocks of at most
``block_chars`` characters; each block is one scan of the documents.

Edge cases: null texts and items have no words and meet nothing; items under five
words allow no edit, so only their very words count (a caller whose items are so
short that they meet ordinary prose may set ``min_words``).  Items with equal
text are reported each; rows with a null id are left out; repeated rows give
repeated spans once.  Empty tables give an empty result.  Texts are read
whole and further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import mix64, packed

EDITS, MIN_WORDS = 0.2, 1
WALKS, KEYS, PLACES = 8, 32, 3
BLOCK_CHARS = 1 << 24
_MEMO = 1 << 18
_PUNCT = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "‘’“”«»…–—·¿¡"
LEAKS = "doc_id long, item_id long, start int, end int, distance int, n_words int"


class _Ids(dict):
    """Raw token -> benchmark word id; 0: not a benchmark word, -1: no word."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, raw: str) -> int:
        if len(self) >= _MEMO:
            self.clear()
        word = raw.lower().strip(_PUNCT)
        self[raw] = got = self.vocabulary.get(word, 0) if word else -1
        return got


def words_of(text: str | None) -> list[str]:
    return [x for x in (raw.lower().strip(_PUNCT) for raw in (text or "").split()) if x]


class Index:
    """Benchmark items: word ids, q-gram postings and sampled CGK keys."""

    def __init__(self, items: list[tuple[int, str]], edits: float, min_words: int):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray, int]] = []
        grams: dict[int, dict[tuple, list]] = {}
        for item_id, text in items:
            w = words_of(text)
            if len(w) < min_words:
                continue
            x = np.array([self.vocabulary.setdefault(t, len(self.vocabulary) + 1) for t in w], dtype=np.int64)
            k = int(edits * len(w))
            q = max(1, min(3, (len(w) - k) // (k + 1)))
            n = len(self.items)
            self.items.append((item_id, x, k))
            for p in range(len(x) - q + 1):
                grams.setdefault(q, {}).setdefault(tuple(x[p:p + q]), []).append((n, p))
        self.base = len(self.vocabulary) + 1
        self.grams = {}
        for q, table in grams.items():
            code = np.array([self._code(np.array(g)[:, None])[0] for g in table], dtype=np.int64)
            order = np.argsort(code)
            lists = [np.array(v, dtype=np.int64) for v in table.values()]
            self.grams[q] = (code[order], [lists[i] for i in order])
        rng = np.random.RandomState(7)
        self.seeds = rng.randint(1, 1 << 62, WALKS, dtype=np.int64).astype(np.uint64)
        self.draws = rng.random_sample((WALKS, KEYS, PLACES))
        self.keys = [self.key(x[None, :], np.array([len(x)])) for _, x, _ in self.items]

    def _code(self, cols: np.ndarray) -> np.ndarray:
        code = cols[0].astype(np.int64)
        for c in cols[1:]:
            code = code * np.int64(self.base) + c
        return code

    def embed(self, windows: np.ndarray, size: int) -> np.ndarray:
        """CGK walks: ``WALKS x rows x 3 size`` word ids (0 past the end)."""
        rows = windows.shape[0]
        padded = np.concatenate([windows, np.zeros((rows, 1), dtype=windows.dtype)], axis=1)
        out = np.zeros((WALKS, rows, 3 * size), dtype=np.int64)
        row = np.arange(rows)[None, :]
        at = np.zeros((WALKS, rows), dtype=np.int64)
        for j in range(3 * size):
            sym = padded[row, at]
            out[:, :, j] = sym
            bit = mix64(self.seeds[:, None] + np.uint64(j * 0x9E3779B97F4A7C15 % (1 << 64))
                        + sym.view(np.uint64) * np.uint64(0xD1B54A32D192ED03)) & np.uint64(1)
            at = np.minimum(at + bit.astype(np.int64), windows.shape[1])
        return out

    def key(self, windows: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``rows x WALKS*KEYS`` sampled keys of windows of one size; the
        places are drawn from the first two thirds of the walk, where it is
        still inside the window."""
        n = int(size[0])
        e = self.embed(windows, n)
        place = np.minimum((self.draws * 2 * n).astype(np.int64), 3 * n - 1)
        cols = []
        for w in range(WALKS):
            s = e[w][:, place[w]]                       # rows x KEYS x PLACES
            key = np.full(s.shape[:2], w + 1, dtype=np.uint64)
            for p in range(PLACES):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + s[:, :, p].view(np.uint64))
            cols.append(key)
        return np.concatenate(cols, axis=1)

    def windows(self, x: np.ndarray) -> set[tuple[int, int]]:
        """(item, start) of the windows that share a q-gram with the item."""
        out: set[tuple[int, int]] = set()
        for q, (codes, lists) in self.grams.items():
            if len(x) < q:
                continue
            cols = np.stack([x[k:len(x) - q + 1 + k] for k in range(q)])
            known = np.flatnonzero((cols > 0).all(axis=0))
            if not len(known):
                continue
            code = self._code(cols[:, known])
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            for i in np.flatnonzero(codes[at] == code):
                pos = int(known[i])
                for n, p in lists[at[i]]:
                    out.add((int(n), pos - int(p)))
        return out

    def candidates(self, docs: list[np.ndarray]) -> list[tuple[int, int, int]]:
        """(doc, item, start) whose sampled keys meet, for a batch of documents."""
        by_item: dict[int, list[tuple[int, int]]] = {}
        for d, x in enumerate(docs):
            for n, start in self.windows(x):
                by_item.setdefault(n, []).append((d, start))
        out = []
        for n, where in by_item.items():
            size = len(self.items[n][1])
            for lo in range(0, len(where), 4096):
                part = where[lo:lo + 4096]
                mat = np.zeros((len(part), size), dtype=np.int64)
                for r, (d, start) in enumerate(part):
                    a, b = max(0, start), min(len(docs[d]), start + size)
                    mat[r, :b - a] = docs[d][a:b]
                hit = (self.key(mat, np.array([size])) == self.keys[n]).any(axis=1)
                out += [(d, n, start) for (d, start), ok in zip(part, hit) if ok]
        return out


def best_passage(item: np.ndarray, x: np.ndarray, limit: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the passage of ``x`` nearest to ``item`` by
    word edits, leftmost among the best; None beyond ``limit``."""
    m = len(x)
    ramp = np.arange(m + 1)
    # a cell packs distance and start; rows are the item's words
    big = np.int64(m + 1)
    row = ramp.astype(np.int64)                              # distance 0, start j
    for i, w in enumerate(item, 1):
        down = row + big
        diag = np.empty(m + 1, dtype=np.int64)
        diag[0] = np.int64(i) * big
        diag[1:] = row[:-1] + big * (x != w)
        cell = np.minimum(down, diag)
        # insertions: a running minimum of cell - j * big
        row = np.minimum.accumulate(cell - ramp * big) + ramp * big
    end = int(np.argmin(row // big))
    distance, start = divmod(int(row[end]), int(big))
    return (distance, start, end) if distance <= limit else None


def _scan(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = index.value
        ids = _Ids(ix.vocabulary)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            docs, maps = [], []
            for text in texts:
                raw = np.fromiter(map(ids.__getitem__, text.split()), dtype=np.int64) if text else np.empty(0, np.int64)
                keep = raw >= 0
                maps.append(None if keep.all() else np.flatnonzero(keep))
                docs.append(raw if maps[-1] is None else raw[keep])
            found: dict[tuple[int, int], set] = {}
            for d, n, start in ix.candidates(docs):
                _, item, k = ix.items[n]
                lo, hi = max(0, start - k), min(len(docs[d]), start + len(item) + k)
                got = best_passage(item, docs[d][lo:hi], k)
                if got:
                    found.setdefault((d, n), set()).add((got[0], got[1] + lo, got[2] + lo))
            rows = []
            spots: dict[int, list] = {}
            for (d, n), spans in found.items():
                taken: list[tuple[int, int]] = []
                for distance, a, b in sorted(spans):         # best first, then leftmost
                    if a >= b or any(a < y and x < b for x, y in taken):
                        continue
                    taken.append((a, b))
                    if d not in spots:
                        spots[d] = [m.span() for m in re.finditer(r"\S+", texts[d])]
                    real = (lambda i, m=maps[d]: i) if maps[d] is None else (lambda i, m=maps[d]: int(m[i]))
                    rows.append((doc_ids[d], ix.items[n][0], spots[d][real(a)][0], spots[d][real(b - 1)][1],
                                 distance, len(ix.items[n][1])))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64()] + [pa.int32()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "item_id", "start", "end", "distance", "n_words"])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, min_words: int = MIN_WORDS,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Leaked passages: ``doc_id, item_id, start, end`` (code points), the word
    ``distance`` and the item's ``n_words``; several passages of an item in a
    document are reported each unless they overlap."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "item_id is not null and text is not null").distinct()
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_chars))
    out = None
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        index = Index([(r.item_id, r.text) for r in block.orderBy("item_id", "text").collect()], edits, min_words)
        if not index.items:
            continue
        part = docs.mapInArrow(_scan(spark.sparkContext.broadcast(index)), LEAKS)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], LEAKS) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a leaked passage, each judged by its own
    text, whatever its id; in their own columns, whatever their names."""
    rows = packed(docs, "doc_id", "text")
    leaks = find_leaks(rows.select(F.col("key").alias("doc_id"), F.col("doc.text").alias("text")), benchmark, **options)
    return rows.join(leaks.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").select("doc.*")
