"""Language identification by word-first backoff (operator 7).

Per language, the corpus gives log frequencies of words and of character
n-grams (4 down to 1, with word boundaries).  A known word is scored by its
own log frequency; an unseen word by the mean over its longest n-grams of
which at least half are known, falling back to shorter ones.  A document's
score for a language is the sum over all its words.

The tables are fitted on a documented, bounded sample: ``sample_docs``
training documents a language, chosen by a hash of the id, and the
``max_words`` / ``max_grams`` most frequent entries.  Counting is a Spark
aggregation; the bounded tables are broadcast.  Prediction is one map over
whole texts and reads nothing but the text.

Edge cases: a text that is null or has no letter is ``und`` with score 0, as
is everything when nothing can be learned; ties go to the language first in
sorted order; rows with null or repeated ids are predicted each; an empty
table gives an empty result; clashing extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import held_out, mix64, staged

SAMPLE_DOCS, MAX_WORDS, MAX_GRAMS = 2_000, 40_000, 60_000
GRAM_SIZES = (4, 3, 2, 1)
EVIDENCE = 10.0                       # words that a score's confidence stands for
_MEMO_ROWS = 1 << 18                  # words a task remembers
_CHUNK_CHARS = 1 << 21                # text whose new words are scored together
_OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalpha()) + "‘’“”«»…–—·¿¡"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    languages: list[str]
    words: dict[str, int]             # word -> row of ``word_logs``
    word_logs: np.ndarray
    grams: dict[str, int]             # n-gram -> row of ``gram_logs``
    gram_logs: np.ndarray


def _logs(rows: list, n_langs: int) -> tuple[dict[str, int], np.ndarray]:
    """Smoothed log frequencies; n-grams of one length share their total."""
    index = {r.item: i for i, r in enumerate(rows)}
    counts = np.array([r.counts for r in rows], dtype=np.float64).reshape(len(rows), n_langs)
    kind = np.array([r.kind for r in rows], dtype=np.int64)
    out = np.zeros_like(counts)
    for k in np.unique(kind):
        at = kind == k
        c = counts[at] + 0.5
        out[at] = np.log(c) - np.log(c.sum(axis=0))
    return index, out.astype(np.float32)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, max_words: int = MAX_WORDS,
        max_grams: int = MAX_GRAMS) -> Model:
    """Fit on the non-held-out rows of ``docs`` with a language and a text."""
    train = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sizes = {r.lang: r["count"] for r in train.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], {}, np.zeros((0, 0), np.float32), {}, np.zeros((0, 0), np.float32))
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / sizes[lang]))).otherwise(share)
    sample = train.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < share * (1 << 20))
    words = (sample.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+", -1)).alias("item"))
             .where("item != ''").groupBy("lang", "item").count())
    words = staged(words, "language-words")
    per_lang = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("count"))), F.lit(0)) for x in langs]

    def top(table: DataFrame, keys: list[str], most: int) -> list:
        return (table.groupBy(*keys).agg(F.array(*per_lang).alias("counts"), F.sum("count").alias("n"))
                .orderBy(F.desc("n"), *keys).limit(most).collect())

    got = top(words.withColumn("kind", F.lit(0)), ["kind", "item"], max_words)
    marked = F.concat(F.lit(" "), F.col("item"), F.lit(" "))
    grams = []
    for n in GRAM_SIZES:
        cut = words.select("lang", "count", F.lit(n).alias("kind"), marked.alias("w"))
        cut = cut.where(F.char_length("w") >= n).select("lang", "count", "kind", F.explode(F.expr(
            f"transform(sequence(1, char_length(w) - {n - 1}), i -> substring(w, i, {n}))")).alias("item"))
        grams += top(cut.where("trim(item) != ''"), ["kind", "item"], max_grams // len(GRAM_SIZES))
    word_index, word_logs = _logs(got, len(langs))
    gram_index, gram_logs = _logs(grams, len(langs))
    return Model(langs, word_index, word_logs, gram_index, gram_logs)


def gram_codes(marked: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all n-grams of the strings, one after the other, and their
    number in each string."""
    length = np.array([len(x) for x in marked], dtype=np.int64)
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = np.maximum(length - size + 1, 0)
    if not n.sum():
        return np.zeros(0, dtype=np.uint64), n
    h = np.full(len(code) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + code[k:len(code) - size + 1 + k])
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return h[at], n


class Scorer:
    """Log frequencies of raw tokens, kept while they recur.

    Tokens a batch brings for the first time are scored together: known words by
    their row; of the others all n-grams of one length are looked up at once, and
    only words with too few known ones go on to the next shorter length."""

    def __init__(self, model: Model):
        self.model = model
        codes = {n: [(int(gram_codes([g], n)[0][0]), r) for g, r in model.grams.items() if len(g) == n] for n in GRAM_SIZES}
        self.grams = {}
        for n, pairs in codes.items():
            pairs.sort()
            self.grams[n] = (np.array([c for c, _ in pairs], dtype=np.uint64), np.array([r for _, r in pairs], dtype=np.int64))
        self.reset()

    def reset(self) -> None:
        self.row: dict[str, int] = {}
        self.logs = np.zeros((1, len(self.model.languages)), dtype=np.float32)    # row 0: not a word
        self.more: list[np.ndarray] = []
        self.used = 1

    def learn(self, tokens) -> None:
        """Score the tokens that are not known yet."""
        fresh, unseen = [], []
        for raw in tokens:
            word = raw.lower().strip(_OUTER)
            if word and _LETTER.search(word):
                self.row[raw] = self.used + len(fresh)
                known = self.model.words.get(word)
                fresh.append(-1 if known is None else known)
                if known is None:
                    unseen.append(word)
            else:
                self.row[raw] = 0
        if not fresh:
            return
        known = np.array(fresh, dtype=np.int64)
        logs = np.zeros((len(fresh), len(self.model.languages)), dtype=np.float32)
        logs[known >= 0] = self.model.word_logs[known[known >= 0]]
        logs[known < 0] = self.back_off(unseen)
        self.more.append(logs)
        self.used += len(fresh)

    def back_off(self, words: list[str]) -> np.ndarray:
        """Means over each word's longest n-grams of which half are known."""
        out = np.zeros((len(words), len(self.model.languages)), dtype=np.float32)
        left = np.arange(len(words))
        for size in GRAM_SIZES:
            table, rows = self.grams[size]
            if not len(left) or not len(table):
                continue
            codes, n = gram_codes([f" {words[i]} " for i in left], size)
            at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
            hit = table[at] == codes
            word = np.repeat(np.arange(len(left)), n)[hit]
            known = np.bincount(word, minlength=len(left))
            done = (known > 0) & (2 * known >= n)
            logs = self.model.gram_logs[rows[at[hit]]]
            total = np.stack([np.bincount(word, logs[:, k], len(left)) for k in range(logs.shape[1])], axis=1)
            out[left[done]] = total[done] / known[done][:, None]
            left = left[~done]
        return out

    def matrix(self) -> np.ndarray:
        if self.more:
            self.logs, self.more = np.concatenate([self.logs, *self.more]), []
        return self.logs


def _chunks(texts: list, chars: int) -> Iterator[list]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size > chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        scorer = Scorer(model)
        for batch in batches:
            langs, best = [], []
            for texts in _chunks(batch.column("text").to_pylist(), _CHUNK_CHARS):
                cut = [text.split() if text and model.languages and _LETTER.search(text) else None for text in texts]
                if scorer.used > _MEMO_ROWS:
                    scorer.reset()
                scorer.learn(set().union(*(c for c in cut if c)).difference(scorer.row))
                matrix, row = scorer.matrix(), scorer.row
                for words in cut:
                    if words is None:
                        langs.append("und")
                        best.append(0.0)
                        continue
                    rows = np.fromiter(map(row.__getitem__, words), dtype=np.int64, count=len(words))
                    n = int((rows > 0).sum())
                    total = matrix[rows].sum(axis=0, dtype=np.float64)
                    soft = total * (EVIDENCE / max(n, EVIDENCE))
                    soft = np.exp(soft - soft.max())
                    k = int(np.argmax(total))
                    langs.append(model.languages[k])
                    best.append(float(soft[k] / soft.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                 pa.array(best, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(_predict(spark.sparkContext.broadcast(model)),
                           "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """Fit on ``docs`` and predict all of its rows."""
    return predict(docs, fit(docs, **options))
