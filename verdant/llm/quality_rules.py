"""Quality rules by distribution divergence (operator 4), native expressions only.

Base rules count words, symbols, repeated lines and words in repeated 3-word
windows of the whole text.  The method then compares two histograms of a
document with those of its language: character classes, and common words
(plus one bin for all other words).  A language's reference is the sum over
all its documents that pass the base rules.  A document is kept when both
Jensen-Shannon distances (square root of the base-2 divergence, 0 to 1) stay
within their limits.  Minimum lengths guard both sides: a text too short for a
histogram skips that test, and so does a language with too little text.

Everything is a map over documents except the sums of the references, one row
a language, which come from the staged counts (a few numbers a document).

Edge cases: a null or blank text has no words and fails the base rule
(n_words < 50); a null ``doc_id`` is judged as a row like any other; repeated
rows are judged each; rows with a null ``lang`` form a language of their own;
an empty table gives an empty result.  Only ``doc_id``, ``text`` and ``lang``
are read; other columns pass through :func:`filter_documents` untouched,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import packed, staged

# Frequent function words of the languages the corpus may hold.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was on with as are be",
    "de": "der die und in den von zu das mit sich ist im nicht ein eine auf",
    "fr": "de la le et les des en un du une que est pour qui dans au",
    "es": "de la que el en y a los se del las un por con no una",
}
WORDS = {lang: line.split() for lang, line in COMMON_WORDS.items()}
ALL_WORDS = sorted({w for line in WORDS.values() for w in line})     # for other languages
# character classes, taken off the words one after the other; what remains is symbols
CLASSES = [("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("wide", r"[^\x00-\x7F]+"), ("digit", "[0-9]+"),
           ("punct", "[.,;:!?'\"()-]+")]
SYMBOLS = r"[#*$%&|<>]+"

MIN_WORDS, MAX_REPEAT = 50, 50       # base rule: fewer words, or a larger percentage
CLASS_LIMIT, WORD_LIMIT = 0.35, 0.30
CLASS_GUARD, WORD_GUARD = 200, 100   # characters / words below which a histogram says nothing
REF_GUARD = 2000                     # words a language needs for a reference

_WS = r"[\\x20\\x09-\\x0D]+"        # escaped once more for a SQL literal


def _array(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words covered by 3-word windows that occur twice or more.

    A window is a long: its 64-bit hash, whose lowest 24 bits (31 in texts of
    16 million words and more) give way to its place.  Sorted, equal windows
    stand side by side; the words themselves confirm each meeting, so a hash
    collision adds nothing.  The places of the repeated windows then cover up
    to three words each."""
    def by_size(expr) -> str:
        return f"CASE WHEN size(__w) < {1 << 24} THEN {expr((1 << 24) - 1)} ELSE {expr((1 << 31) - 1)} END"

    def windows(low: int) -> str:
        return ("slice(transform(__w, (x, i) -> (xxhash64(x, get(__w, i + 1), get(__w, i + 2)) "
                f"& {-low - 1}L) | i), 1, greatest(size(__w) - 2, 0))")

    def places(low: int) -> str:
        def same(j: str) -> str:
            word = " AND ".join(f"get(__w, cast(x & {low}L AS int) + {k}) = "
                                f"get(__w, cast(get(__win, {j}) & {low}L AS int) + {k})" for k in range(3))
            return f"(coalesce((x ^ get(__win, {j})) & {-low - 1}L = 0L, false) AND {word})"
        return (f"transform(filter(__win, (x, i) -> {same('i + 1')} OR {same('i - 1')}), "
                f"x -> x & {low}L)")

    df = df.withColumn("__win", F.expr(f"sort_array({by_size(windows)})"))
    df = df.withColumn("__at", F.expr(f"sort_array({by_size(places)})"))
    return df.withColumn("n_repeat_words", F.expr(
        "aggregate(transform(__at, (x, i) -> least(3L, coalesce(get(__at, i + 1) - x, 3L))), 0L, (s, x) -> s + x)"))


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang`` and the base counts, class counts and common-word counts."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    df = docs.select("doc_id", lang.alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("__t"))
    df = df.withColumn("__w", F.expr(f"array_remove(split(__t, '{_WS}', -1), '')"))
    df = df.withColumn("__l", F.expr(r"filter(split(__t, '\n', -1), x -> x RLIKE '[^\\x20\\x09-\\x0D]')"))
    df = df.withColumn("__c", F.expr(
        "filter(__w, x -> x IN (" + ", ".join(f"'{w}'" for w in ALL_WORDS) + "))"))
    df = df.withColumn("__r0", F.array_join("__w", ""))
    for k, (_, pattern) in enumerate(CLASSES):
        df = df.withColumn(f"__r{k + 1}", F.regexp_replace(f"__r{k}", pattern, ""))
    df = _repeat_words(df)
    left = [F.char_length(f"__r{k}").cast("long") for k in range(len(CLASSES) + 1)]
    classes = [a - b for a, b in zip(left, left[1:])] + [left[-1]]
    counted = "transform({words}, w -> cast(size(__c) - size(array_remove(__c, w)) AS bigint))"
    common = ("CASE lang " + " ".join(f"WHEN '{g}' THEN {counted.format(words=_array(w))}" for g, w in WORDS.items())
              + f" ELSE {counted.format(words=_array(ALL_WORDS))} END")
    plain = len(CLASSES) - 1              # symbols are left once letters and digits are gone
    return df.select(
        "doc_id", "lang",
        F.size("__w").cast("long").alias("n_words"),
        left[0].alias("word_chars"),
        (left[plain] - F.char_length(F.regexp_replace(f"__r{plain}", SYMBOLS, "")).cast("long")).alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.array(*classes).alias("classes"),
        F.expr(common).alias("common"))


def _failed(n_words: Column, n_repeat: Column, min_words: int, max_repeat: int) -> Column:
    return (n_words < min_words) | (100 * n_repeat > max_repeat * n_words)


def references(counts: DataFrame, guard: int = REF_GUARD) -> DataFrame:
    """One row a language with enough text: both histograms as shares."""
    n = len(ALL_WORDS)
    sums = [F.sum("n_words").alias("n_words"), F.sum("word_chars").alias("word_chars")]
    sums += [F.coalesce(F.sum(F.get("classes", F.lit(k))), F.lit(0)).alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    sums += [F.coalesce(F.sum(F.get("common", F.lit(k))), F.lit(0)).alias(f"w{k}") for k in range(n)]
    out = counts.where("not base_failed").groupBy("lang").agg(*sums).where(F.col("n_words") >= guard)
    known = sum((F.col(f"w{k}") for k in range(n)), F.lit(0))
    return out.select(
        "lang",
        F.array(*[F.col(f"c{k}") / F.col("word_chars") for k in range(len(CLASSES) + 1)]).alias("ref_classes"),
        F.array(*[F.col(f"w{k}") / F.col("n_words") for k in range(n)]).alias("ref_common"),
        ((F.col("n_words") - known) / F.col("n_words")).alias("ref_other"))


def _divergence(a: str, b: str) -> str:
    """A bin's term of twice the base-2 Jensen-Shannon divergence."""
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0D END"
    return f"({part.format(a, b)} + {part.format(b, a)})"


def _distance(p: str, total: str, q: str, p_other: str | None = None, q_other: str | None = None) -> str:
    """Jensen-Shannon distance of counts ``p`` (of ``total``) and shares ``q``;
    the shorter array counts as continued with zeros."""
    a, b = f"(coalesce(x, 0L) / {total})", "coalesce(y, 0D)"
    acc = f"aggregate(zip_with({p}, {q}, (x, y) -> {_divergence(a, b)}), 0D, (s, x) -> s + x)"
    if p_other:
        acc += f" + {_divergence(f'({p_other} / {total})', q_other)}"
    return f"sqrt(greatest(0D, least(1D, ({acc}) / 2)))"


def judge(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT,
          class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """Per row of ``docs``: the counts, ``base_failed``, ``kept`` and both distances
    (null where a guard skips the test)."""
    counts = base_counts(docs).withColumn(
        "base_failed", _failed(F.col("n_words"), F.col("n_repeat_words"), min_words, max_repeat))
    counts = staged(counts, "counts")
    refs = staged(references(counts), "refs").withColumnRenamed("lang", "__lang")
    # one row a language: bounded by the number of language codes
    df = counts.join(F.broadcast(refs), F.col("lang").eqNullSafe(F.col("__lang")), "left")
    df = df.withColumn("__other", F.expr("n_words - aggregate(common, 0L, (s, x) -> s + x)"))
    df = df.withColumn("class_distance", F.expr(
        f"CASE WHEN word_chars >= {CLASS_GUARD} AND ref_classes IS NOT NULL "
        f"THEN {_distance('classes', 'word_chars', 'ref_classes')} END"))
    df = df.withColumn("word_distance", F.expr(
        f"CASE WHEN n_words >= {WORD_GUARD} AND ref_common IS NOT NULL "
        f"THEN {_distance('common', 'n_words', 'ref_common', '__other', 'ref_other')} END"))
    fits = ((F.coalesce("class_distance", F.lit(0.0)) <= class_limit)
            & (F.coalesce("word_distance", F.lit(0.0)) <= word_limit))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     (~F.col("base_failed") & fits).alias("kept"), "class_distance", "word_distance")


def filter_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, in their own columns, whatever their
    names; each row is judged on its own text and language, whatever its id."""
    rows = packed(docs, "doc_id", "text", "lang")
    lang = F.col("doc.lang") if "lang" in docs.columns else F.lit(None)
    verdicts = judge(rows.select(F.col("key").alias("doc_id"), F.col("doc.text").alias("text"), lang.alias("lang")), **options)
    kept = verdicts.where("kept").select(F.col("doc_id").alias("key")).distinct()
    return rows.join(kept, "key", "left_semi").select("doc.*")
