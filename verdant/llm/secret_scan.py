"""Secret scan with a trigram inverted index (operator 6).

Every rule's regular expression is turned into a Boolean query of the
(lower-cased) trigrams that any match must hold.  Each Arrow block of
documents gets an inverted index of the trigrams asked for: one pass over its
characters makes all postings, conjunctions intersect them, alternatives unite them.
Only the documents that remain are scanned with the rule itself.  Rules
without mandatory trigrams scan every document.  The index never leaves its
block, so nothing is shuffled and no list of a frequent trigram can grow
beyond a block.

Edge cases: a null text counts as empty (no spans); rows with null or
repeated ids are scanned each; an empty table gives an empty result.  Whole
texts are scanned, spans are code points with an exclusive end.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALWAYS = [frozenset()]                # the query that every text satisfies
_MOST = 64                            # exact strings or alternatives kept while deriving
_CHUNK = 1 << 21                      # characters indexed at once


@dataclass(frozen=True)
class Rule:
    """``kind``, its pattern, the least length of group ``group`` of a match, and the
    group whose span is reported."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    span: int = 0


# fixed values: the base kinds, in the order of the digest
BASE = [
    Rule("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),    # the runs [0-9a-f]+ of 24 characters and more
]
# the method's own kinds
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("maps_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("pay_key", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    # entered only where a scheme may start: one pass whatever the lengths
    Rule("url_login", r"(?<![A-Za-z0-9+.-])[0-9+.-]*+([A-Za-z][A-Za-z0-9+.-]++://[^\s/:@]++:[^\s/@]++@)", span=1),
]


# --- trigram queries: a list of conjunctions (frozensets), any of which must hold

def _and(a, b):
    out = {x | y for x in a for y in b}
    return list(out) if len(out) <= _MOST else a


def _or(a, b):
    out = set(a) | set(b)
    return ALWAYS if frozenset() in out or len(out) > _MOST else list(out)


def _grams(strings: set[str]):
    """Query of the trigrams of any of the strings."""
    out = []
    for s in strings:
        if len(s) < 3:
            return ALWAYS
        out.append(frozenset(s[i:i + 3] for i in range(len(s) - 2)))
    return out


def _class(items) -> set[str] | None:
    """The lower-cased characters of a small class, None of a large or negated one."""
    out: set[str] = set()
    for kind, arg in items:
        name = str(kind)
        if name == "LITERAL":
            out.add(chr(arg).lower())
        elif name == "RANGE" and arg[1] - arg[0] < _MOST:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _walk(nodes) -> tuple[set[str] | None, list]:
    """(exact strings or None, query) of a concatenation."""
    exact: set[str] | None = {""}
    run, query = {""}, ALWAYS

    def close():
        nonlocal run, query
        query, run = _and(query, _grams(run)), {""}

    for kind, arg in nodes:
        name, part, inner, open_end = str(kind), None, ALWAYS, False
        if name == "LITERAL":
            part = {chr(arg).lower()}
        elif name == "IN":
            part = _class(arg)
        elif name == "SUBPATTERN":
            part, inner = _walk(arg[-1])
        elif name == "BRANCH":
            got = [_walk(b) for b in arg[1]]
            part = set().union(*(p for p, _ in got)) if all(p is not None for p, _ in got) else None
            inner = got[0][1]
            for _, q in got[1:]:
                inner = _or(inner, q)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, sub = arg
            sub_exact, sub_query = _walk(sub)
            if low == 0:
                part = sub_exact | {""} if high == 1 and sub_exact is not None else None
            else:
                inner = sub_query
                if sub_exact is not None:
                    part = {""}
                    for _ in range(min(low, 3)):
                        part = {a + b for a in part for b in sub_exact}
                        if len(part) > _MOST:
                            part = None
                            break
                    open_end = not (low == high and low <= 3)
        elif name == "AT":
            part = {""}
        query = _and(query, inner)
        joined = {a + b for a in run for b in part} if part is not None else None
        if joined is None or len(joined) > _MOST:
            close()
            exact = None
            run = set(part) if part is not None else {""}
        else:
            run = joined
        if open_end:
            close()
            exact = None
    if exact is not None:
        exact = set(run)
    query = _and(query, _grams(run))
    return exact, query


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of lower-cased trigrams one of which any match holds; a
    query with the empty conjunction holds always."""
    query = _walk(re._parser.parse(pattern))[1]
    if frozenset() in query:
        return ALWAYS
    return sorted((c for c in set(query) if not any(o < c for o in query)), key=sorted)


class BlockIndex:
    """Inverted index of a block of texts over the trigrams asked for: one pass over the
    characters finds the places of all of them."""

    def __init__(self, texts: list[str], grams: list[str]):
        self.n = len(texts)
        alphabet = sorted({ord(c) for g in grams for c in g})
        number = np.zeros((alphabet[-1] if alphabet else 0) + 2, dtype=np.int32)   # 0: in no trigram
        number[alphabet] = np.arange(1, len(alphabet) + 1)
        base = len(alphabet) + 1
        wanted = np.full(base ** 3, -1, dtype=np.int32)
        for i, (a, b, c) in enumerate(number[[ord(x) for x in g]] for g in grams):
            wanted[(a * base + b) * base + c] = i
        found = [np.empty(0, dtype=np.int64)]
        for docs, text in self._chunks(texts):
            code = number[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"), len(number) - 1)]
            starts = np.array([s for _, s in docs], dtype=np.int64)
            code[starts[1:] - 1] = 0                                   # between two texts
            hit = wanted[(code[:-2] * base + code[1:-1]) * base + code[2:]]
            at = np.flatnonzero(hit >= 0)
            rows = np.array([d for d, _ in docs], dtype=np.int64)[np.searchsorted(starts, at, "right") - 1]
            found.append(np.unique(hit[at].astype(np.int64) * self.n + rows))
        pairs = np.unique(np.concatenate(found))
        cuts = np.searchsorted(pairs, np.arange(len(grams) + 1) * self.n)
        self.postings = {g: pairs[cuts[i]:cuts[i + 1]] - i * self.n for i, g in enumerate(grams)}

    @staticmethod
    def _chunks(texts: list[str]):
        """The lower-cased texts in strings of a bounded size, with ``(text, start)`` of each
        part; parts of one text overlap by two characters, so that no trigram is cut."""
        docs, parts, size = [], [], 0
        for i, text in enumerate(texts):
            low = text.lower()
            for lo in range(0, max(len(low) - 2, 0), _CHUNK):
                part = low[lo:lo + _CHUNK + 2]
                docs.append((i, size))
                parts.append(part)
                size += len(part) + 1
                if size > _CHUNK:
                    yield docs, "\n".join(parts)
                    docs, parts, size = [], [], 0
        if parts:
            yield docs, "\n".join(parts)

    def rows(self, gram: str) -> np.ndarray:
        return self.postings[gram]

    def matches(self, query: list[frozenset[str]]) -> np.ndarray:
        if query == ALWAYS:
            return np.arange(self.n)
        found = []
        for grams in query:
            rows = None
            for g in sorted(grams):
                rows = self.rows(g) if rows is None else np.intersect1d(rows, self.rows(g), assume_unique=True)
                if not len(rows):
                    break
            found.append(rows)
        return np.unique(np.concatenate(found))


def _scan(rules: list[Rule], n_base: int):
    plans = [(k, re.compile(r.pattern), r, trigram_query(r.pattern)) for k, r in enumerate(rules)]
    grams = sorted({g for _, _, _, query in plans for conjunction in query for g in conjunction})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            index = BlockIndex(texts, grams)
            spans: list[list] = [[] for _ in texts]
            for k, rx, rule, query in plans:
                for i in index.matches(query):
                    for m in rx.finditer(texts[i]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            spans[i].append((m.start(rule.span), k, m.end(rule.span)))
            counts = [[0] * len(texts) for _ in range(n_base)]
            digests, alls = [], []
            for i, found in enumerate(spans):
                found.sort()
                for _, k, _ in found:
                    if k < n_base:
                        counts[k][i] += 1
                digests.append(hashlib.sha256(",".join(
                    f"{rules[k].kind}:{a}:{b}" for a, k, b in found if k < n_base).encode()).hexdigest())
                alls.append(",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digests, pa.string()), pa.array(alls, pa.string())],
                names=["doc_id", *(f"n_{r.kind}" for r in rules[:n_base]), "base_sha256", "spans"])
    return run


def scan(docs: DataFrame, base: list[Rule] | None = None, more: list[Rule] | None = None) -> DataFrame:
    """Per row: a count for each base kind, ``base_sha256`` (digest of the base
    spans) and ``spans`` (``kind:start:end`` of all kinds, by start, then kind)."""
    base, more = BASE if base is None else base, MORE if more is None else more
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = ["doc_id long", *(f"n_{r.kind} long" for r in base), "base_sha256 string", "spans string"]
    return docs.mapInArrow(_scan([*base, *more], len(base)), ", ".join(schema))


def redact(docs: DataFrame, mask: str = "*") -> DataFrame:
    """``docs`` with every code point of a found span masked (``text`` only)."""
    rules = [(re.compile(r.pattern), r) for r in [*BASE, *MORE]]
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                if text:
                    chars = None
                    for rx, rule in rules:
                        for m in rx.finditer(text):
                            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                                chars = list(text) if chars is None else chars
                                a, b = m.span(rule.span)
                                chars[a:b] = mask * (b - a)
                    text = "".join(chars) if chars is not None else text
                out.append(text)
            cols = [pa.array(out, batch.schema.field(i).type) if i == at else batch.column(i)
                    for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)
    return docs.mapInArrow(run, docs.schema)
