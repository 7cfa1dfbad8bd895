"""Operators 11 to 13 against brute-force versions on planted rows."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from verdant.llm import lexical_search as LX
from verdant.llm import vector_search as VS
from verdant.llm import whitening as WH

VEC = "vec_id long, embedding array<float>, id string, vec string, list string, key string, x string, n string, score string"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, *["clash"] * 7) for i, v in rows], VEC)


def _cloud(n, d=24, seed=1):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(12, d))
    return (m[rng.integers(0, 12, n)] * .6 + rng.normal(size=(n, d))).astype(np.float32)


# ------------------------------------------------------------------ operator 11

def _exact(rows, q, v, k):
    best = {}
    for i, x in rows:
        if i != q:
            d = float(np.sqrt(((np.array(x, float) - np.array(v, float)) ** 2).sum()))
            best[i] = min(best.get(i, d), d)
    return sorted(((d, i) for i, d in best.items()))[:k]


def test_vector_search_recall_and_order(spark):
    x = _cloud(3000)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    hot = x[7].tolist()
    rows += [(10000 + i, hot) for i in range(1500)]              # a third of all rows are copies
    rows += [(20000, x[8].tolist()), (20100, x[9].tolist())]     # queries that are copies
    rows += [(-100, x[11].tolist())]
    df = _vectors(spark, rows).repartition(5)
    queries = df.where("vec_id % 100 = 0")
    got = VS.search(df, queries, sample=400, part_rows=200, max_lists=24).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    want = {i: v for i, v in rows if i % 100 == 0}
    assert set(by) == set(want)
    hits = total = 0
    for q, rs in by.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in rs] == sorted((r.score, r.vec_id) for r in rs)
        true = _exact(rows, q, want[q], 10)
        hits += len({r.vec_id for r in rs} & {i for _, i in true})
        total += 10
        vecs = dict(rows)
        for r in rs:
            assert r.score == pytest.approx(math.dist(vecs[r.vec_id], want[q]), rel=1e-12)
    assert hits / total >= 0.9
    # ties of copies go to the smallest ids, the query's own row is not among them
    assert [r.vec_id for r in by[10000]] == [7, *range(10001, 10010)]
    assert by[20000][0].vec_id == 8 and by[20000][0].score == 0


def test_vector_search_edges(spark):
    good = [(100, [1., 2.]), (1, [1., 2.]), (2, [1., 3.]), (2, [9., 9.]), (2, [1., 3.]), (200, [5., 5.]), (200, [0., 1.])]
    bad = [(300, None), (400, [0., 0.]), (500, [None, 1.]), (600, [float("nan"), 1.]), (700, [float("inf"), 1.]),
           (800, []), (None, [1., 2.])]
    df = _vectors(spark, good + bad)
    got = sorted(tuple(r) for r in VS.search(df, df.where("vec_id % 100 = 0")).collect())
    root = math.sqrt
    # 200 stands for its least vector, 2 is listed once, at its nearest
    assert [(q, r, i) for q, r, i, _ in got] == [(100, 1, 1), (100, 2, 2), (100, 3, 200), (200, 1, 1), (200, 2, 100), (200, 3, 2)]
    assert [s for *_, s in got] == pytest.approx([0, 1, root(2), root(2), root(2), root(5)])
    empty = _vectors(spark, [])
    assert VS.search(empty, empty).count() == 0
    assert VS.search(_vectors(spark, bad), df).count() == 0
    one = _vectors(spark, good[:1])
    assert VS.search(one, one).count() == 0


def test_scan_keeps_what_is_near():
    x = _cloud(800, 64, 3).astype(float)
    q, turn = x[:20], VS.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    d = VS.squared(q, x)
    radius2 = np.sort(d, 1)[:, 10]
    qi, vi = VS.scan(x @ turn, q @ turn, radius2)
    near = {(i, j) for i, j in zip(*np.nonzero(d <= radius2[:, None] * (1 - 1e-9)))}
    found = set(zip(qi.tolist(), vi.tolist()))
    assert len(near & found) >= 0.98 * len(near) and len(found) <= 2 * len(near)
    qi, vi = VS.scan(x @ turn, q @ turn, radius2, eps=1e9)       # without early tests the scan is exact
    assert near <= set(zip(qi.tolist(), vi.tolist()))


def test_fold_keeps_the_smallest_ids():
    v = np.array([[1., 2.], [1., 2.], [3., 4.], [1., 2.], [-0., 2.], [0., 2.], [1., 2.]])
    ids = np.array([5, 3, 9, 3, 1, 0, 4])
    left = VS.fold(v, ids, 2)
    assert sorted((ids[i], tuple(v[i] + 0.)) for i in left) == [(0, (0., 2.)), (1, (0., 2.)), (3, (1., 2.)), (4, (1., 2.)), (9, (3., 4.))]


# ------------------------------------------------------------------ operator 12

@pytest.mark.parametrize("weight", ["one", "copies"])
def test_whitening_against_numpy(spark, weight):
    x = _cloud(300, 10, 5)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[i % 3].tolist()) for i in range(200)]
    rows += [(3, x[3].tolist()), (None, x[4].tolist())]          # a repeated row, a null id
    bad = [(5000, None), (5001, [None] * 10), (5002, [float("nan")] * 10), (5003, [float("-inf")] * 10), (5004, [])]
    got = WH.whiten(_vectors(spark, rows + bad).repartition(7), weight=weight).collect()
    whole = np.floor(256 * np.array([v for _, v in rows], float)).astype(int)
    u, c = np.unique(whole, axis=0, return_counts=True)
    w = c if weight == "copies" else np.ones_like(c)
    n, s = int(w.sum()), w @ u
    cov = ((u - s / n).T * w) @ (u - s / n) / n
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1][:4], axes[:, ::-1][:, :4]
    assert len(got) == 4 * len(rows)
    expected = Counter()
    signs = {}
    for (i, _), xi in zip(rows, whole):
        dev = int(((n * xi - s) ** 2).sum())
        for j, y in enumerate((xi - s / n) @ axes / np.sqrt(e)):
            expected[i, j + 1, dev, round(abs(y), 8)] += 1
            signs.setdefault((i, j + 1), y)
    assert Counter((r.vec_id, r.component, r.deviation, round(abs(r.whitened), 8)) for r in got) == expected
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for r in got:
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(cov), rel=1e-9)
    for j in range(1, 5):                                        # one sign for all rows of a component
        assert len({np.sign(r.whitened * signs[r.vec_id, j]) for r in got if r.component == j and abs(r.whitened) > 1e-6}) == 1


def test_whitening_edges(spark):
    assert WH.whiten(_vectors(spark, [])).count() == 0
    assert WH.whiten(_vectors(spark, [(1, None), (2, [])])).count() == 0
    same = [(i, [.5, .25]) for i in range(9)]
    assert WH.whiten(_vectors(spark, same)).count() == 0          # no variance
    line = WH.whiten(_vectors(spark, same + [(9, [1., .5])])).collect()
    assert len(line) == 10 and {r.component for r in line} == {1}  # one direction only
    assert sorted(round(abs(r.whitened), 9) for r in line) == [1.0] * 10 and line[0].n == 2
    with pytest.raises(Exception, match="entries|unequal"):
        WH.whiten(_vectors(spark, [(1, [1.]), (2, [1., 2.])])).count()
    big = WH._deviation(np.array([[3, -4]]), 10 ** 6, [1, 2])
    assert big.tolist() == [(3 * 10 ** 6 - 1) ** 2 + (4 * 10 ** 6 + 2) ** 2]
    with pytest.raises(OverflowError):
        WH._deviation(np.array([[3, -4]]), 10 ** 10, [1, 2])


# ------------------------------------------------------------------ operator 13

def _rank(docs, items, k=10):
    def terms(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    held = [h for h in held if h[2]]
    n_docs, total = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items.items():
        scores = []
        for i, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                    ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


DOC = "doc_id long, text string, n long, terms string, counts string, score string"


def test_lexical_search_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Größe", "naïve", "x2", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    def text(n):
        return "".join(rng.choice([str.upper, str])(w) + rng.choice([" ", ", ", "\n", "-", "'"])
                       for w in rng.choices(words, weights, k=n))
    docs = [(i, text(rng.randint(1, 80))) for i in range(400)]
    docs += [(i, docs[0][1]) for i in range(500, 530)] + [(3, docs[3][1])]      # ties, a repeated row
    docs += [(900, None), (901, ""), (902, "... !"), (None, text(40)), (903, text(60000))]
    items = {i: text(rng.randint(1, 90)) for i in range(40)}
    items[5] = items[6] + " " + items[7]                                        # shared sets
    rows = list(items.items()) + [(50, None), (51, "?!"), (None, "w1 w2"), (52, "unheard of")]
    d = spark.createDataFrame([(*x, 1, "a", "b", "c") for x in docs], DOC).repartition(4)
    it = spark.createDataFrame([(*x, "e") for x in rows + rows[:3]], "item_id long, text string, rank string")
    want = _rank(docs, {**items, 52: "unheard of"})
    assert sorted(tuple(r) for r in LX.search(d, it).collect()) == want
    assert sorted(tuple(r) for r in LX.search(d, it, block_chars=300).collect()) == want
    assert LX.search(d.limit(0), it).count() == LX.search(d, it.limit(0)).count() == 0
    assert LX.search(d.where("doc_id > 900"), it.where("item_id = 51")).count() == 0


def test_shared_graph_expands_to_the_items():
    rng = random.Random(3)
    base = [f"t{i}".encode() for i in range(30)]
    items = []
    for i in range(25):
        t = base[:rng.randint(0, 8)] + rng.choices(base, k=rng.randint(1, 30))
        items.append((i, t))
    items.append((99, [f"z{i % 300}".encode() for i in range(1000)]))           # longer than a window
    g = LX.share(items)
    first = len(g.terms)
    value = {i: Counter([t]) for i, t in enumerate(g.terms)}
    value |= {first + i: value[b] for i, b in enumerate(g.base.tolist())}
    below = {}
    for node, left, right in g.levels:
        for a, b, c in zip(node.tolist(), left.tolist(), right.tolist()):
            assert a not in value and b < a and c < a
            value[a] = value[b] + value[c]
            below[a] = (b, c)
    assert sorted(value) == list(range(g.symbols))
    for (_, t), s in zip(items, g.items):
        assert sum((value[x] for x in s), Counter()) == Counter(t)
    def parts(x):
        return {x} | {y for z in below.get(x, ()) for y in parts(z)}
    uses = Counter(n for s in g.items[:-1] for n in set().union(*map(parts, s)) & set(below))
    assert below and all(uses[a] >= 2 for a in below)             # every node is a set that items share
    assert sum(map(len, g.items)) + 2 * len(below) < sum(len(t) for _, t in items)
