"""Operator 2 and the components against brute force."""
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from verdant.llm import graph, ngram_jaccard as J
from verdant.llm.setjoin import resolve

SYL = "an be con der el fi go ha in ko la mo".split()


def words(rng, n):
    return ["".join(rng.choice(SYL) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def brute(texts, num=85, den=100, size=4):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        k = min(size, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                    ra, rb = sorted((root(a), root(b)))
                    comp[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed, n=60):
    rng = random.Random(seed)
    texts, out = [words(rng, rng.choice([1, 3, 4, 9, 30, 80, 200])) for _ in range(n // 4)], {}
    share = words(rng, 60)
    for i in range(n):
        w = list(rng.choice(texts))
        kind = rng.random()
        if kind < .6:
            for _ in range(rng.randint(0, 1 + len(w) // 40)):
                w[rng.randrange(len(w))] = "x" + str(rng.randint(0, 99))
        elif kind < .8:
            w = w + share
        out[i] = (" \n\t"[rng.randrange(3)]).join(x.upper() if rng.random() < .1 else x for x in w)
    out[n], out[n + 1], out[n + 2] = None, "", "  \n\x0b "
    return out


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, "c") for i, t in texts.items()], "doc_id long, text string, component string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs, sketch_bits=10).collect()}
    assert got == brute(texts)


def test_components_equal_brute_force(spark):
    for seed in (1, 2):
        check(spark, corpus(seed))


def test_chain_and_large_group_of_near_copies(spark):
    """A group whose members link only through neighbours, and 300 edits of one text."""
    rng = random.Random(5)
    base = words(rng, 120)
    chain, texts = list(base), {}
    for i in range(12):                      # each step changes a little more of the text
        chain = list(chain)
        chain[i * 10] = f"edit{i}"
        texts[i] = " ".join(chain)
    other = words(rng, 90)
    for i in range(300):
        w = list(other)
        w[rng.randrange(90)] = f"new{i}"
        texts[100 + i] = " ".join(w)
    check(spark, texts)


def test_threshold_is_exact(spark):
    """17 of 20 is 0.85 (linked), 16 of 20 is not."""
    a = [f"w{i}" for i in range(20)]
    for drop, linked in ((3, True), (4, False)):
        # sets of single "shingles": texts of one long window each would not do, so use words=1
        docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(a[:-drop]))], "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in J.jaccard_components(docs, words=1, sketch_bits=8).collect()}
        assert (got[2] == 1) is linked


def test_prefixes_of_linked_pairs_share_what_is_needed():
    rng = random.Random(4)
    for _ in range(4000):
        n, m = rng.randint(1, 90), rng.randint(1, 90)
        if 85 * max(n, m) > 100 * min(n, m):
            continue
        common = -(-85 * (n + m) // 185)
        if common > min(n, m):
            continue
        order = rng.sample(range(1000), n + m - common)
        both, a, b = order[:common], order[common:n], order[n:]
        x, y = sorted(both + a), sorted(both + b)
        prefix = [s[:J.core(len(s), 85, 100) + J.extra(len(s), 85, 100)] for s in (x, y)]
        assert len(set(prefix[0]) & set(prefix[1])) >= max(J.needed(len(x), 85, 100), J.needed(len(y), 85, 100))
        assert set(x[:J.core(len(x), 85, 100)]) & set(y[:J.core(len(y), 85, 100)])


def test_empty_null_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_components(empty).count() == 0 and J.keep_one(empty).count() == 0
    docs = spark.createDataFrame([(1, "a b c d e", 9), (1, "a b c d e", 9), (2, "A b C d e", 9), (None, "a b c d e", 9)],
                                 "doc_id long, text string, n long")
    got = sorted((r.doc_id, r.component_id) for r in J.jaccard_components(docs).collect())
    assert got == [(1, 1), (2, 1)]
    # rows equal in id and text are one document; the row without an id is its copy, and last
    assert sorted(map(str, (r.doc_id for r in J.keep_one(docs).collect()))) == ["1", "1"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_graph_components(spark, edges):
    got = {r.id: r.component for r in graph.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    comp = {}
    for a, b in edges:
        if a != b:
            comp.setdefault(a, a), comp.setdefault(b, b)
    for _ in comp:
        for a, b in edges:
            if a != b:
                comp[a] = comp[b] = min(comp[a], comp[b])
    assert got == comp


def test_long_path(spark):
    n = 200
    got = {r.id: r.component for r in graph.components(
        spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")).collect()}
    assert got == {i: 0 for i in range(n + 1)}


def test_resolve_without_members(spark):
    none = spark.createDataFrame([], "key long, id long")
    sets = spark.createDataFrame([], "id long, payload binary")
    assert resolve(none, lambda ids: sets, 85, 100).count() == 0


def _payloads(spark, sets):
    import numpy as np
    rows = [(i, np.sort(np.array(sorted(s), dtype="<i8")).tobytes()) for i, s in sets.items()]
    return spark.createDataFrame(rows, "id long, payload binary")


def _components(spark, lists, sets, num=80, den=100):
    members = spark.createDataFrame([(k, i) for k, ids in lists.items() for i in ids], "key long, id long").repartition(6)
    table = _payloads(spark, sets)
    got = resolve(members, lambda ids: table.join(ids, "id", "left_semi"), num, den)
    return {r.id: r.component for r in got.collect()}


def test_a_list_of_dissimilar_members_and_a_chain(spark):
    """One hot list: thousands of dissimilar sets, a chain whose ends are not alike, and copies
    of a base of which some are too far from the base, but near a neighbour."""
    rng = random.Random(9)
    sets = {i: {rng.getrandbits(40) for _ in range(12)} for i in range(5000)}
    chain = [rng.getrandbits(40) for _ in range(40)]
    for i in range(30):                                           # each shares 20 of 21 with the next one
        sets[10_000 + i] = set(chain[i % 20:i % 20 + 20]) | {chain[(i + 5) % 40]} if i < 20 else set(chain[:20])
    base = [rng.getrandbits(40) for _ in range(30)]
    for i in range(300):
        s = set(base)
        for _ in range(rng.randint(0, 5)):
            s.discard(rng.choice(base))
        sets[20_000 + i] = s | {rng.getrandbits(40) for _ in range(rng.randint(0, 4))}
    lists = {1: list(sets), 2: [i for i in sets if i >= 10_000], 3: [i for i in sets if i >= 20_000]}
    got = _components(spark, lists, sets)
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    near = [i for i in sets if i >= 10_000]
    for a in near:
        for b in near:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                comp[rb] = ra
    want = {i: root(i) for i in near}
    linked = {i for i in near if sum(want[i] == want[j] for j in near) > 1}
    assert len(linked) > 200
    assert {i: got.get(i, i) for i in near} == want and not set(got) & set(range(5000))


def test_equal_lists_are_one_list(spark):
    sets = {i: set(range(i // 2, 40)) for i in range(8)}
    lists = {k: list(sets) for k in range(60)} | {100: [0, 1], 101: [6, 7]}
    assert set(_components(spark, lists, sets).values()) == {0}


def test_best_partners_first(spark):
    import numpy as np
    from verdant.llm.common import bitmap_of
    from verdant.llm.setjoin import _tile_pairs
    rng = np.random.default_rng(1)
    base = np.sort(rng.integers(0, 1 << 50, 60))
    sets = [np.unique(np.r_[base[:60 - i % 7], rng.integers(0, 1 << 50, i % 5)]) for i in range(20)]
    ids, comps, sizes = np.arange(20), np.arange(20), np.array([len(s) for s in sets])
    bits, all_ = [bitmap_of(s) for s in sets], np.ones(20, dtype=bool)
    full = set(_tile_pairs(ids, comps, sizes, bits, all_, all_, 80, 100, None))
    some = list(_tile_pairs(ids, comps, sizes, bits, all_, all_, 80, 100, 2))
    pairs = {p for p in some if p[1] is not None}
    assert pairs < full and len(pairs) <= 2 * 20 and any(b is None for _, b in some)


def test_a_list_sends_rows_by_its_members(spark, monkeypatch):
    """Near copies in one list: neither round sends rows by pairs, or by members times blocks."""
    import numpy as np
    from verdant.llm import setjoin
    monkeypatch.setattr(setjoin, "TILE", 32)
    rng = random.Random(5)
    base = [rng.getrandbits(50) for _ in range(60)]
    sets = {i: sorted({*rng.sample(base, 58), rng.getrandbits(50)}) for i in range(200)}
    rows = spark.createDataFrame([(i, bytearray(np.array(x, dtype="<i8").tobytes())) for i, x in sets.items()], setjoin.SETS)
    lists = spark.createDataFrame([(7, i) for i in sets], "key long, id long")
    comps = spark.createDataFrame([], "id long, component long")
    first = setjoin._candidates(lists, comps, rows, 80, 100, setjoin.stored, setjoin.BEST).collect()
    assert len(first) <= (setjoin.BEST + 1) * len(sets) and any(r.open == 7 for r in first)
    links = setjoin._candidates(lists, comps, rows, 80, 100, setjoin.stored, None).collect()
    blocks = -(-len(sets) // 32)
    assert 0 < len(links) < 64 * blocks * blocks
    for r in links:
        a, b = set(sets[r.a]), set(sets[r.b])
        assert r.open is None and 100 * len(a & b) >= 80 * len(a | b)
    # the links of the tiles join all that are linked
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for r in links:
        up[max(root(r.a), root(r.b))] = min(root(r.a), root(r.b))
    assert {root(i) for i in sets} == {0}


def test_tables_of_a_step_go_with_it(spark):
    import glob
    import os
    from verdant.llm import line_dedup
    from verdant.llm.common import scratch_dir

    def tables():
        return set(glob.glob(os.path.join(scratch_dir(spark).removeprefix("file://"), "llm-*")))

    before = tables()
    line = "the same long line of words stands in more than one of these documents"
    docs = spark.createDataFrame([(i, f"{line} {i // 2}\nheading") for i in range(8)], "doc_id long, text string").repartition(4)
    gone = line_dedup.duplicate_lines(docs)
    left = {os.path.basename(x).rsplit("-", 1)[0] for x in tables() - before}
    assert left == {"llm-removed"}              # only what the result reads
    # one line near-equal to all others stays, and one heading
    assert {(r.doc_id, r.line_no) for r in gone.collect()} == {(i, n) for i in range(1, 8) for n in (0, 1)}
    assert J.keep_one(docs).count() > 0
    left = {os.path.basename(x).rsplit("-", 1)[0] for x in tables() - before}
    assert left == {"llm-removed", "llm-least"}


def test_equal_sets_are_fetched_once(spark):
    sets = {i: set(range(20 * (i % 3), 20 * (i % 3) + 20)) for i in range(30)} | {40: set(range(19)), 41: set(range(90, 99))}
    members = spark.createDataFrame([(i % 3, i) for i in range(30)] + [(0, 40), (0, 41)], "key long, id long").repartition(6)
    table = _payloads(spark, sets)
    asked = []

    def fetch(ids):
        asked.extend(r.id for r in ids.collect())
        return table.join(ids, "id", "left_semi")

    def copies(ids):
        one = spark.createDataFrame([(i, i % 3, 10) for i in range(30)] + [(40, 40, 1), (41, 41, 1)],
                                    "id long, one long, copies long")
        return one.join(ids, "id", "left_semi")

    got = {r.id: r.component for r in resolve(members, fetch, 80, 100, copies=copies).collect()}
    assert sorted(asked) == [0, 40, 41]         # a list of copies alone needs no set
    assert got == {i: i % 3 for i in range(30)} | {40: 0}


def test_keys_that_come_once_end_in_their_bucket(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from verdant.llm import line_dedup as L
    rng = np.random.RandomState(3)
    keys = rng.randint(0, 4000, (300, L.BANDS))
    keys[:40, 0] = 7                            # one key of many lines
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(300)), "keys": [k.tobytes() for k in keys]})
    flat = [(int(k), i) for i, row in enumerate(keys) for k in row]
    count = {}
    for k, _ in flat:
        count[k] = count.get(k, 0) + 1
    want = sorted(x for x in flat if count[x[0]] > 1)

    def met():
        lists = pa.Table.from_batches(L._deal(5)(iter(batch.slice(i, 70) for i in range(0, 300, 70)))).sort_by("bucket")
        return sorted(x for b in L._met(iter(lists.to_batches(max_chunksize=2)))
                      for x in zip(b.column("key").to_pylist(), b.column("id").to_pylist()))

    assert met() == want
    monkeypatch.setattr(L, "_DEALT", 500)       # several lists a bucket
    assert met() == want
    monkeypatch.setattr(L, "_MOST", 100)        # what is too much for a bucket goes on whole
    assert set(want) <= set(met()) <= set(flat)


def test_stars_end_the_walk(spark, monkeypatch):
    made = []
    staged = graph.staged
    monkeypatch.setattr(graph, "staged", lambda df, name, **kw: made.append(name) or staged(df, name, **kw))
    got = graph.components(spark.createDataFrame([(1, 2), (3, 1), (5, 9)], "a long, b long"))
    assert {(r.id, r.component) for r in got.collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (9, 5)}
    assert made == ["edges", "components"]


def test_copies_send_no_lists(spark, monkeypatch):
    from verdant.llm import line_dedup as L
    sent = []
    join = L.resolve

    def seen(members, *rest):
        sent.extend(r.id for r in members.collect())
        return join(members, *rest)

    monkeypatch.setattr(L, "resolve", seen)
    line = "a long line of words that every one of these documents holds as it is"
    docs = spark.createDataFrame([(i, f"  {line.upper()}" if i % 2 else line) for i in range(8)],
                                 "doc_id long, text string").repartition(4)
    assert {tuple(r) for r in L.duplicate_lines(docs).collect()} == {(i, 0, 0, 0) for i in range(1, 8)}
    assert not sent                             # equal lines of several tasks are one member
    near = docs.union(spark.createDataFrame([(9, f"{line} and more"[:-4])], docs.schema))
    assert {tuple(r) for r in L.duplicate_lines(near).collect()} == {(i, 0, 0, 0) for i in (*range(1, 8), 9)}
    assert len(set(sent)) == 2                  # the text of eight lines, and the other one


def test_sets_of_no_open_list_are_not_signed(spark):
    import pyarrow as pa
    from verdant.llm import setjoin as S
    wanted = S._marks(spark.createDataFrame([(3,), (-5,)], "id long"))
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 3, -5, 8]), "payload": pa.array([b"\1" + b"\0" * 7] * 4)})
    (signed,) = S._signer(S.stored, wanted)(iter([batch]))
    assert signed.column("id").to_pylist() == [3, -5] and signed.column("n").to_pylist() == [1, 1]
    (left,) = S._among(wanted)(iter([batch]))
    assert left.column("id").to_pylist() == [3, -5]
