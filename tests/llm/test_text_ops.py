"""Operators 3, 4, 6 and 9 against brute force, with the edge cases."""
import hashlib
import random
import re
from collections import Counter

import numpy as np

from verdant.llm import decontaminate as D, line_dedup as L, quality_rules as Q, secret_scan as S

SYL = "an be con der el fi go ha in ko la mo pra sti".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYL) for _ in range(rng.randint(1, 4))) for _ in range(n))


# --- 4: quality rules

def base(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), rep,
            n < 50 or 100 * rep > 50 * n)


def js(p, q):
    p, q = np.array(p, float), np.array(q, float)
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.nansum(np.where(p > 0, p * np.log2(p / m), 0)) + np.nansum(np.where(q > 0, q * np.log2(q / m), 0))
    return float(np.sqrt(max(0, d / 2)))


def histograms(t, lang):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    chars = "".join(w)
    kinds = [len(re.findall(p, chars)) for p in ("[a-z]", "[A-Z]", r"[^\x00-\x7F]", "[0-9]", "[.,;:!?'\"()-]")]
    kinds.append(len(chars) - sum(kinds))
    words = Q.WORDS.get(lang, Q.ALL_WORDS)
    common = [w.count(x) for x in words]
    return kinds, [*common, len(w) - sum(common)]


def test_quality_rules_brute_force(spark):
    rng = random.Random(3)
    en, rows = Q.WORDS["en"], []
    for i in range(120):
        w = prose(rng, rng.randint(30, 260)).split()
        w = [rng.choice(en) if rng.random() < .4 else x for x in w]
        kind = i % 6
        if kind == 1:
            w = w[:12] * 9
        if kind == 2:
            w = [x + "%%%" for x in w]
        if kind == 3:
            w = [x.upper() + "!!" for x in w]
        text = " ".join(w) if kind != 4 else "\n".join([" ".join(w[:9])] * 3 + [" ".join(w), "", " \t"])
        rows.append((i, text + ("ä€𝄞" if kind == 5 else ""), "en" if i % 5 else "xx", i))
    rows += [(200, None, "en", 0), (201, "", None, 0), (202, "a a a a a", "en", 0), (None, "b " * 80, None, 0),
             (203, "x" * 5000, "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    got = Q.judge(docs).collect()
    assert len(got) == len(rows)
    ref = {}
    for _, t, lang, _ in rows:
        b = base(t)
        if not b[5]:
            h = histograms(t, lang)
            r = ref.setdefault(lang, [np.zeros(len(h[0])), np.zeros(len(h[1])), 0])
            r[0], r[1], r[2] = r[0] + h[0], r[1] + h[1], r[2] + b[0]
    by_id = {r[0]: r for r in rows}
    for g in got:
        _, t, lang, _ = by_id[g.doc_id]
        b = base(t)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == b, g
        h, r = histograms(t, lang), ref.get(lang)
        usable = r is not None and r[2] >= Q.REF_GUARD
        cd = js(h[0], r[0]) if usable and b[1] >= Q.CLASS_GUARD else None
        wd = js(h[1], r[1]) if usable and b[0] >= Q.WORD_GUARD else None
        for mine, want in ((g.class_distance, cd), (g.word_distance, wd)):
            assert (mine is None) == (want is None) and (mine is None or abs(mine - want) < 1e-6)
        assert g.kept == (not b[5] and (cd or 0) <= Q.CLASS_LIMIT and (wd or 0) <= Q.WORD_LIMIT)
    assert {g.doc_id for g in got if not g.kept} >= {i for i in range(120) if i % 6 in (1, 2)}
    kept = Q.filter_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {g.doc_id for g in got if g.kept}
    assert Q.judge(docs.limit(0)).count() == 0


def test_quality_rules_are_native(spark):
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    plan = Q.judge(docs)._jdf.queryExecution().executedPlan().toString() + \
        Q.base_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- 9: line dedup

def grams(line):
    x = " ".join(line.lower().split())
    return {x[i:i + 6] for i in range(max(1, len(x) - 5))}


def test_line_dedup_brute_force(spark):
    rng = random.Random(9)
    pool = [prose(rng, rng.randint(8, 40)) for _ in range(25)]
    rows = []
    for d in range(40):
        lines = []
        for _ in range(rng.randint(1, 6)):
            x = rng.choice(pool)
            if rng.random() < .5:
                w = x.split()
                w[rng.randrange(len(w))] = "z" * rng.randint(1, 3)
                x = " ".join(w)
            lines.append(x if rng.random() < .8 else "  " + x.upper())
        lines.insert(rng.randint(0, len(lines)), "short")
        rows.append((d, "\n".join(lines), d))
    rows += [(90, None, 0), (91, "", 0), (92, "\n\n", 0), (None, pool[0], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line_no int")
    flat = [((d, n), x) for d, t, _ in rows if d is not None and t for n, x in enumerate(t.split("\n"))
            if len(x.strip()) >= 32]
    sets = [grams(x) for _, x in flat]
    comp = list(range(len(flat)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    links = borderline = 0
    for i in range(len(flat)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            sim = common / len(sets[i] | sets[j])
            if sim >= .8:
                links += 1
                borderline += sim < .9
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    first = {}
    for k, (where, _) in enumerate(flat):
        first.setdefault(root(k), []).append(where)
    want = {w: min(ws) for ws in first.values() for w in ws if w != min(ws)}
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no) for r in L.duplicate_lines(docs, min_chars=32).collect()}
    assert links > 50 and set(got) <= set(want)
    assert len(got) >= .98 * len(want)                    # banding may miss a pair near the threshold
    out = {r.doc_id: r.text for r in L.dedup_lines(docs, min_chars=32).collect()}
    assert out[90] is None and out[91] == "" and out[92] == "\n\n"
    assert out[None] == ""                                # the row without an id is last in ties
    for d, t, _ in rows[:40]:
        keep = [x for n, x in enumerate(t.split("\n")) if (d, n) not in got]
        assert out[d] == "\n".join(keep) and "short" in keep
    assert L.dedup_lines(docs).columns == docs.columns
    assert L.duplicate_lines(docs.limit(0)).count() == 0


def test_short_lines_are_deduplicated(spark):
    """With min_chars=0 no line that holds a word is skipped, whatever its length."""
    rng = random.Random(19)
    rows = []
    for d in range(30):
        lines = [prose(rng, 30), "All rights reserved.", "  ALL  rights Reserved. ", "", " \t", "}", f"n{d}"]
        if d % 2:
            lines.append("Released under the MIT License." if d % 4 == 1 else "Released under the MIT License")
        rng.shuffle(lines)
        rows.append((d, "\n".join(lines)))
    rows += [(50, "ab"), (51, "ab\0\0\0\0"), (52, "Home\nHome"), (53, "Contents of the chapter, p. 17.."),
             (54, "Contents of the chapter, p. 17."), (None, "}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    flat = [((d, n), x) for d, t in rows if d is not None for n, x in enumerate(t.split("\n")) if x.strip()]
    sets = [grams(x) for _, x in flat]
    comp = list(range(len(flat)))
    for i in range(len(flat)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= .8 * len(sets[i] | sets[j]):
                a, b = sorted((comp[i], comp[j]))
                comp = [a if c == b else c for c in comp]
    first = {}
    for k, (where, _) in enumerate(flat):
        first.setdefault(comp[k], []).append(where)
    want = {w: min(ws) for ws in first.values() for w in ws if w != min(ws)}
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no)
           for r in L.duplicate_lines(docs, min_chars=0).collect()}
    assert got == want and (52, 1) in got and (54, 0) in got and len(got) > 100
    out = {r.doc_id: r.text for r in L.dedup_lines(docs, min_chars=0).collect()}
    assert sum("reserved." in t.lower() for t in out.values()) == 1
    assert out[50] == "ab" and out[51] == "ab\0\0\0\0" and out[None] == ""       # a row without an id is last in ties
    assert all("\n\n" in f"\n{out[d]}\n" for d in range(30))        # blank lines stay
    left = {r.doc_id for r in L.dedup_lines(docs, min_chars=0, drop_emptied=True).collect()}
    assert not {54, None} & left and {0, 50, 52, 53} <= left


def test_op9_and_the_pipeline_treat_short_lines(spark, tmp_path):
    import corpus_pipeline as C
    from verdant.llm import queries
    rows = [(i, f"{prose(random.Random(i), 60)}\nAll rights reserved.", "en", "s", 1) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.op9_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {(i, 1, 0, 1) for i in range(1, 4)}
    kept = C.lines(spark, docs, str(tmp_path)).collect()
    assert len(kept) == 4 and sum("reserved" in r.text for r in kept) == 1


def test_minhash_recall_at_threshold():
    """Bands of pairs at a similarity of about 0.8 to 0.85 meet."""
    rng, met, pairs = random.Random(1), 0, 0
    while pairs < 150:
        a = prose(rng, 40)
        w = a.split()
        for _ in range(rng.randint(2, 4)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        b = " ".join(w)
        sim = len(grams(a) & grams(b)) / len(grams(a) | grams(b))
        if .8 <= sim < .85:
            pairs += 1
            keys = L.band_keys([a, b])
            met += bool((keys[0] == keys[1]).any())
    assert met >= .95 * pairs


# --- 3: decontamination

def edit(a, b):
    """Least word edits from a to any passage of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_decontamination_recall_and_precision(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.choice([6, 12, 30, 55])).capitalize() + ".") for i in range(25)]
    rows = []
    for d in range(160):
        w = prose(rng, rng.randint(5, 120)).split()
        if d % 2:
            leak = items[rng.randrange(25)][1].split()
            for _ in range(rng.randint(0, int(.25 * len(leak)))):
                k, op = rng.randrange(len(leak)), rng.random()
                if op < .4:
                    leak[k] = "zzz"
                elif op < .7:
                    leak.insert(k, "yyy")
                elif len(leak) > 1:
                    del leak[k]
            at = rng.randint(0, len(w))
            w = w[:at] + leak + w[at:]
        rows.append((d, " ".join(w)))
    rows += [(900, None), (901, ""), (902, "..., !!!"), (None, items[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items + [(77, None), (78, "the a"), (None, "x y z u v w")], "item_id long, text string")
    want = set()
    for d, t in rows:
        if d is not None:
            for i, x in items:
                a = D.words_of(x)
                if edit(a, D.words_of(t)) <= int(.2 * len(a)):
                    want.add((d, i))
    found = D.find_leaks(docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= want and len(got) >= .95 * len(want) and len(want) > 50
    text = dict(rows)
    for r in found:
        assert edit(D.words_of(dict(items)[r.item_id]), D.words_of(text[r.doc_id][r.start:r.end])) == r.distance
    # blocks give the same
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(docs, bench, block_chars=900).collect()} == got
    left = {r.doc_id for r in D.decontaminate(docs, bench).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in got}
    assert D.find_leaks(docs.limit(0), bench).count() == 0 and D.find_leaks(docs, bench.limit(0)).count() == 0


def test_exact_leaks_are_all_found(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, 5 + i)) for i in range(40)]
    docs = spark.createDataFrame([(i, prose(rng, 30) + " " + t + " " + prose(rng, 30)) for i, t in items],
                                 "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in D.find_leaks(
        docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(i, i, 0) for i, _ in items} <= got


def test_short_items_are_searched(spark):
    """Items that allow no edit are met by their very words."""
    bench = spark.createDataFrame([(1, "Zyx wvu, tsr qpo!"), (2, "lonely"), (3, "..."), (4, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b zyx wvu tsr qpo c"), (2, "a zyx wvu tsr c"), (3, "so Lonely."), (4, None), (5, "... a")],
                                 "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.distance) for r in D.find_leaks(docs, bench).collect()) == [(1, 1, 0), (3, 2, 0)]
    assert sorted(r.doc_id for r in D.decontaminate(docs, bench, min_words=2).collect()) == [2, 3, 4, 5]


# --- 6: secret scan

def base_spans(t):
    out = []
    for k, (rx, least, group) in enumerate((
            (r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
            (r"AKIA[A-Z0-9]+", 20, 0), (r"[0-9a-f]+", 24, 0))):
        out += [(m.start(), k, m.end()) for m in re.finditer(rx, t or "") if len(m[group]) >= least]
    return sorted(out)


def test_secret_scan(spark):
    rng = random.Random(6)
    parts = ["password=abc", "PassWord = 'hunter2hunter2'", "api_key:\"ZZtop123\"", "apikey==x", "token=token:abcdefgh",
             "AKIA" + "Q" * 16, "AKIA" + "Q" * 15, "AKIAAKIA" + "Z" * 14, "0123456789abcdef01234567", "deadbeef" * 8,
             "a" * 23, "secret\x20\x20:\x20é", "ſecret=abcdefgh", "toKen=abcdefgh", "ghp_" + "a1" * 20,
             "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.abc", "https://u:p@host/", "xoxb-123456789012"]
    rows = [(i, " ".join(rng.choice(parts + [prose(rng, 3), "𝄞ä\n"]) for _ in range(rng.randint(0, 30)))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "token=abcdefgh"), (502, "x" * 200_000 + " " + "f" * 30)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")
    kinds = ["assign", "access", "hex"]
    got = {r.doc_id: r for r in S.scan(docs).collect()}
    assert len(got) == len(rows)
    rules = [*S.BASE, *S.MORE]
    for d, t in rows:
        want, r = base_spans(t), got[d]
        joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, x, _ in want) for k in range(3)]
        full = sorted((m.start(), k, m.end()) for k, x in enumerate(rules) for m in re.finditer(x.pattern, t or "")
                      if m.end(x.group) - m.start(x.group) >= x.least)
        assert r.spans == ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in full)
    assert S.scan(docs.limit(0)).count() == 0
    masked = S.redact(docs)
    assert masked.columns == docs.columns and {r.doc_id: r.text for r in masked.collect()}[None] == "*" * 14


def test_block_index_against_plain_search(monkeypatch):
    rng = random.Random(61)
    monkeypatch.setattr(S, "_CHUNK", 50)
    for _ in range(40):
        texts = ["".join(rng.choice("abcA𝄞é\n") for _ in range(rng.choice([0, 1, 2, 3, 30, 200]))) for _ in range(rng.randint(0, 8))]
        grams = sorted({"".join(rng.choice("abc") for _ in range(3)) for _ in range(rng.randint(0, 9))} | {"é\na"})
        index = S.BlockIndex(texts, grams)
        for g in grams:
            assert list(index.rows(g)) == [i for i, t in enumerate(texts) if g in t.lower()]


def test_logins_of_any_length(spark):
    user, word = "u" * 300, "p" * 500
    texts = [f"see https://{user}:{word}@host/ and", "9ab+c://u:p@h", "x://u:p@h", "a" * 300_000, "a1" * 100_000 + "://u:p@",
             "-----BEGIN " + "VERY " * 20 + "PRIVATE KEY-----"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in S.scan(docs, base=[]).collect()}
    assert got == {0: f"url_login:4:{4 + 8 + 300 + 1 + 500 + 1}", 1: "url_login:1:12", 2: "", 3: "",
                   4: f"url_login:0:{200_000 + 7}", 5: f"private_key:0:{len(texts[5])}"}


def test_trigram_queries():
    assert S.trigram_query("[0-9a-f]{24,}") == S.ALWAYS
    assert S.trigram_query("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    q = S.trigram_query(S.BASE[0].pattern)
    assert q != S.ALWAYS and any("tok" in c for c in q) and any("ecr" in c for c in q)
    assert S.trigram_query("(abc|de)f?") == S.ALWAYS or all(c for c in S.trigram_query("(abc|de)f?"))
    assert S.trigram_query("x(abc)+y") == [frozenset({"xab", "abc"})] or "abc" in set().union(*S.trigram_query("x(abc)+y"))


def _clashing(spark, rows):
    """Documents with columns named like the operators' own."""
    names = ["__id", "__gone", "__kept", "key", "doc", "rank", "left", "component_id", "kept", "unit", "lang"]
    return spark.createDataFrame([(i, t, *["en" if n == "lang" else n for n in names]) for i, t in rows],
                                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))


def test_rows_are_judged_by_their_own_text(spark):
    """Null and repeated ids, clashing names: every stage decides row by row."""
    rng = random.Random(23)
    fine = [prose(rng, 120) for _ in range(6)]
    spam = " ".join(["spam spam spam"] * 40)
    docs = _clashing(spark, [(1, fine[0]), (1, spam), (None, fine[1]), (None, spam), (2, None), (3, fine[2]), (3, fine[2])])
    got = Q.filter_documents(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted(
        [("1", fine[0]), ("None", fine[1]), ("3", fine[2]), ("3", fine[2])])
    assert {r["__id"] + r.key + r.doc for r in got.collect()} == {"__idkeydoc"}

    a, b, c = (prose(rng, 12) for _ in range(3))
    docs = _clashing(spark, [(1, f"{a}\n{b}"), (1, f"{b}\n{c}"), (None, f"{c}\n{a} z"), (5, None)])
    got = L.dedup_lines(docs)
    assert got.columns == docs.columns
    lines = sorted(x for r in got.collect() if r.text for x in r.text.split("\n") if x)
    kept = {x.removesuffix(" z") for x in lines}
    assert kept == {a, b, c} and len(lines) == 3                  # one of each stays, in the smallest row
    assert [r.text for r in got.collect() if r.doc_id is None] == [""]

    item = prose(rng, 30)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = _clashing(spark, [(1, f"{fine[3]} {item} {fine[4]}"), (1, fine[3]), (None, f"{fine[5]} {item}"), (None, fine[5]), (9, None)])
    got = D.decontaminate(docs, bench)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted([("1", fine[3]), ("None", fine[5]), ("9", None)], key=str)
