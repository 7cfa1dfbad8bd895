"""Operators 1, 5, 7, 8 and 10: round trips, brute force and held-out accuracy."""
import math
import time
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from verdant.llm import html_main as H, language_id as LI, license_scan as LS, packing as P, quality_model as QM

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
LANGS = {"aa": "ka lo mi ta so ru ne pi".split(), "bb": "sch ein ung mit der kt pf zz".split(),
         "cc": "eau oux è ç ré lle tion qu".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


# --- 10: packing

def test_token_ids_equal_the_tokenizers_library():
    rng = random.Random(2)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", "a", " leading  spaces \n\n\ttabs\r\n", "don't I'll we've  x's", "äöü ß éèç ñ 中文字 𝄞 ​́ ｆｕｌｌ １２３",
             "<|endoftext|> in <|endoftext|>text", "x" * 5000, "1234567890" * 30, "!?.,;" * 50, "\x00\x01\x7f", "   a"]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x2FFF), rng.randint(0x1F300, 0x1F6FF)]))
                      for _ in range(rng.randint(1, 300))) for _ in range(150)]
    for t in texts:
        assert P.token_ids(t, PATH).tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1], t[:50]


def test_long_white_space_runs(spark):
    """Runs on which tiktoken's split pattern raises are encoded by tokenizers."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    blank = " " * 2_000_000
    rows = [(1, blank), (2, "a" + "\n" * 2_000_000 + "b <|endoftext|>"), (3, "plain text"), (4, "x \t" * 1000)]
    for _, t in rows:
        assert P.token_ids(t, PATH).tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1]
    with pytest.raises(ValueError):
        P.encoder(PATH).encode(blank)
    # under the limit both libraries give the same ids
    short = "a" + " " * 500_000 + "b"
    assert P.encoder(PATH).encode(short) == P.plain_encoder(PATH).encode(short, add_special_tokens=False).ids
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_packing(P.pack(docs, PATH).collect(), rows)


def check_packing(rows, docs_rows, capacity=2048):
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    seqs = {}
    for r in rows:
        assert 1 <= r.length and r.offset + r.length <= capacity
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
    counts = Counter(d for d, _ in docs_rows)
    for d, t in docs_rows:
        ids = P.token_ids(t, PATH)
        want = sorted((s, min(capacity, len(ids) - s), zlib.crc32(ids[s:s + capacity].tobytes()), len(ids))
                      for s in range(0, len(ids), capacity))
        got = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[d])
        assert got == sorted(want * counts[d])
    return seqs


def test_packing_covers_every_id_once(spark):
    rng = random.Random(10)
    rows = [(i, prose(rng, "aa", int(rng.paretovariate(.7) * 20) % 4000)) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "x"), (502, "x"), (503, prose(rng, "bb", 9000))]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, rank int")
    got = P.pack(docs, PATH, with_ids=True).collect()
    seqs = check_packing(got, rows)
    tokens = sum(n for parts in seqs.values() for _, n in parts)
    assert len(seqs) <= -(-tokens // 2048) + 2
    by = dict(rows)
    for r in got:
        assert r.ids == P.token_ids(by[r.doc_id], PATH)[r.start:r.start + r.length].astype(int).tolist()
    assert P.pack(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("lo, hi, n", [(100, 300, 4000), (150, 260, 3000), (1, 512, 9000), (257, 511, 500), (512, 513, 9)])
def test_patterns_use_each_piece_once(lo, hi, n):
    size = np.random.RandomState(lo).randint(lo, hi, n)
    demand = dict(Counter(size.tolist()))
    patterns = P.solve(demand, 512)
    used = Counter()
    for pattern, times in patterns:
        assert sum(k * c for k, c in pattern.items()) <= 512 and times > 0
        for k, c in pattern.items():
            used[k] += c * times
    assert used == Counter(demand)
    total = sum(t for _, t in patterns)
    # first-fit decreasing for comparison
    room = []
    for s in sorted(size, reverse=True):
        for i, r in enumerate(room):
            if r >= s:
                room[i] -= s
                break
        else:
            room.append(512 - s)
    assert total <= 1.01 * len(room) + 1


# --- 7: language identification

def test_language_id_held_out_accuracy(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        lang = rng.choice(list(LANGS))
        rows.append((i, prose(rng, lang, rng.randint(3, 60)).title() + ".", lang, "s"))
    rows += [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "123 ... !!", "bb", "s"), (903, prose(rng, "cc", 9), None, "s"),
             (None, prose(rng, "bb", 20), "bb", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = LI.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, _, lang, _ in rows[:400]:
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [r for r in rows[:400] if by[r[0]].held_out]
    assert len(held) > 50 and sum(by[r[0]].lang_pred == r[2] for r in held) >= .97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[903].lang_pred == "cc"
    assert LI.identify(docs.limit(0)).count() == 0
    nothing = LI.identify(docs.where("doc_id = 903")).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]


def test_language_id_against_a_plain_scorer(spark):
    """Every word on its own, by the tables of the model, without any memory."""
    rng = random.Random(17)
    rows = [(i, prose(rng, lang := rng.choice(list(LANGS)), rng.randint(1, 40)), lang) for i in range(150)]
    rows += [(500 + i, " ".join("".join(rng.choice("abcdeéßאо") for _ in range(rng.randint(1, 9))) for _ in range(30)), "aa")
             for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = LI.fit(docs, max_words=120, max_grams=400)
    got = {r.doc_id: r for r in LI.predict(docs, model).collect()}
    assert len(model.words) == 120 and model.grams

    def logs(word):
        if word in model.words:
            return model.word_logs[model.words[word]].astype(float)
        marked = f" {word} "
        for n in LI.GRAM_SIZES:
            grams = [marked[i:i + n] for i in range(len(marked) - n + 1)]
            known = [model.gram_logs[model.grams[g]] for g in grams if g in model.grams]
            if known and 2 * len(known) >= len(grams):
                return np.mean(known, axis=0)
        return np.zeros(len(model.languages))

    for i, text, _ in rows:
        words = [w for w in (t.lower().strip(LI._OUTER) for t in text.split()) if any(c.isalpha() for c in w)]
        total = sum(map(logs, words))
        soft = np.exp((total - total.max()) * LI.EVIDENCE / max(len(words), LI.EVIDENCE))
        assert got[i].lang_pred == model.languages[int(np.argmax(total))], text
        assert abs(got[i].score - soft.max() / soft.sum()) < 1e-4


def test_language_id_learns_from_words_seen_once(spark):
    docs = spark.createDataFrame([(0, "alpha beta gamma", "aa"), (1, "delta epsilon zeta", "bb"), (7, "gamma", None), (8, "zeta", None)],
                                 "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in LI.identify(docs).collect()}
    assert got[7] == "aa" and got[8] == "bb"


def test_language_id_ignores_the_label_of_predicted_rows(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, l, 30), l) for i, l in enumerate(list(LANGS) * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = LI.fit(docs)
    wrong = docs.selectExpr("doc_id", "text", "'aa' AS lang")
    a = {r.doc_id: r.lang_pred for r in LI.predict(docs, model).collect()}
    assert a == {r.doc_id: r.lang_pred for r in LI.predict(wrong, model).collect()}


# --- 8: quality model

def test_interactions_in_linear_time_equal_all_pairs():
    rng = np.random.RandomState(0)
    size = QM.N_STATS + (1 << QM.WORD_BITS)
    m = QM.Machine(.5, .1, rng.normal(size=size).astype(np.float32), rng.normal(size=(size, 8)).astype(np.float32))
    ix = rng.choice(size, 30, replace=False).astype(np.int32)
    x = rng.normal(size=30).astype(np.float32)
    pairs = sum(float(m.factors[ix[i]] @ m.factors[ix[j]]) * x[i] * x[j] for i in range(30) for j in range(i))
    assert abs(m.margin(ix, x) - (.1 + float(m.linear[ix] @ x) + pairs)) < 1e-2


def test_quality_model_held_out(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(500):
        good = rng.random() < .7
        t = prose(rng, "aa", rng.randint(20, 80))
        if not good:
            t = rng.choice([" ".join([prose(rng, "aa", 3)] * 12), t.upper() + "!!", " ".join(w + "%%%" for w in t.split())])
        rows.append((i, t, "x", "s"))
        labels.append((i, int(good), 0))
    rows += [(900, None, "x", "s"), (901, "", "x", "s"), (None, "b", "x", "s")]
    labels += [(3, None, 0), (None, 1, 0), (5, 1, 0), (5, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in QM.score(docs, QM.fit(docs, lab)).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= .7) for r in got.values())
    held = [i for i in range(500) if got[i].held_out]
    assert sum(got[i].predicted == labels[i][1] for i in held) >= .9 * len(held)
    # the held-out labels are never read
    flipped = lab.selectExpr("doc_id", "CASE WHEN pmod(crc32(cast(cast(doc_id AS string) AS binary)), 4) = 2 "
                             "THEN 1 - quality ELSE quality END AS quality")
    again = {r.doc_id: r.score for r in QM.score(docs, QM.fit(docs, flipped)).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-6 for i in again)
    assert {r.score for r in QM.score(docs, QM.fit(docs, lab.limit(0))).collect()} == {.5}
    assert QM.score(docs.limit(0), QM.fit(docs.limit(0), lab)).count() == 0


# --- 5: main text

LONG = "The house of the river was old and it stood in the shade of a hill for as long as they had known it. " * 3


def page(article, **parts):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>"
            f"<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News &amp; more</a></li></ul></nav>"
            f"{parts.get('before', '')}<article>{article}</article>{parts.get('after', '')}"
            f"<footer>&copy; example &middot; {LONG}</footer></body></html>")


def test_main_text():
    text = page(f"<h1>Title&nbsp;one</h1><p>{LONG}</p><p>Short.</p><p>{LONG}<br>more &lt;b&gt; &#233;",
                before=f"<div class='ad'>{LONG}</div><div id='cookie-notice'><p>{LONG}</p></div>"
                       f"<aside><p>{LONG}</p></aside><form><p>{LONG}</p><input><textarea>x < y</textarea></form>",
                after=f"<section class=\"comments\"><p>{LONG}</p></section>")
    long = LONG.strip()
    assert H.main_text(text) == "\n\n".join(["Title one", long, "Short.", long + " more <b> é"])
    # a page of short lines keeps them
    assert H.main_text(page("<p>Hi.</p><p>Ho.</p>")) == "Hi.\n\nHo."
    # links inside the article
    assert H.main_text(page(f"<p>{LONG}</p><p><a href='x'>{LONG}</a></p>")) == long
    # no article element: densities decide
    plain = f"<body><div><a href=1>One</a> <a href=2>Two</a></div><div>{LONG}</div><div>Yes.</div><div>{LONG}</div></body>"
    assert H.main_text(plain) == "\n\n".join([long, "Yes.", long])
    for broken in ("", None, "<", "<p", "plain", "<article><p>x", "</p></div>", "<!-- open", "<script>x", "&am", "<a <b>>"):
        assert isinstance(H.main_text(broken), str)
    assert H.main_text("<article><p>" + "a b " * 200_000 + "</p></article>").count("a") == 200_000
    assert H.main_text("<article>" + "<div>" * 3000 + LONG + "</article>") == long


def test_hint_words_count_as_whole_tokens():
    long = LONG.strip()
    for attr in ("class='has-sidebar'", "class='no-sidebar x'", "class='with-comments'", "class='legal-news'",
                 "class='social-issues'", "class='search-page'", "id='related-work'", "id=page-search"):
        assert H.main_text(f"<body><div {attr}><p>{LONG}</p></div></body>") == long, attr
    for attr in ("class='sidebar'", "class='x sidebar-1'", "class='site-footer'", "id='cookie-notice'", "class='ad-300x250'",
                 "class='main-nav'", "class='comment-body'", "class='related-posts'", "class='social_links'",
                 "class='sidebar__inner'", "id=newsletter-form", "class='legal-notice'"):
        assert H.main_text(f"<body><p>{LONG}</p><div {attr}><p>{LONG}</p></div></body>") == long, attr


def test_article_inside_a_hinted_wrapper():
    long = LONG.strip()
    for tag in ("article", "main"):
        inside = f"<div class='overlay'><p>{LONG}</p><{tag}><p>{LONG}</p></{tag}><p>{LONG}</p></div>"
        assert H.main_text(f"<body>{inside}</body>") == long
        # not in boilerplate elements, and not where the article itself is a comment
        assert H.main_text(f"<body><aside><{tag}><p>{LONG}</p></{tag}></aside></body>") == ""
    comment = f"<div class='comments'><article class='comment-body'><p>{LONG}</p></article></div>"
    assert H.main_text(f"<body><article><p>{LONG}</p></article>{comment}</body>") == long
    # a hinted block inside the article stays out, and so does what follows the wrapper's article
    assert H.main_text(f"<div class='modal'><main><p>{LONG}</p><div class='share'>{LONG}</div></main>{LONG}</div>") == long


def test_head_without_an_end_tag():
    long = LONG.strip()
    for start in ("<head><title>x</title><body>", "<html><head><title>x</title><meta charset=utf-8><script>a<b</script>",
                  "<head><noscript><img src=x></noscript><title>x</title><body>", "<title>x</title>", "<head><title>x<body>",
                  "<head><title>x</title></head><body>"):
        assert H.main_text(f"{start}<p>{LONG}</p>") == long, start
    assert H.main_text(f"<head><title>x</title>{LONG}") == long


def test_formulas_are_text():
    math = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x^2</annotation></semantics></math>"
    assert H.main_text(f"<article><p>{LONG} where {math} holds.</p></article>") == f"{LONG.strip()} where x=2 holds."


def test_extract_query_rows(spark):
    pages = spark.createDataFrame([(1, "u", page(f"<p>{LONG}</p>"), "t"), (2, None, None, "t"), (2, None, "", "t"), (None, "v", "<p>", "t")],
                                  "page_id long, url string, html string, text string")
    got = H.extract(pages).collect()
    assert len(got) == 4 and sorted(r.n_chars for r in got) == [0, 0, 0, len(LONG.strip())]
    assert all(r.n_chars == len(r.text) for r in got)
    assert H.extract(pages.limit(0)).count() == 0


# --- 1: licences

def test_license_scan_and_inheritance(spark):
    rng = random.Random(1)
    mit = LS.TEMPLATES["MIT"][3]
    rows = [
        (1, "a/b/x.txt", prose(rng, "aa", 40) + "\nReleased under the MIT License.\n" + prose(rng, "aa", 40)),
        (2, "a/LICENSE", mit), (3, "a/b/y.txt", prose(rng, "aa", 50)), (4, "a/b/c/d/z.txt", prose(rng, "aa", 50)),
        (5, "LICENSE.md", "Licensed under the Apache License, Version 2.0."), (6, "q/r.txt", prose(rng, "bb", 10)),
        (7, "top.txt", None), (8, None, prose(rng, "bb", 10)), (9, "a/b/c/COPYING", prose(rng, "cc", 30)),
        (10, "a/b/c/e.txt", ""), (11, "s/t.txt", "# Licensed under  CC BY-NC 4.0"), (None, "a/n.txt", "x"),
        (12, "licence/x.txt", "the license of the house and the public version of it"),
    ]
    files = spark.createDataFrame([(*r, "o") for r in rows], "doc_id long, path string, text string, origin string")
    got = {r.doc_id: (r.license, r.via, r.origin) for r in LS.scan(files).collect()}
    assert len(got) == len(rows)
    assert got[1] == ("MIT", "header", None) and got[2] == ("MIT", "file", None)
    assert got[3] == ("MIT", "inherited", "a") and got[4] == ("MIT", "inherited", "a")
    assert got[5] == ("Apache-2.0", "file", None) and got[6] == ("Apache-2.0", "inherited", "")
    assert got[7] == ("Apache-2.0", "inherited", "") and got[8] == (None, "none", None)
    assert got[9] == ("MIT", "inherited", "a") and got[10] == ("MIT", "inherited", "a")
    assert got[11] == ("CC-BY-NC-4.0", "header", None) and got[None] == ("MIT", "inherited", "a")
    assert got[12][1] == "inherited"
    assert LS.scan(files.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the given tables are not there")
def test_op1_runs_the_whole_method_on_the_given_tables(spark):
    from verdant.llm.queries import op1_license_scan
    got = op1_license_scan(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    assert {r.via for r in got} == {"file", "header", "inherited", "none"}
    given = {}
    for r in got:
        if r.via == "file":
            given.setdefault(r.path.rpartition("/")[0], set()).add(r.license)
    steps = Counter()
    for r in got:
        folder = r.path.rpartition("/")[0].split("/")
        up = ["/".join(folder[:k]) for k in range(len(folder), 0, -1)]
        nearest = next((d for d in up if d in given), None)
        if r.via in ("inherited", "none"):
            assert r.origin == nearest and (nearest is None or r.license in given[nearest])
            steps[nearest and up.index(nearest)] += 1
    assert all(steps[k] for k in (0, 1, 2, None)), steps


def test_leading_terms_lose_no_match():
    rng = random.Random(3)
    vocabulary = sorted({t for v in LS.TEMPLATES.values() for x in v for t in LS.terms(x)})
    df = {t: rng.randint(0, 500) for t in vocabulary}
    m = LS.Matcher(LS.TEMPLATES, df, 1000, .55)
    full = LS.Matcher(LS.TEMPLATES, df, 1000, .55)
    full.leading = set(vocabulary)
    hits = 0
    for _ in range(2000):
        w = rng.sample(vocabulary, rng.randint(1, 12)) + LS.terms(rng.choice(rng.choice(list(LS.TEMPLATES.values()))))[:rng.randint(0, 9)]
        a, b = m.best(w), full.best(w)
        assert a == b
        hits += a is not None
    assert hits > 50


def _cosine(matcher, found, template):
    """Plain cosine of two term lists."""
    a, b = matcher.weights(Counter(found)), matcher.weights(Counter(template))
    return sum(w * b.get(t, 0) for t, w in a.items()) / math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))


def test_passages_against_brute_force():
    """Every window of a long template's length, wherever it stands in the text."""
    rng = random.Random(31)
    vocabulary = sorted({t for v in LS.TEMPLATES.values() for x in v for t in LS.terms(x)})
    m = LS.Matcher(LS.TEMPLATES, {t: rng.randint(0, 900) for t in vocabulary}, 1000, .55)
    long = [(name, t) for name, v in LS.TEMPLATES.items() for t in map(LS.terms, v) if len(t) >= LS.PASSAGE]
    hits = 0
    for _ in range(25):
        found = [rng.choice(vocabulary + ["filler"] * 300) for _ in range(rng.randint(0, 80))]
        for name, t in rng.sample(long, rng.randint(0, 2)):
            found += [x for x in t if rng.random() > .2] + [rng.choice(["filler", "x"]) for _ in range(30)]
        want = [(-round(_cosine(m, found[i:i + len(t)], t), 6), name, i) for name, t in long
                for i in range(max(len(found) - len(t), 0) + 1) if found]
        want = [w for w in want if -w[0] >= .55]
        got = m.best_passage(found)
        assert (got is None) == (not want)
        if want:
            assert abs(got[0] + min(want)[0]) < 2e-6
            hits += 1
    assert hits > 10


def test_licence_passage_far_into_a_text(spark):
    """A wrapped licence behind a long preamble, and in the head of an ordinary file."""
    rng = random.Random(32)
    words = LS.TEMPLATES["MIT"][3].split()
    wrapped = "\n".join(" * " + " ".join(words[i:i + 3]) for i in range(0, len(words), 3))
    rows = [(1, "a/LICENSE", prose(rng, "bb", 3000) + "\n" + wrapped + "\n" + prose(rng, "bb", 500)),
            (2, "b/x.c", wrapped + "\n" + prose(rng, "bb", 300)), (3, "a/y.txt", prose(rng, "bb", 40)), (4, "c/z", "\n\n")]
    got = {r.doc_id: (r.license, r.via) for r in LS.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got == {1: ("MIT", "file"), 2: ("MIT", "header"), 3: ("MIT", "inherited"), 4: (None, "none")}


# --- 5: pages as they are found

_LONG = ("This is a long enough paragraph of the article and it has many stop words in it, so that the first pass of the "
         "rules is able to decide that it is good text and not a part of the menu. It goes on for a while after that.")


@pytest.mark.parametrize("page, text", [
    # a form around the page is no container, a form in it is
    ('<form id="aspnetForm"><nav><a href=x>Home</a></nav><main><article><p>%s</p></article></main></form>', "%s"),
    ('<article><p>%s</p></article><form class="login"><label>Your name</label><input name=x></form>', "%s"),
    # linked headings and prose of an article; a paragraph that is one link goes
    ('<article><h1><a href=x>Title</a></h1><p>%s</p><p>See <a href=x>the long linked words</a> now</p><p><a href=x>More</a></p></article>',
     "Title\n\n%s\n\nSee the long linked words now"),
    ('<nav><a href=x>Home</a></nav><h1><a href=x>Title</a></h1><p>%s</p>', "Title\n\n%s"),
    ('<article><p>%s</p><aside class="pull-quote">A quote</aside><aside>Beside it</aside></article>', "%s\n\nA quote"),
    ('<article><p>%s</p><p>The symbol © was first used in 1802</p><p>© 2020 Site</p></article>',
     "%s\n\nThe symbol © was first used in 1802"),
    # markup: an open video hides nothing, a closed one does; a stray quote in a value is no text
    ("<article><video src=x><p>%s</p></article>", "%s"),
    ("<article><video src=x>no video</video><p>%s</p></article>", "%s"),
    ("<article><p title=don't>%s</p><p>it's</p></article>", "%s\n\nit's"),
    ('<article><p title="a > b">%s</p></article>', "%s"),
])
def test_pages_as_they_are_found(page, text):
    assert H.main_text(page % _LONG) == text.replace("%s", _LONG)


def test_very_long_pages_take_one_pass():
    n = 60_000
    start = time.process_time()
    assert H.main_text("<article>" + "<p>x</p>" * n + "</article>").count("x") == n
    H.main_text("<div>" * n + "</x>" * n + "<video>" * n)
    H.main_text('<a b="x>" c=' * n + "y")
    assert time.process_time() - start < 30
