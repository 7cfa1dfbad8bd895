import random

import pytest

from pyspark.sql import functions as F

from verdant.operators import media as M
from verdant.operators import offers as O, reconcile as R
from verdant.operators.layers import OFFER_COLUMNS, attach_layer, replace_provenance

from helpers import rows

KEY = "canonical_taxon_id"


def spine(spark, data):
    return spark.createDataFrame(data, "canonical_taxon_id long, name_he string")


def test_exact_and_containment(spark):
    sp = spine(spark, [(5, "הדס מצוי"), (3, "הדס מצוי"), (7, "אלון מצוי"), (8, "אלון תבור"),
                       (9, "זית אירופי גדול"), (10, None), (11, "")])
    names = spark.createDataFrame([("הדס מצוי",), ("הָדָס  מצוי 3 ליטר",), ("הדס",), ("אלון",),
                                   ("זית גדול",), ("זית גדול גדול",), ("",), ("לא קיים",)], "name string")
    got = {r.name: (r[KEY], r.how) for r in O.match_names(names, sp).collect()}
    assert got["הדס מצוי"] == (3, "exact")                   # duplicate spine name: lowest key
    assert got["הָדָס  מצוי 3 ליטר"] == (3, "exact")          # marks and pot tokens removed
    assert got["הדס"] == (None, None)                        # two keys (3, 5) contain it
    assert got["אלון"] == (None, None)                       # 7 and 8
    assert got["זית גדול"] == (9, "genus_containment")
    assert got["זית גדול גדול"] == (9, "genus_containment")  # repeated token is one token
    assert got[""] == (None, None) and got["לא קיים"] == (None, None)


@pytest.mark.parametrize("vocabulary, longest", [(6, 5), (60, 40)])
def test_containment_equals_brute_force_at_every_length(spark, vocabulary, longest):
    rnd = random.Random(7)
    vocab = [f"t{i}" for i in range(vocabulary)]
    heads = vocab[:4]
    sp_rows = [(i, " ".join(dict.fromkeys([rnd.choice(heads), *rnd.sample(vocab, rnd.randint(0, longest - 1))])))
               for i in range(60)]
    q_rows = [(" ".join(dict.fromkeys([n.split()[0], *rnd.sample(n.split(), min(len(n.split()), rnd.randint(0, 30)))])),)
              for _, n in sp_rows] + [(" ".join(rnd.sample(vocab, rnd.randint(1, 3))),) for _ in range(80)]
    sp = spine(spark, sp_rows)
    q = spark.createDataFrame(q_rows, "name string")
    a = rows(O.match_names(q, sp), "name", KEY, "how")
    # brute force
    exact = {}
    for k, n in sp_rows:
        exact[n] = min(exact.get(n, k), k)
    for name, key, how in a:
        toks = name.split()
        if name in exact:
            assert (key, how) == (exact[name], "exact")
            continue
        hits = {k for k, n in sp_rows if n.split()[0] == toks[0] and set(toks) <= set(n.split())}
        assert (key, how) == ((next(iter(hits)), "genus_containment") if len(hits) == 1 else (None, None))


def test_frequent_tokens_meet_in_pairs(spark):
    """Long posting lists are split by a second token; the answers are the same."""
    rnd = random.Random(17)
    vocab = [f"t{i}" for i in range(9)]
    sp = spine(spark, [(i, "g " + " ".join(rnd.sample(vocab, rnd.randint(0, 8)))) for i in range(120)])
    idx = O.spine_index(sp)
    asked = {("g",), *(("g", *sorted(rnd.sample(vocab, rnd.randint(1, 7)))) for _ in range(150)), ("g", "t1", "zz"), ("h", "t1")}
    q = spark.createDataFrame([(" ".join(t), t[0], list(t[1:])) for t in asked], "n string, first string, rest array<string>")
    names = {r[KEY]: {r.first, *r.rest} for r in idx.collect()}
    want = sorted((" ".join(t), min(hits), max(hits)) for t in asked
                  if (hits := [k for k, have in names.items() if set(t) <= have]))
    for hot in (0, 20, 1 << 40):
        assert sorted(rows(O.containment_keys(q, idx, hot), "n", "_cmin", "_cmax")) == want


def test_long_forms_of_offers_and_conflicts(spark):
    m = spark.createDataFrame(
        [(1, 5.0, ["a", "a", "b"], None, "u"), (1, None, ["a"], "in_stock", "u"), (1, 3.0, None, "x", None), (None, 1.0, ["a"], "x", "w")],
        f"{KEY} long, price double, pot_sizes array<string>, availability string, url string")
    assert rows(O.offer_values(m), KEY, "kind", "value", "listings", "price_ils", "in_stock") == [
        (1, "size", "a", 2, 5.0, True), (1, "size", "b", 1, 5.0, False), (1, "url", "u", 2, 5.0, True)]
    prov = spark.createDataFrame([(1, "f", "x", "s2"), (1, "f", "x", "s1"), (1, "f", "y", "s3"), (1, "g", "x", "s1"),
                                  (2, "f", None, "s1"), (2, "f", "z", "s1"), (2, "f", "z", "s2")],
                                 f"{KEY} long, field string, value string, source string")
    got = rows(R.conflict_values(prov), KEY, "field", "value", "n_rows", "first_source")
    assert got == [(1, "f", "x", 2, "s1"), (1, "f", "y", 1, "s3")]
    assert {(r[KEY], r.field): r["values"] for r in R.conflicts(prov).collect()} == {(1, "f"): ["x", "y"]}


def test_offers_layer_no_orphans_idempotent(spark):
    sp = spine(spark, [(1, "הדס מצוי"), (2, "אלון מצוי")])
    offers = spark.createDataFrame([
        ("a", "הדס מצוי", "c", 50.0, ["3 ליטר"], "out_of_stock", "u1"),
        ("b", "הדס מצוי", "c", 30.0, ["קוטר 17", "3 ליטר"], None, "u2"),
        ("c", "הדס מצוי", "c", None, [], "in_stock", "u1"),
        ("d", "ורד", "c", 10.0, [], "in_stock", "u3")],
        "source_id string, name_he string, category string, price double, pot_sizes array<string>, "
        "availability string, url string")
    m = O.match_offers(offers, sp)
    by = {r[KEY]: r for r in O.offers_by_key(m, "azur").collect()}
    r = by[1]
    assert r.sold_by == ["azur"] and r.price_ils == 30.0 and r.price_band == "budget"
    assert r.availability == "in_stock" and r.pot_sizes == ["3 ליטר", "קוטר 17"]
    assert r.source_urls == ["u1", "u2"] and r.listings == 3 and r.conflict
    assert rows(O.unmatched(m), "source_id") == [("d",)]
    canon = sp.withColumn("x", F.lit(1))
    once = attach_layer(canon, O.offers_by_key(m, "azur"), OFFER_COLUMNS)
    twice = attach_layer(once, O.offers_by_key(m, "azur"), OFFER_COLUMNS)
    assert once.count() == canon.count() == 2
    assert rows(once) == rows(twice)
    prov = O.offer_provenance(m, "azur")
    assert prov.count() == 3 + 2 + 3 + 3 + 3   # sold_by, prices, sizes, availability, method
    base = spark.createDataFrame([(1, "family", "F", "gbif", 90)], prov.schema)
    p1 = replace_provenance(base, prov, source="azur")
    p2 = replace_provenance(p1, prov, source="azur")
    assert rows(p1) == rows(p2)


def test_media_preferences(spark):
    """All 8 presence combinations of (photo, illustration, occurrence)."""
    keys, pairs, files, occ = [], [], [], []
    for i in range(8):
        photo, illu, gb = bool(i & 1), bool(i & 2), bool(i & 4)
        name = f"Genus sp{i} Auth."
        keys.append((i, name))
        if photo or illu:
            fn = f"G_sp{i}" + ("_drawing" if illu else "") + ".jpg"
            pairs.append((f"Genus sp{i}", "http://x/wiki/Special:FilePath/" + fn.replace("_", "%5F")))
            files.append(("File:" + fn, [("http://t/" + fn, None, "http://p/" + fn,
                                          (("CC",), ("<a>&amp;Me</a>",)))]))
        if gb:
            occ.append((i, ("ts", 0), "http://o/r", 0, "http://m/" + str(i), "CC0", "", "cr"))
    sp = spark.createDataFrame(keys, "canonical_taxon_id long, scientific_name string")
    pairs_df = spark.createDataFrame(pairs, "n string, img string")
    files_df = spark.createDataFrame(files, "title string, imageinfo array<struct<thumburl:string,url:string,"
                                     "descriptionurl:string,extmetadata:struct<LicenseShortName:struct<value:string>,"
                                     "Artist:struct<value:string>>>>")
    occ_df = spark.createDataFrame(occ, "taxon_key long, occ_order struct<a:string,b:int>, references string, "
                                   "media_pos int, identifier string, license string, rightsHolder string, "
                                   "creator string")
    got = {r[KEY]: r for r in M.pick_media(sp, pairs_df, files_df, occ_df).collect()}
    for i in range(8):
        photo, illu, gb = bool(i & 1), bool(i & 2), bool(i & 4)
        if not (photo or illu or gb):
            assert i not in got
            continue
        r = got[i]
        # one file per name: a drawing file name marks the only candidate as illustration
        if (photo or illu) and not illu:
            assert r.source == "wikimedia" and r.thumb.startswith("https://t/") and r.credit == "&Me"
        elif gb:
            assert r.source == "gbif" and r.thumb == f"https://m/{i}" and r.credit == "cr"
        else:
            assert r.source == "wikimedia" and r.illustration
    cov = M.media_coverage(sp, M.pick_media(sp, pairs_df, files_df, occ_df)).first()
    assert cov.total == 8 and cov.have == 7


def test_occurrence_limit(spark):
    occ = [(1, (k,), f"r{k}", 0, None, None, None, "c") for k in range(5)]
    occ += [(1, (5,), "r5", 0, "http://late", "L", None, "c"),
            (2, (0,), "q0", 0, None, None, None, "c"), (2, (1,), "q1", 1, "http://b", "L", "rh", "c"),
            (2, (1,), "q1", 0, "http://a", "L", "rh", "c")]
    df = spark.createDataFrame(occ, "taxon_key long, occ_order struct<p:int>, references string, media_pos int, "
                               "identifier string, license string, rightsHolder string, creator string")
    got = {r[KEY]: r.thumb for r in M.occurrence_media(df, limit=5).collect()}
    assert got == {2: "https://a"}          # key 1's media sits in its 6th occurrence
    got = {r[KEY]: r.thumb for r in M.occurrence_media(df).collect()}
    assert got == {1: "https://late", 2: "https://a"}


def test_media_edge_rows(spark):
    """Two records of one file, an empty thumb, a key without a name."""
    sp = spark.createDataFrame([(1, "Rosa canina L."), (2, None), (3, "Olea europaea")],
                               "canonical_taxon_id long, scientific_name string")
    pairs = spark.createDataFrame([("Rosa canina", "http://x/wiki/Special:FilePath/R.jpg"), ("Olea europaea", "http://x/wiki/Special:FilePath/O.jpg")],
                                  "n string, img string")
    ext = (("CC",), ("me",))
    files = spark.createDataFrame([("File:R.jpg", [("http://t/2.jpg", None, "p", ext)]),
                                   ("File:R.jpg", [("http://t/1.jpg", None, "p", ext)]),
                                   ("File:O.jpg", [("", "http://u/o.jpg", "p", ext)])],
                                  "title string, imageinfo array<struct<thumburl:string,url:string,descriptionurl:string,"
                                  "extmetadata:struct<LicenseShortName:struct<value:string>,Artist:struct<value:string>>>>")
    occ = spark.createDataFrame([(2, (0,), "r", 0, "http://occ", "L", None, "c")],
                                "taxon_key long, occ_order struct<p:int>, references string, media_pos int, "
                                "identifier string, license string, rightsHolder string, creator string")
    got = sorted((r[KEY], r.thumb) for r in M.pick_media(sp, pairs, files, occ).collect())
    assert got == [(1, "https://t/1.jpg"), (2, "https://occ"), (3, "https://u/o.jpg")]


def test_underscore_titles_flag(spark):
    sp = spark.createDataFrame([(1, "Rosa canina L.")], "canonical_taxon_id long, scientific_name string")
    pairs = spark.createDataFrame([("Rosa canina", "http://x/wiki/Special:FilePath/Rosa_canina.jpg")],
                                  "n string, img string")
    files = spark.createDataFrame([("File:Rosa canina.jpg", [("http://t/r.jpg", None, "p", (("CC",), ("me",)))])],
                                  "title string, imageinfo array<struct<thumburl:string,url:string,"
                                  "descriptionurl:string,extmetadata:struct<LicenseShortName:struct<value:string>,"
                                  "Artist:struct<value:string>>>>")
    occ = spark.createDataFrame([], "taxon_key long, occ_order struct<p:int>, references string, media_pos int, "
                                "identifier string, license string, rightsHolder string, creator string")
    assert M.pick_media(sp, pairs, files, occ).count() == 0          # parity: exact title match
    assert M.pick_media(sp, pairs, files, occ, normalize_underscores=True).first().thumb == "https://t/r.jpg"


def test_hot_key_offers_and_reconcile(spark):
    """One key holds a third of all offers: results stay whole and exact."""
    sp = spine(spark, [(1, "הדס"), (2, "אלון"), (3, "זית")])
    data = []
    for i in range(3000):
        name = "הדס" if i % 3 == 0 else ("אלון" if i % 3 == 1 else "זית")
        data.append((str(i), name, "c", float(i % 97 + 1), [f"{i % 7} ליטר"], "in_stock" if i % 5 else None,
                     f"u{i}"))
    offers = spark.createDataFrame(data, "source_id string, name_he string, category string, price double, "
                                   "pot_sizes array<string>, availability string, url string")
    by = {r[KEY]: r for r in O.offers_by_key(O.match_offers(offers, sp), "azur").collect()}
    assert by[1].listings == 1000 and len(by[1].source_urls) == 1000 and by[1].price_ils == 1.0
    assert len(by[1].pot_sizes) == 7
