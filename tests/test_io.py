import json
import os
import tempfile

from verdant.operators.matcher import match_names_fuzzy
from verdant.operators.status import curated_names
from verdant.plans import publish as P
from verdant.sources import sitemap as SM
from verdant.sources import snapshots as SN
from verdant.streaming.snapshots import stage_new_snapshots

from helpers import rows


def _write_snap(d, date, sid, fields):
    os.makedirs(os.path.join(d, date), exist_ok=True)
    rec = {"source": "wildflowers", "source_id": sid, "url": "u", "scraped_at": date,
           "name_he": fields.get("he"), "name_lat": fields.get("lat"), "fields": fields}
    with open(os.path.join(d, date, f"plant_{sid}.json"), "w", encoding="utf-8") as f:
        json.dump(rec, f, ensure_ascii=False, indent=2)


def test_snapshot_reader_and_versions(spark):
    d = tempfile.mkdtemp(prefix="verdant-test-")
    raw = os.path.join(d, "raw")
    _write_snap(raw, "2026-06-25", "1", {"he": "תאנה", "lat": "Ficus carica", "x": "1"})
    _write_snap(raw, "2026-06-26", "2", {"lat": "Olea"})
    recs = SN.read_records(spark, raw + "/*/plant_*.json")
    assert sorted(r.source_id for r in recs.collect()) == ["1", "2"]
    assert recs.where("source_id = '1'").first().fields["x"] == "1"
    base = os.path.join(d, "pub")
    v1 = P.write_version(recs.drop("path"), base, "records", version="1")
    v2 = P.write_version(recs.drop("path").where("source_id = '1'"), base, "records", version="2")
    assert P.current_path(spark, base, "records") == v2
    assert P.read_current(spark, base, "records").count() == 1
    assert spark.read.parquet(v1).count() == 2       # the old version stays readable


def test_stream_stages_only_new_files(spark):
    d = tempfile.mkdtemp(prefix="verdant-test-")
    raw, eav, ck = (os.path.join(d, x) for x in ("raw", "eav", "ck"))
    _write_snap(raw, "2026-06-25", "1", {"he": "a", "lat": "A b", "k": "v"})
    stage_new_snapshots(spark, raw, eav, ck).awaitTermination()
    assert spark.read.parquet(eav).count() == 3
    _write_snap(raw, "2026-06-26", "2", {"lat": "C d"})
    stage_new_snapshots(spark, raw, eav, ck).awaitTermination()
    df = spark.read.parquet(eav)
    assert df.count() == 4 and sorted(r.source_id for r in df.select("source_id").distinct().collect()) == ["1", "2"]


def test_curated_list_and_sitemap(spark):
    d = tempfile.mkdtemp(prefix="verdant-test-")
    p = os.path.join(d, "list.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("name_lat,note\nAcacia saligna,x, y\n\n\t\n  Ailanthus altissima ,z\nAcacia saligna,dup\n")
    names = curated_names(SN.read_list_lines(spark, p))
    assert rows(names) == [("Acacia saligna",), ("Ailanthus altissima",)]
    xml = spark.createDataFrame([("<loc>https://s.co/%D7%97%D7%A0%D7%95%D7%AA/%D7%A2%D7%A6%D7%99%D7%9D/a+b/</loc>"
                                  "<loc>https://s.co/%D7%97%D7%A0%D7%95%D7%AA/pots/x/</loc>"
                                  "<loc>https://s.co/%D7%97%D7%A0%D7%95%D7%AA/%D7%A2%D7%A6%D7%99%D7%9D</loc>",)],
                                "value string")
    got = SM.products_from_urls(SM.sitemap_urls(xml)).collect()
    assert [(r.category, r.slug) for r in got] == [("עצים", "a+b")]


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_fuzzy_matcher_equals_brute_force(spark):
    import random
    rnd = random.Random(11)
    letters = "abcde"
    back = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(3, 7))) + " x" for _ in range(40)})
    qs = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))) + rnd.choice([" x", " y"])
                 for _ in range(60)})
    bdf = spark.createDataFrame([(n, i) for i, n in enumerate(back)], "name string, key long")
    got = {r.input_name: r for r in match_names_fuzzy(spark.createDataFrame([(q,) for q in qs], "input_name string"),
                                                        bdf).collect()}
    for q in qs:
        cands = sorted((_lev(q, b), b, i) for i, b in enumerate(back) if _lev(q, b) <= 2)
        r = got[q]
        if cands:
            d, b, i = cands[0]
            assert (r.distance, r.matched_name, r.key) == (d, b, i)
            assert r.matchType == ("EXACT" if d == 0 else "FUZZY")
        elif q.split()[0] in {b.split()[0] for b in back}:
            assert r.matchType == "HIGHERRANK"
        else:
            assert r.matchType == "NONE" and r.confidence == 0


def test_names_of_a_large_genus_meet_by_two_segments(spark):
    import random
    from pyspark.sql import functions as F
    from verdant.operators.matcher import probes, segments
    rnd = random.Random(5)
    back = sorted({"rhododendron " + "".join(rnd.choice("abcdefghijklmnop") for _ in range(12)) for _ in range(300)})
    qs = sorted({b[:14] + "zz" + b[16:] for b in back[::3]} | {b[:13] + b[14:] + "q" for b in back[1::3]})
    b = spark.createDataFrame([(x,) for x in back], "b string").select("b", F.explode(segments("b", 2)).alias("p"))
    q = spark.createDataFrame([(x,) for x in qs], "q string").select("q", F.explode(probes("q", 2)).alias("p"))
    assert q.groupBy("q").count().agg(F.max("count")).first()[0] <= 150
    met = {(r.q, r.b) for r in q.select("q", "p.*").join(b.select("b", "p.*"), ["len", "i", "j", "s", "t"]).select("q", "b").distinct().collect()}
    near = {(x, y) for x in qs for y in back if _lev(x, y) <= 2}
    assert near and near <= met


def test_fuzzy_distance_argument_is_honoured(spark):
    import random
    rnd = random.Random(3)
    long = "".join(rnd.choice("abcd") for _ in range(500))
    back = ["abcdefgh", "ab", "a", long] + ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9))) for _ in range(40)]
    back = sorted(set(back))
    bdf = spark.createDataFrame([(n, i) for i, n in enumerate(back)], "name string, key long")
    qs = sorted({"abcxyzgh", "b", long[:250] + "x" + long[252:], "zzzz"}
                | {"".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 10))) for _ in range(40)})
    qdf = spark.createDataFrame([(q,) for q in qs], "input_name string")
    for k in (0, 1, 3):
        got = {r.input_name: r for r in match_names_fuzzy(qdf, bdf, max_distance=k).collect()}
        for q in qs:
            near = sorted((_lev(q, b), b) for b in back if abs(len(q) - len(b)) <= k and _lev(q, b) <= k)
            assert (got[q].distance, got[q].matched_name) == near[0] if near else got[q].distance is None, (k, q)


def test_backbone_fields_are_carried(spark):
    from verdant.operators.matcher import responses_for
    back = spark.createDataFrame([("Felis catus", 5, "SPECIES", "SYNONYM", "Animalia", 6, "Felis silvestris")],
                                 "name string, key long, rank string, status string, kingdom string, "
                                 "acceptedUsageKey long, accepted string")
    r = responses_for(spark.createDataFrame([("felis catuz",), ("nothing",)], "name_key string"), back).collect()
    by = {x.name_key: x for x in r}
    hit = by["felis catuz"]
    assert (hit.kingdom, hit.status, hit.acceptedUsageKey, hit.accepted, hit.rank) == \
        ("Animalia", "SYNONYM", 6, "Felis silvestris", "SPECIES")
    assert by["nothing"].matchType == "NONE" and by["nothing"].kingdom is None


def test_failed_repoint_keeps_the_live_version(spark):
    import tempfile
    base = tempfile.mkdtemp(prefix="verdant-sink-")
    one = spark.createDataFrame([(1,)], "a int")
    first = P.write_version(one, base, "t", version="b")
    P.write_version(one.union(one), base, "t", version="a", repoint=False)     # written, never pointed at
    assert P.current_path(spark, base, "t") == first
    P.write_version(one.union(one), base, "t", version="c")
    assert P.read_current(spark, base, "t").count() == 2


def test_no_checkpoint_folder_raises():
    import pytest
    from verdant.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())
