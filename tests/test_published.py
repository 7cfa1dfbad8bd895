"""Co-partitioned published tables and the whole build over them."""
import json
import re

from verdant import lookups as L
from verdant.operators.layers import OFFER_COLUMNS, attach_layer
from verdant.plans import publish as P
from verdant.plans import published as B
from verdant.plans.surface import lookup, provenance_of
from verdant.sources.services import MATCH_SCHEMA

from helpers import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_layers_attach_without_a_shuffle_of_the_spine(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spine = spark.range(500).selectExpr("id * 3 as canonical_taxon_id", "'n' as name_he", "cast(null as string) as sold_by")
        layer = spark.range(200).selectExpr("id * 6 as canonical_taxon_id", "array('shop') as sold_by", "array('s') as pot_sizes",
                                            "1.0D as price_ils", "'b' as price_band", "'in' as availability",
                                            "array('u') as source_urls")
        base = str(tmp_path)
        P.write_bucketed(spine, base, "spine", 8)
        P.write_bucketed(layer, base, "offers", 8)
        a, b = P.read_bucketed(spark, base, "spine"), P.read_bucketed(spark, base, "offers")
        out = attach_layer(a, b, OFFER_COLUMNS)
        assert "Exchange" not in _plan(out) and "SortMergeJoin" in _plan(out)
        want = attach_layer(spine, layer, OFFER_COLUMNS)
        assert rows(out, *sorted(out.columns)) == rows(want, *sorted(out.columns))
        # a layer that is not published yet is shuffled alone
        fresh = _plan(attach_layer(a, layer, OFFER_COLUMNS))
        assert fresh.count("Exchange") == 1
        # another application: the session catalogue does not know the tables
        for df in (a, b):
            table = P._table_of(P.current_path(spark, base, "spine" if df is a else "offers").split("\t")[0])
            spark.sql(f"DROP TABLE {table}")
        again = attach_layer(P.read_bucketed(spark, base, "spine"), P.read_bucketed(spark, base, "offers"), OFFER_COLUMNS)
        assert "Exchange" not in _plan(again) and again.count() == 500
        # a look-up of one key reads one bucket (the plan says so only where the scan keeps its buckets)
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        one = _plan(lookup(P.read_bucketed(spark, base, "spine"), 30))
        assert "SelectedBucketsCount: 1 out of 8" in one
        assert lookup(P.read_bucketed(spark, base, "spine"), 30).count() == 1
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_provenance_is_bucketed_without_a_shuffle(spark, tmp_path):
    hot = spark.range(3000).selectExpr("if(id % 3 = 0, 7L, id) as canonical_taxon_id", "'f' as field", "cast(id as string) as value",
                                       "'s' as source", "100 as confidence").repartition(4)
    P.write_bucketed_as_is(hot, str(tmp_path), "provenance", 8)
    table = P.read_bucketed(spark, str(tmp_path), "provenance")
    files = [f for f in table.inputFiles()]
    buckets = {}
    for f in files:
        buckets.setdefault(re.search(r"_(\d{5})\.c000", f).group(1), []).append(f)
    assert max(map(len, buckets.values())) == 4                   # every task wrote its part of the hot bucket
    assert provenance_of(table, 7).count() == 1000 + 1 and table.count() == 3000


def test_the_whole_build(spark, tmp_path):
    eav = spark.createDataFrame([
        ("wildflowers", "1", "תאנה", "Ficus carica", L.LABEL_NAME_HE, "תאנה", json.dumps({}), None),
        ("wildflowers", "1", "תאנה", "Ficus carica", L.LABEL_LIFE_FORM, "עץ", "{}", None),
        ("wildflowers", "2", "זית", "Olea", L.LABEL_NAME_HE, "זית", "{}", None),
        ("wildflowers", "3", "אלון", "Quercus ilex", L.LABEL_NAME_HE, "אלון", "{}", None),
    ], "source string, source_id string, raw_name_he string, raw_name_lat string, attribute string, "
       "value string, raw_text string, scraped_at date")
    match = spark.createDataFrame([
        ("ficus carica", 7, None, "Ficus carica L.", None, "SPECIES", "ACCEPTED", "EXACT", 99, "Plantae", "Moraceae", "Ficus"),
        ("quercus ilex", 8, None, "Quercus ilex L.", None, "SPECIES", "ACCEPTED", "EXACT", 99, "Plantae", "Fagaceae", "Quercus")],
        MATCH_SCHEMA)
    status = spark.createDataFrame([(8, "listed", "curated-il-invasive")], "canonical_taxon_id long, invasive_status string, status_source string")
    offers = spark.createDataFrame([("p1", "תאנה", "c", 20.0, ["3 ליטר"], "in_stock", "u"), ("p2", "לא ידוע", "c", None, None, "in_stock", "u2")],
                                   "source_id string, name_he string, category string, price double, "
                                   "pot_sizes array<string>, availability string, url string")
    pairs = spark.createDataFrame([("Ficus carica", "http://x/wiki/Special:FilePath/F.jpg")], "n string, img string")
    files = spark.createDataFrame([("File:F.jpg", [("http://t/F.jpg", None, "p", (("CC",), ("me",)))])],
                                  "title string, imageinfo array<struct<thumburl:string,url:string,"
                                  "descriptionurl:string,extmetadata:struct<LicenseShortName:struct<value:string>,"
                                  "Artist:struct<value:string>>>>")
    occ = spark.createDataFrame([], "taxon_key long, occ_order struct<p:int>, references string, media_pos int, "
                                "identifier string, license string, rightsHolder string, creator string")
    given = B.Inputs(eav, match, status, offers, "azur", pairs, files, occ)
    out = B.build(spark, str(tmp_path), given, buckets=4)
    cat = {r.canonical_taxon_id: r for r in out.table("catalogue").collect()}
    assert len(out.table("catalogue").columns) == 41 and set(cat) == {7, 8}
    assert cat[7].sold_by == ["azur"] and cat[7].image_thumb == "https://t/F.jpg" and cat[7].price_band == "budget"
    assert cat[8].invasive_status == "listed" and cat[8].sold_by is None
    prov = rows(out.table("provenance"), "canonical_taxon_id", "field", "source")
    assert (7, "image", "wikimedia") in prov and (7, "match_method", "azur") in prov
    assert rows(B.unmatched_of(out), "source_id") == [("p2",)]
    assert B.review_of(out).count() == 1 and B.crosswalk_of(out).count() == 3
    assert B.coverage(out).first().have == 1
    # a second run of the layers changes nothing (OFR5, MED5)
    before = prov
    B.build(spark, str(tmp_path), given, buckets=4)
    assert rows(out.table("provenance"), "canonical_taxon_id", "field", "source") == before
    assert rows(B.tally_of(out)) == [("catalogue", 2), ("media", 1), ("offers", 1), ("provenance", len(before)), ("spine", 2)]
