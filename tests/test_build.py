from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.plans.build import add_media, add_offers, build_catalog
from verdant.plans.publish import ensure_columns
from verdant.sources.services import MATCH_SCHEMA


def test_end_to_end_build(spark):
    eav = spark.createDataFrame([
        ("wildflowers", "1", "תאנה", "Ficus carica", L.LABEL_NAME_HE, "תאנה", "{}", None),
        ("wildflowers", "1", "תאנה", "Ficus carica", L.LABEL_LIFE_FORM, "עץ", "{}", None),
        ("wildflowers", "2", "זית", "Olea", L.LABEL_NAME_HE, "זית", "{}", None),
    ], "source string, source_id string, raw_name_he string, raw_name_lat string, attribute string, "
       "value string, raw_text string, scraped_at date")
    match = spark.createDataFrame([
        ("ficus carica", 7, None, "Ficus carica L.", None, "SPECIES", "ACCEPTED", "EXACT", 99, "Plantae",
         "Moraceae", "Ficus")], MATCH_SCHEMA)
    b = build_catalog(eav, match)
    canon = b.canonical
    assert canon.count() == 1 and b.review.count() == 1
    assert canon.first().life_form == "tree"
    offers = spark.createDataFrame([("p1", "תאנה", "c", 20.0, ["3 ליטר"], "in_stock", "u")],
                                   "source_id string, name_he string, category string, price double, "
                                   "pot_sizes array<string>, availability string, url string")
    canon2, prov2, unmatched, _ = add_offers(canon, b.provenance, offers, "azur")
    assert canon2.first().price_band == "budget" and unmatched.count() == 0
    assert prov2.where(F.col("source") == "azur").count() == 5
    pairs = spark.createDataFrame([("Ficus carica", "http://x/wiki/Special:FilePath/F.jpg")], "n string, img string")
    files = spark.createDataFrame([("File:F.jpg", [("http://t/F.jpg", None, "p", (("CC",), ("me",)))])],
                                  "title string, imageinfo array<struct<thumburl:string,url:string,"
                                  "descriptionurl:string,extmetadata:struct<LicenseShortName:struct<value:string>,"
                                  "Artist:struct<value:string>>>>")
    occ = spark.createDataFrame([], "taxon_key long, occ_order struct<p:int>, references string, media_pos int, "
                                "identifier string, license string, rightsHolder string, creator string")
    canon3, prov3, _ = add_media(canon2, prov2, pairs, files, occ)
    row = ensure_columns(canon3).first()
    assert row.image_thumb == "https://t/F.jpg" and row.sold_by == ["azur"]
    assert prov3.where("field = 'image'").count() == 1
