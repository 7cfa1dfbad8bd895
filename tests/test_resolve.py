from pyspark.sql import functions as F

from verdant.operators import resolve as RS
from verdant.sources.services import MATCH_SCHEMA

from helpers import rows


def match_df(spark):
    data = [
        # name_key, usage, accepted key, sci, accepted, rank, status, type, conf, kingdom, family, genus
        ("ficus carica", 1, None, "Ficus carica L.", None, "SPECIES", "ACCEPTED", "EXACT", 99, "Plantae", "Moraceae", "Ficus"),
        ("ficus retusa", 2, 3, "Ficus retusa L.", "Ficus microcarpa L.f.", "SPECIES", "SYNONYM", "EXACT", 97, "Plantae", "Moraceae", "Ficus"),
        ("felis catus", 9, None, "Felis catus", None, "SPECIES", "ACCEPTED", "EXACT", 99, "Animalia", "Felidae", "Felis"),
        ("quercus", 5, None, "Quercus", None, "GENUS", "ACCEPTED", "HIGHERRANK", 94, "Plantae", "Fagaceae", "Quercus"),
        ("rosa x", 6, None, "Rosa x", None, None, "ACCEPTED", "FUZZY", 99, None, "Rosaceae", "Rosa"),
        ("olea a", 7, None, "Olea a", None, "SPECIES", "ACCEPTED", "FUZZY", 87, "Plantae", "Oleaceae", "Olea"),
        ("olea b", 8, None, "Olea b", None, "SPECIES", "ACCEPTED", "FUZZY", 88, None, "Oleaceae", "Olea"),
        ("nokey x", 0, None, "Nokey x", None, "SPECIES", "ACCEPTED", "EXACT", 99, "Plantae", None, None),
        ("rosa canina 'iceberg'", None, None, None, None, None, None, "NONE", 100, None, None, None),
        ("rosa canina", 10, None, "Rosa canina L.", None, "SPECIES", "ACCEPTED", "EXACT", 70, "Plantae", "Rosaceae", "Rosa"),
        ("acacia 'gold'", 11, None, "Acacia", None, "GENUS", "ACCEPTED", "HIGHERRANK", 95, "Plantae", "Fabaceae", "Acacia"),
        ("acacia saligna", 12, None, "Acacia saligna", None, "SPECIES", "ACCEPTED", "EXACT", 99, "Plantae", "Fabaceae", "Acacia"),
    ]
    return spark.createDataFrame(data, MATCH_SCHEMA)


def test_ladder(spark):
    names = spark.createDataFrame([
        ("Ficus carica", "lat"), ("Ficus  retusa", "lat"), ("Felis catus", "lat"), ("Quercus", "lat"),
        ("Rosa x", "lat"), ("Olea a", "lat"), ("Olea b", "lat"), ("Nokey x", "lat"), ("", "lat"),
        ("אלון", "lat"), ("Ficus carica", "he"), ("Unknown thing", "lat"),
        ("Rosa canina 'Iceberg'", "lat"), ("Rosa 'Iceberg'", "lat"), ("Acacia 'Gold'", "lat")], "input_name string, input_lang string")
    res = {(r.input_name, r.input_lang): r for r in RS.resolve_names(names, match_df(spark)).collect()}
    g = lambda n, l="lat": res[(n, l)]
    assert g("Ficus carica").status == "resolved" and g("Ficus carica").canonical_taxon_id == 1
    # synonym collapse to the accepted key and name
    assert (g("Ficus  retusa").canonical_taxon_id, g("Ficus  retusa").scientific_name) == (3, "Ficus microcarpa L.f.")
    assert g("Felis catus").reason == "non_plant:Animalia"
    assert g("Quercus").reason == "higher_rank:GENUS"
    assert g("Rosa x").reason == "higher_rank:None"          # rank missing, kingdom missing is fine
    assert g("Olea a").reason == "low_confidence:87"
    assert g("Olea b").status == "resolved"                   # 88 is inclusive
    assert g("Nokey x").reason == "missing_key"
    assert g("").reason == "empty" and g("").confidence is None
    assert g("אלון").reason == "hebrew_no_crosswalk" and g("Ficus carica", "he").reason == "hebrew_no_crosswalk"
    assert g("Unknown thing").reason == "no_match" and g("Unknown thing").confidence == 0
    # retry after NONE replaces the answer with the stripped name's answer
    assert g("Rosa canina 'Iceberg'").reason == "low_confidence:70"
    # ... even when the retry finds nothing (no response -> NONE)
    assert g("Rosa 'Iceberg'").reason == "no_match"
    # HIGHERRANK at high confidence does not trigger the retry
    assert g("Acacia 'Gold'").reason == "higher_rank:GENUS"


def test_records_review_split(spark):
    recs = spark.createDataFrame([("1", "תאנה", "Ficus carica"), ("2", "x", None), ("3", "y", "Quercus")],
                                 "source_id string, name_he string, name_lat string")
    res = RS.resolve_records(recs, match_df(spark))
    ok, review = RS.split_review(res)
    assert rows(ok, "source_id", "canonical_taxon_id") == [("1", 1)]
    assert rows(review, "source_id", "reason") == [("2", "empty"), ("3", "higher_rank:GENUS")]
    assert review.columns == ["source_id", "name_he", "name_lat", "reason", "confidence", "matchType"]


def test_incremental_cache(spark):
    names = spark.createDataFrame([("Ficus carica", "lat"), ("New name", "lat"), ("Rosa canina 'Iceberg'", "lat")],
                                  "input_name string, input_lang string")
    m = match_df(spark)
    st = RS.cache_stats(names, m).first()
    assert (st.keys, st.hits, st.misses) == (4, 3, 1)
    miss = RS.unseen_keys(names, m)
    assert rows(miss) == [("new name",)]
    new = miss.select("name_key", *[F.lit(None).cast(f.dataType).alias(f.name)
                                    for f in m.schema.fields if f.name != "name_key"])
    m2 = RS.extend_match_table(m, new.withColumn("matchType", F.lit("NONE")))
    assert RS.cache_stats(names, m2).first().misses == 0
    assert m2.count() == m.count() + 1


def test_crosswalk_resolution(spark):
    recs = spark.createDataFrame([("1", "תאנה", None), ("2", "אחר", None)],
                                 "source_id string, name_he string, name_lat string")
    xw = spark.createDataFrame([("תאנה", "Ficus carica", "w", "9"), ("תאנה", "Ficus retusa", "w", "10")],
                               "name_he string, name_lat string, source string, source_id string")
    res = RS.resolve_via_crosswalk(recs, xw, match_df(spark))
    # "10" < "9" in string order: the first pair is Ficus retusa
    assert rows(res, "source_id", "canonical_taxon_id", "reason") == [("1", 3, None), ("2", None, "empty")]
