from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.operators import reconcile as R
from verdant.operators import staging as S
from verdant.operators import status as ST

P = L.REFERENCE_PROFILE
LBL = {c: lab for c, lab in P.scalar_labels.items()}


def resolved(spark, data):
    """data: (source_id, key, sci, name_he, name_lat, {label: value})."""
    labels = P.labels
    out = []
    for sid, key, sci, he, lat, attrs in data:
        out.append((sid, "wildflowers", key, sci, "Fam", "Gen", 95, he, lat,
                    *[attrs.get(lab) for lab in labels]))
    schema = ("source_id string, source string, canonical_taxon_id long, scientific_name string, "
              "family string, genus string, confidence int, name_he string, name_lat string, ") + \
        ", ".join(f"`{lab}` string" for lab in labels)
    return spark.createDataFrame(out, schema)


DATA = [
    ("27", 1, "Ficus carica L.", "תאנה ב", "Ficus carica",
     {LBL["name_ar"]: "", LBL["habitat_he"]: "חורש", L.LABEL_COMMON_EN: "fig",
      L.LABEL_STATUSES: "צמח רעיל", L.LABEL_DISTRIB: "גליל, כרמל", L.LABEL_LIFE_FORM: "עשב"}),
    ("1076", 1, "Ficus carica L.", "תאנה א", "Ficus sp",
     {LBL["name_ar"]: None, L.LABEL_COMMON_EN: "common fig", L.LABEL_STATUSES: "צמח מוגן; צמח מוגן",
      L.LABEL_DISTRIB: "שרון, גליל", L.LABEL_LIFE_FORM: ""}),
    ("2", 1, "Ficus carica L.", None, "Ficus carica Mill.",
     {LBL["name_ar"]: "تين", L.LABEL_DISTRIB: "ערבה", L.LABEL_LIFE_FORM: "עץ"}),
    ("10", 2, "Olea europaea", "זית", "Olea europaea", {}),
]


def test_first_record_in_string_order_and_gaps(spark):
    rec = R.reconcile(resolved(spark, DATA), None, P)
    r = {x.canonical_taxon_id: x for x in rec.collect()}[1]
    # string order: "1076" < "2" < "27"
    assert r.source_id == "1076" and r.name_he == "תאנה א"
    assert r.source_url.endswith("ID=1076")
    assert r.name_ar == "تين"                 # first truthy value ('' and null skipped)
    assert r.life_form == "tree"              # first record's '' is a gap, record "2" fills it
    assert r.habitat_he == "חורש"
    assert r.common_names_en == ["common fig", "fig"]
    assert r.synonyms_latin == ["Ficus sp"]  # "Ficus carica Mill." has the same binomial
    assert r.distribution_regions == ["שרון", "גליל", "ערבה", "כרמל"]
    # zones sorted per record, then appended in record order
    assert r.climate_zone == ["coastal_plain", "mountains", "negev_arava"]
    assert r.statuses_he == ["צמח מוגן", "צמח רעיל"]
    assert r.protected and r.poisonous and not r.edible
    assert r.invasive_status == "not_listed" and r.native_status == "native"


def test_order_independent_under_repartition(spark):
    df = resolved(spark, DATA)
    a = sorted(map(tuple, R.canonical_table(R.reconcile(df, None, P)).collect()), key=repr)
    b = sorted(map(tuple, R.canonical_table(R.reconcile(df.repartition(7).orderBy(F.rand(3)), None, P)).collect()),
               key=repr)
    assert a == b


def test_provenance_first_record_only(spark):
    rec = R.reconcile(resolved(spark, DATA), None, P)
    prov = [tuple(x) for x in R.provenance(rec, P).where("canonical_taxon_id = 1").collect()]
    fields = [p[1] for p in prov]
    assert fields == ["scientific_name", "family", "genus", "name_he", "native_status", "invasive_status",
                      "status", "status", "distribution_il"]   # life form '' -> no row
    assert prov[0][4] == 95 and prov[3][2] == "תאנה א" and prov[5][3] == "default"


def test_status_layer(spark):
    rec_in = resolved(spark, DATA)
    listed = spark.createDataFrame([(1,)], "canonical_taxon_id long")
    check = spark.createDataFrame([(1, [("Plantae", 1, "A", None), ("Plantae", 2, "", "Olea"),
                                        ("Animalia", 3, "x", None), ("Plantae", None, "y", None)]),
                                   (2, [("Plantae", 2, "Olea late", None)])],
                                  "page_no long, results array<struct<kingdom:string,nubKey:long,"
                                  "scientificName:string,canonicalName:string>>")
    ck = ST.checklist_keys(check)
    assert sorted(map(tuple, ck.collect())) == [(1, "A"), (2, "Olea late")]
    st = ST.status_frame(listed, ST.potential_keys(ck, listed))
    rec = R.reconcile(rec_in, st, P)
    got = {r.canonical_taxon_id: r.invasive_status for r in rec.collect()}
    assert got == {1: "listed", 2: "potential"}
    prov = R.provenance(rec, P).where("field = 'invasive_status'").collect()
    assert {p.canonical_taxon_id: p.source for p in prov} == {1: L.LISTED_SOURCE, 2: L.POTENTIAL_SOURCE}


def test_pivot_first_value_by_date(spark):
    recs = spark.createDataFrame([
        ("w", "1", "he", "lat", {"a": "new", "b": "x"}, "2026-07-01"),
        ("w", "1", "he", "lat", {"a": "old"}, "2026-06-01"),
    ], "source string, source_id string, name_he string, name_lat string, fields map<string,string>, "
       "scraped_at string").withColumn("scraped_at", F.col("scraped_at").cast("date"))
    eav = S.eav_from_records(recs)
    assert eav.count() == 3
    p = S.pivot_records(eav, ["a", "b", "c"]).first()
    assert (p.a, p.b, p.c) == ("old", "x", None)
    xw = S.crosswalk(eav).collect()
    assert [(r.name_he, r.name_lat, r.source_id) for r in xw] == [("he", "lat", "1")]


def test_conflicts_and_precedence(spark):
    prov = spark.createDataFrame([(1, "price", "10", "azur", 100), (1, "price", "12", "azur", 100),
                                  (1, "family", "A", "gbif", 90), (1, "family", "B", "wildflowers", 100)],
                                 R.PROVENANCE_COLUMNS)
    c = {(r.field): r.values for r in R.conflicts(prov).collect()}
    assert c == {"price": ["10", "12"], "family": ["A", "B"]}
    w = {r.field: (r.value, r.source) for r in R.precedence(prov).collect()}
    assert w == {"price": ("10", "azur"), "family": ("A", "gbif")}


def test_all_values_provenance(spark):
    facts = R.record_facts(resolved(spark, DATA), P)
    prov = R.all_values_provenance(facts, P).where("canonical_taxon_id = 1")
    got = {(r.field, r.value) for r in prov.collect()}
    assert ("name_ar", "تين") in got and ("habitat_he", "חורש") in got
    assert ("status", "צמח מוגן") in got and ("status", "צמח רעיל") in got
    assert ("name_ar", "") not in got                      # empty values are not provenance
    assert prov.count() == len(got)                        # one row per (field, value)


def test_cluster_conf_sizes():
    from verdant.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 8000)
    # a tenth of the input in 256 MB partitions: sized by the bytes a shuffle holds, not by the scan
    assert int(c["spark.sql.shuffle.partitions"]) == 40960
    assert int(cluster_conf(10 ** 18, 1000)["spark.sql.shuffle.partitions"]) == 8000
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(1, 8)["spark.sql.shuffle.partitions"]) == 16
