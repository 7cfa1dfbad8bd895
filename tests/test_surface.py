from pyspark.sql import functions as F

from verdant.operators.layers import OFFER_COLUMNS, MEDIA_COLUMNS, with_layer_columns
from verdant.operators.reconcile import CANONICAL_COLUMNS
from verdant.plans import surface as Q
from verdant.plans.publish import ensure_columns


def catalog(spark):
    base = [
        (1, "אלון", "Quercus a", "Fagaceae", "tree", "not_listed", "מרץ אפריל", "חורש", ["a"], ["mountains"], True, False, None),
        (2, "100% טבעי", "Quer_cus b", "Fagaceae", None, "listed", "מאי", None, [], [], False, True, 50.0),
        (3, "a\\b", None, None, "shrub", "potential", None, "חורש", None, None, False, False, 10.0),
    ]
    df = spark.createDataFrame(base, "canonical_taxon_id long, name_he string, scientific_name string, "
                               "family string, life_form string, invasive_status string, bloom_months_he string, "
                               "habitat_he string, distribution_regions array<string>, climate_zone array<string>, "
                               "protected boolean, red_list boolean, price_ils double")
    lists = {"common_names_en", "synonyms_latin", "statuses_he"}
    for c in CANONICAL_COLUMNS:
        if c not in df.columns:
            t = "array<string>" if c in lists else "boolean" if c in Q.SPECIAL_COLUMNS else "string"
            df = df.withColumn(c, F.lit(None).cast(t))
    df = df.withColumn("sold_by", F.when(F.col("price_ils").isNotNull(), F.array(F.lit("azur"))))
    return df


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_search_wildcards_and_backslash(spark):
    cat = catalog(spark)
    assert ids(Q.CatalogQuery(search="quer").matches(cat)) == ["1", "2"]      # ILIKE
    assert ids(Q.CatalogQuery(search="q_er").matches(cat)) == ["1", "2"]      # '_' stays a wildcard
    assert ids(Q.CatalogQuery(search="100%").matches(cat)) == ["2"]
    assert ids(Q.CatalogQuery(search="a\\b").matches(cat)) == ["3"]           # backslash is literal


def test_filters_compose(spark):
    cat = catalog(spark)
    assert ids(Q.CatalogQuery(zone="mountains").matches(cat)) == ["1"]       # null list dropped
    assert ids(Q.CatalogQuery(region="a", special="protected").matches(cat)) == ["1"]
    assert ids(Q.CatalogQuery(special="unknown").matches(cat)) == ["1", "2", "3"]
    assert ids(Q.CatalogQuery(for_sale=True, habitat="חורש").matches(cat)) == ["3"]
    assert ids(Q.CatalogQuery(month="מר", life_form="tree", family="Fagaceae").matches(cat)) == ["1"]
    assert Q.CatalogQuery(invasive_status="listed").count(cat).first().matched == 1


def test_sorts_nulls_last_and_page(spark):
    cat = catalog(spark)
    q = Q.CatalogQuery(sort="price")
    assert [r.id for r in q.page(cat).collect()] == ["2", "3", "1"]
    q = Q.CatalogQuery(sort="scientific_name", limit=2)
    assert [r.id for r in q.page(cat).collect()] == ["2", "1"]   # '_' < 'c' in code point order
    plan = q.page(cat)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_facets_stats_lookup(spark):
    cat = catalog(spark)
    assert sorted(map(tuple, Q.facet(cat, "family").collect())) == [("Fagaceae", 2)]
    assert sorted(map(tuple, Q.array_facet(cat, "distribution_regions", "region").collect())) == [("a", 1)]
    s = Q.stats(cat).first()
    assert (s.total, s.fams, s.invas, s.sale, s.lifed, s.pct_classified) == (3, 1, 2, 2, 2, 67)
    assert Q.lookup(cat, 2).count() == 1
    empty = Q.stats(cat.where("false")).first()
    assert empty.total == 0 and empty.pct_classified is None
    full = ensure_columns(cat)
    assert len(full.columns) == 41
    assert len(Q.project(with_layer_columns(with_layer_columns(cat, OFFER_COLUMNS), MEDIA_COLUMNS)).columns) == 40
