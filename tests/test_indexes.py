"""Stored indexes of the surface: trigram search, facet bitmaps, ordered pages."""
import random
from itertools import combinations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from verdant.plans import paging as PG
from verdant.plans.facets import FacetIndex, listed, scalar
from verdant.plans.search_index import SearchIndex, matches, trigrams_of
from verdant.plans.surface import CatalogQuery

from helpers import rows

TEXTS = "id long, a string, b string"


def _texts():
    rng = random.Random(3)
    out = [(1, None, None), (2, "", "x"), (3, "ab", "ABC"), (4, "100% wool", "a_b"), (5, "back\\slash", None),
           (6, "אלון מצוי", "ÉTÉ"), (7, "x" * 30000 + "needle", None), (8, "abcabcabc", "abcabcabc")]
    words = ["oak", "Quercus", "calliprinos", "100%", "a_b", "é", "אלון", "th", "the"]
    for i in range(9, 400):
        out.append((i, " ".join(rng.choices(words, k=rng.randint(0, 6))), rng.choice([None, " ".join(rng.choices(words, k=3))])))
    return out


PATTERNS = ["quercus", "QUERC%prinos", "the oak", "th", "_", "100%", "\\s", "אלון מ", "été", "needle", "abc", "ercus c_ll"]


def test_search_index_equals_the_scan(spark, tmp_path):
    df = spark.createDataFrame(_texts(), TEXTS)
    index = SearchIndex(spark, str(tmp_path), "id", ("a", "b")).build(df, block_rows=32, files=4)
    for p in PATTERNS:
        want = rows(df.where(matches(("a", "b"), p)), "id")
        assert rows(index.search(p)) == want, p
    assert len(rows(index.search("quercus"))) > 50
    q = CatalogQuery(search="quercus", search_columns=("a", "b"))
    assert rows(index.where(df, q), "id") == rows(q.where(df), "id")
    with pytest.raises(ValueError):
        index.where(df, CatalogQuery(search="x"))


def test_reduction_of_patterns():
    assert trigrams_of("th_t ") == [] and trigrams_of("%ab%") == [] and trigrams_of("") == []
    assert trigrams_of("Oaks%the_ree") == ["aks", "oak", "ree", "the"]


def test_postings_are_pruned_by_statistics(spark, tmp_path):
    df = spark.createDataFrame(_texts(), TEXTS)
    index = SearchIndex(spark, str(tmp_path), "id", ("a", "b")).build(df, block_rows=64, files=8)
    spans = []
    for f in index._read("postings").inputFiles():
        stats = [pq.ParquetFile(f.removeprefix("file:")).metadata.row_group(i).column(0).statistics
                 for i in range(pq.ParquetFile(f.removeprefix("file:")).metadata.num_row_groups)]
        spans += [(s.min, s.max) for s in stats]
    assert len(spans) >= 4
    for gram in trigrams_of("quercus"):
        assert sum(lo <= gram <= hi for lo, hi in spans) <= 2       # a trigram stands in one file, two at a border
    plan = index.candidates(["que"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(gram), EqualTo(gram,que)]" in plan or "In(gram" in plan


FACETS = [scalar("form"), scalar("state"), listed("zone"), listed("region")]


def _catalogue(spark):
    rng = random.Random(8)
    data = [(i, rng.choice([None, "tree", "shrub", "vine"]), rng.choice(["listed", "not"]),
             rng.choice([None, [], ["hot"], ["hot", "cold"], ["cold", "cold", None]]),
             rng.sample(["north", "south", "east"], rng.randint(0, 3))) for i in range(500)]
    return spark.createDataFrame(data, "id long, form string, state string, zone array<string>, region array<string>")


def _passes(f, values):
    c = F.col(f)
    if f in ("zone", "region"):
        return F.exists(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isin(values))
    return c.isin(values)


def test_facets_under_every_pair_of_filters(spark, tmp_path):
    df = _catalogue(spark).repartition(3)
    index = FacetIndex(spark, str(tmp_path)).build(df, "id", FACETS)
    choices = [("form", ["tree"]), ("state", ["listed"]), ("zone", ["hot"]), ("region", ["north"]),
               ("form", ["vine", "shrub"]), ("region", ["nowhere"])]
    active = [{}] + [dict([c]) for c in choices] + [dict(p) for p in combinations(choices, 2) if p[0][0] != p[1][0]]
    for a in active[::5] + active[-1:]:
        under = df
        for f, v in a.items():
            under = under.where(_passes(f, v))
        assert index.count(a).first().matched == under.count(), a
        assert rows(index.keys(a)) == rows(under, "id"), a
    for a in ({}, {"form": ["vine", "shrub"], "zone": ["hot"]}, {"region": ["nowhere"]}):
        for field in ("form", "zone", "region"):
            under = df
            for f, v in a.items():
                if f != field:
                    under = under.where(_passes(f, v))
            value = F.explode(F.array_distinct(field)) if field in ("zone", "region") else F.col(field)
            want = (under.select(value.alias("value")).where("value is not null").groupBy("value").count())
            assert rows(index.counts(field, a), "value", "c") == rows(want), (field, a)


def _sortable(spark):
    rng = random.Random(5)
    data = [(i, rng.choice([None, 1.5, 2.5, 2.5, 9.0]), rng.choice([None, "a", "b", "ב"])) for i in range(230)]
    return spark.createDataFrame(data, "id long, price double, name string")


@pytest.mark.parametrize("order", [[PG.Sort("price", True), PG.Sort("name"), PG.Sort("id")],
                                   [PG.Sort("name"), PG.Sort("id")], [PG.Sort("name", True), PG.Sort("price"), PG.Sort("id", True)]])
def test_pages_concatenate_to_the_full_order(spark, tmp_path, order):
    df = _sortable(spark).repartition(4)
    whole = [r.id for r in df.orderBy(*PG.by(order)).collect()]
    seen, last = [], None
    while True:
        page = PG.after(df, order, last, 48)
        got = [r.id for r in page.collect()]
        if not got:
            assert PG.last_of(page, order) is None
            break
        seen += got
        last = PG.last_of(page, order)
    assert seen == whole
    o = PG.Ordered(spark, str(tmp_path), "t").build(df, order, ranges=5)
    ranked = sorted((r["rank"], r.id) for r in o.ranked().collect())
    assert [i for _, i in ranked] == whole and [k for k, _ in ranked] == list(range(1, 231))
    for n in (1, 3, 5):
        assert [i for _, i in sorted((r["rank"], r.id) for r in o.page(n).collect())] == whole[(n - 1) * 48:n * 48]
    assert o.page(6).count() == 0


def test_a_page_reads_only_its_place(spark, tmp_path):
    order = [PG.Sort("name"), PG.Sort("id")]
    o = PG.Ordered(spark, str(tmp_path), "t").build(_sortable(spark), order, ranges=4)
    plan = o.page(1)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "_part" in plan.split("PushedFilters:")[1].split("]")[0]
    seek = PG.after(_sortable(spark), order, {"name": "b", "id": 7})._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in seek


def test_trigrams_leave_a_task_as_lists(spark, tmp_path):
    """The lists that are dealt and sorted are made per task: rows by trigrams and blocks, not by texts."""
    df = spark.createDataFrame([(i, "the same text again", f"n{i % 3} é🌿🌿é") for i in range(3000)] + [(None, "lost", None)], TEXTS)
    index = SearchIndex(spark, str(tmp_path), "id", ("a", "b")).build(df.coalesce(2), block_rows=500, files=4)
    made = spark.read.parquet(f"{tmp_path}/search_lists/*")
    per_block = made.where("col = 0").groupBy("block", "gram").count()
    assert per_block.agg(F.max("count")).first()[0] <= 4 and made.agg(F.max(F.size("keys"))).first()[0] > 100
    assert made.where("col = 0").agg(F.sum(F.size("keys"))).first()[0] == 3000 * len(trigrams_of("the same text again"))
    for p in ("same text", "N2 É🌿", "🌿🌿é", "text_again", "lost"):
        assert rows(index.search(p)) == rows(df.where(matches(("a", "b"), p) & F.col("id").isNotNull()), "id"), p


def test_long_texts_are_cut_into_trigrams_by_slices(monkeypatch):
    from verdant.plans import search_index
    text = "".join(random.Random(2).choices("abé🌿ן ", k=500))
    want = {text[i:i + 3] for i in range(len(text) - 2)}
    for at_once in (1, 7, 1000):
        monkeypatch.setattr(search_index, "_AT_ONCE", at_once)
        assert set(search_index.spelled(search_index.trigrams(text))) == want
    assert not len(search_index.trigrams("ab"))
