"""RES7 and GAT5: kept match answers over an append-only table."""
from pyspark.sql import functions as F

from verdant.operators.matcher import responses_for
from verdant.operators.resolve import resolve_names
from verdant.plans.answers import KeptAnswers
from verdant.plans.append_table import AppendTable, write_line
from verdant.sources.services import MATCH_SCHEMA

from helpers import rows

ROW = "k string, v long"


def _table(spark, tmp_path):
    return AppendTable(spark, str(tmp_path), "t", spark.createDataFrame([], ROW).schema)


def test_commits_are_idempotent_by_batch(spark, tmp_path):
    t = _table(spark, tmp_path)
    assert t.read().count() == 0 and t.commits() == []
    assert t.commit(spark.createDataFrame([("a", 1), ("b", 2)], ROW), "r1")
    before = t.read()
    assert not t.commit(spark.createDataFrame([("c", 9)], ROW), "r1")            # a replay adds nothing
    assert t.commit(spark.createDataFrame([("b", 3), ("d", 4)], ROW), "r2")
    assert rows(before, "k", "v") == [("a", 1), ("b", 2)]                        # a plan keeps its files
    assert rows(t.read(), "k", "v", "batch") == [("a", 1, "r1"), ("b", 2, "r1"), ("b", 3, "r2"), ("d", 4, "r2")]
    assert rows(t.first_wins("k"), "k", "v", "batch") == [("a", 1, "r1"), ("b", 2, "r1"), ("d", 4, "r2")]
    assert rows(t.read({"r2"}), "k") == [("b",), ("d",)]


def test_first_commit_wins_for_every_reader(spark, tmp_path):
    """Two attempts of one batch that commit at the same time: readers take the same one.
    An attempt that failed before its commit is never seen."""
    t = _table(spark, tmp_path)
    assert t.commit(spark.createDataFrame([("a", 1)], ROW), "r", order=5)
    for order, attempt, v in ((7, "late", 2), (3, "early", 3)):
        path = f"{t.home}/data/order={order}/batch=r/attempt={attempt}"
        spark.createDataFrame([("a", v)], ROW).write.parquet(path)
        if attempt == "late":
            write_line(spark, f"{t.home}/commits/r-{attempt}", f"{order}\t{attempt}\tr\t{path}")
            assert rows(t.read(), "k", "v") == [("a", 1)]
        assert len(t.commits()) == 1
    assert rows(t.read(), "k", "v") == [("a", 1)]                                # "early" has no commit
    write_line(spark, f"{t.home}/commits/r-early", f"3\tearly\tr\t{t.home}/data/order=3/batch=r/attempt=early")
    assert rows(t.read(), "k", "v") == [("a", 3)]


def test_second_run_asks_nothing(spark, tmp_path):
    match = spark.createDataFrame([("ficus carica", 7, None, "Ficus carica L.", None, "SPECIES", "ACCEPTED", "EXACT",
                                    99, "Plantae", "Moraceae", "Ficus")], MATCH_SCHEMA)
    backbone = spark.createDataFrame([("Olea europaea", 5), ("Ficus carica", 7)], "name string, key long")

    def names(*n):
        return spark.createDataFrame([(x, "lat") for x in n], "input_name string, input_lang string")

    first = names("Ficus carica", "Olea europea", "Olea 'Gold'", "Nothing known")
    store = KeptAnswers(spark, str(tmp_path))
    run = store.run(first, match, backbone, "1")
    assert run.committed and tuple(run.stats.first()) == (5, 1, 4)               # the stripped retry key is asked too
    again = store.run(first, match, backbone, "2")
    assert tuple(again.stats.first()) == (5, 5, 0)
    assert not store.run(names("Quercus"), match, backbone, "1").committed       # replay of batch 1
    kept = store.table.first_wins("name_key")
    assert set(rows(kept, "name_key", "matchType", "usageKey", "batch")) == {
        ("nothing known", "NONE", None, "1"), ("olea", "HIGHERRANK", None, "1"),
        ("olea 'gold'", "HIGHERRANK", None, "1"), ("olea europea", "FUZZY", 5, "1")}
    assert store.gate(first, match).first()["pass"]
    assert not store.gate(names("Quercus"), match).first()["pass"]
    # overlapping runs answered one name twice: the earliest stays, the match table wins over both
    late = responses_for(spark.createDataFrame([("olea europea",), ("ficus carica",)], "name_key string"),
                         spark.createDataFrame([("Olea europaea", 99)], "name string, key long"))
    store.table.commit(late.select(*[F.col(f.name).cast(f.dataType) for f in MATCH_SCHEMA.fields]), "3")
    known = store.known(match)
    assert known.count() == known.select("name_key").distinct().count() == 5
    res = {r.input_name: r.canonical_taxon_id for r in resolve_names(first, known).collect()}
    assert res["Olea europea"] == 5 and res["Ficus carica"] == 7 and res["Nothing known"] is None
