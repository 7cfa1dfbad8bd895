"""Steps whose cost must not grow faster than their rows."""
import glob
import random
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from verdant.functions import udf
from verdant.operators import homonyms as H
from verdant.operators import matcher as M
from verdant.operators import near
from verdant.operators import staging as S
from verdant.plans import compaction as C
from verdant.plans import publish as P
from verdant.plans import store_queries, surface_queries
from verdant.plans.store_inputs import doc_parts, word

from helpers import rows


def _write_docs(spark, path, n=240, files=3):
    rng = random.Random(9)
    kinds = [None, "", " ", "One", "one two", "Été, the\nthird piece", "a  b", "x1 y2 z3 w4"]
    data = [(i if i % 40 else None, None if i % 11 == 0 else rng.choice(["en", "de", "fr"]),
             rng.choice(kinds), rng.randint(0, 90)) for i in range(n)]
    data += data[:7]
    spark.createDataFrame(data, "doc_id long, lang string, text string, n_chars long").repartition(files) \
        .write.parquet(f"{path}/documents.parquet")
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 0, 1, None])) for i in range(0, n, 2)] + [(None, 0, 1), (4, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_names_of_one_family_meet_only_if_near(spark):
    rng = random.Random(8)
    known = sorted({"small widget " + "".join(rng.choices("abcdefghijklmnopqrst", k=7)) for _ in range(400)})
    asked = [n[0] + n[2] + n[1] + n[3:] for n in known]
    qs = spark.createDataFrame([(x,) for x in asked], "q string")
    bs = spark.createDataFrame([(x,) for x in known], "b string")
    for d in (1, 2):
        met = set(rows(near._meet(qs, bs, d, H._by_segments)))
        assert {(a, b) for a, b in zip(asked, known)} <= met and len(met) <= 3 * len(known)   # before: 400 * 400
    got = rows(H.match_near(qs.select(F.col("q").alias("input_name")), bs.select(F.col("b").alias("name")), 1))
    assert got == sorted(((a, b, 1) for a, b in zip(asked, known)), key=repr)


def test_near_names_of_every_length(spark):
    rng = random.Random(2)
    known = sorted({"".join(rng.choices("ab c", k=n)).strip() for n in [0, 1, 1, 2, 3, *range(37, 46), *range(37, 46), 90]} - {""})
    asked = set()
    for n in known:
        for _ in range(4):
            s = list(n)
            for _ in range(rng.randint(0, 3)):
                i, op = rng.randrange(len(s) + 1), rng.random()
                if op < .3:
                    s.insert(i, rng.choice("abz"))
                elif i < len(s) and op < .6:
                    del s[i]
                elif i + 1 < len(s):
                    s[i], s[i + 1] = s[i + 1], s[i]
            asked.add(" ".join("".join(s).split()))
    q = spark.createDataFrame([(a,) for a in asked], "input_name string")
    b = spark.createDataFrame([(n, i) for i, n in enumerate(known)], "name string, key long")
    for k in (1, 2, 3):
        want = set()
        for a in asked:
            d = {n: H.damerau(a, n) for n in known}
            want |= {(a, n, x) for n, x in d.items() if x <= k and x == min(d.values())}
        assert set(rows(H.match_near(q, b, k))) == want, k


def test_pieces_of_a_text(spark):
    texts = ["", " ", "a", "a b", " a b", "a  b c", "x\ny z\nw q", "Été über-x 3z", "ab" * 300]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    for i in (1, 2, 3):
        old = F.lower(F.regexp_replace(F.split_part(F.coalesce("t", F.lit("")), F.lit(" "), F.lit(i)), "[^A-Za-z]", ""))
        assert df.where(~old.eqNullSafe(word(F.col("t"), i))).count() == 0


def test_listed_names_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    _write_docs(spark, str(tmp_path))
    monkeypatch.setattr(store_queries, "work_dir", lambda s: f"{tmp_path}/out")
    got = store_queries.listed_names(spark, str(tmp_path))
    assert len(glob.glob(f"{tmp_path}/out/list/part-*")) > 1
    names = {r.name for r in doc_parts(spark.read.parquet(f"{tmp_path}/documents.parquet")).select(F.trim("p_name").alias("name")).collect()}
    review = {r.name for r in got.where("reason is not null").collect()}
    keyed = got.where("reason is null").count()
    assert review < names and 0 < keyed <= len(names) - len(review)


def test_compaction_does_not_sort_a_bin(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    df = spark.range(300).select(F.col("id").cast("string").alias("source_id"), F.when(F.col("id") % 9 == 0, "b").otherwise("a").alias("source"),
                                 F.lit("2026-06-01").cast("date").alias("scraped_at"))
    P.write_eav(df.repartition(6), base)
    seen, write = [], P.write_version
    monkeypatch.setattr(P, "write_version", lambda *a, **k: (seen.append(spark.conf.get(C.WRITERS)), write(*a, **k))[1])
    before = spark.conf.get(C.WRITERS)
    C.compact(spark, base, "eav", ["source", "scraped_at"])
    assert seen == [str(C.OPEN_FILES)] and spark.conf.get(C.WRITERS) == before
    assert rows(P.read_current(spark, base, "eav"), *df.columns) == rows(df)


def test_pivot_deals_rows_before_it_sorts_them(spark):
    eav = spark.range(900).select(
        F.lit("s").alias("source"), F.when(F.col("id") < 600, "hot").otherwise((F.col("id") % 40).cast("string")).alias("source_id"),
        F.lit("h").alias("raw_name_he"), F.lit("l").alias("raw_name_lat"), F.concat(F.lit("a"), F.col("id") % 3).alias("attribute"),
        F.format_string("%05d", "id").alias("value"), F.lit("2026-01-01").cast("date").alias("scraped_at"))
    out = S.pivot_records(eav, ["a0", "a1", "missing"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    got = {r.source_id: (r.a0, r.a1, r.missing) for r in out.collect()}
    assert len(got) == 41 and got["hot"] == ("00000", "00001", None)


def test_nfkc_by_slices():
    rng = random.Random(1)
    texts = [None, "", "plain", "ﬁne é", "Å", "…"] + ["".join(chr(rng.randint(32, 0x2FFF)) for _ in range(90)) for _ in range(200)]
    want = [t if t is None else unicodedata.normalize("NFKC", t) for t in texts]
    for size in (1, 500, 1 << 20):
        assert udf.nfkc_slices(pa.array(texts), size).to_pylist() == want
    assert udf.nfkc_slices(pa.array([], pa.string())).to_pylist() == []


def test_table_changes_reads_texts_once(spark, tmp_path):
    _write_docs(spark, str(tmp_path))
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    moved, gone = ({r.doc_id for r in labels.where(c).collect()} - {None} for c in ("quality = 0", "toxic = 1"))
    own, other = (doc_parts(docs, i) for i in (1, 3))
    ids = F.col("p_partkey")
    hit = lambda s: F.coalesce(ids.isin(sorted(s)), F.lit(False))
    right = (own.where(~hit(moved) & ~hit(gone)).unionByName(other.where(hit(moved) & ~hit(gone)))
             .unionByName(doc_parts(docs.where("lang = 'de'"))))
    from collections import Counter
    cols = sorted(own.columns)
    a, b = (Counter(tuple(r) for r in x.select(*cols).collect()) for x in (own, right))
    want = {(*k, a[k], b[k]) for k in a | b if a[k] != b[k]}
    got = surface_queries.table_changes(spark, str(tmp_path))
    assert set(rows(got, *cols, "n_left", "n_right")) == want and want
    files = " ".join(got.inputFiles())
    assert "documents.parquet" not in files


def test_build_keeps_what_several_sinks_read(spark):
    from verdant.plans.build import build_catalog
    from verdant.plans.demo_inputs import PARTS_PROFILE, match_table
    from verdant.plans.store_inputs import eav_of
    docs = spark.createDataFrame([(1, "en", "One", 3)], "doc_id long, lang string, text string, n_chars long")
    seen = []
    made = build_catalog(eav_of(doc_parts(docs)), match_table(doc_parts(docs)), None, PARTS_PROFILE,
                         keep=lambda df: (seen.append(df.columns), df)[1])
    assert len(seen) == 3 and "reason" in seen[1] and "scientific_name" in seen[2]      # pivoted, resolved, reconciled
    assert made.resolved.columns == seen[1]
