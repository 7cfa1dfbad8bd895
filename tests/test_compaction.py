"""Compaction: same rows, few files, the old version stays live until the swap."""
import pytest
from pyspark.sql import functions as F

from verdant.plans import compaction as C
from verdant.plans import compare
from verdant.plans import publish as P


def test_small_files_become_few(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    df = spark.range(4000).select(F.col("id").cast("string").alias("source_id"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("source"),
                                  F.lit("2026-06-01").cast("date").alias("scraped_at"), F.sha2(F.col("id").cast("string"), 256).alias("value"))
    P.write_eav(df.repartition(24), base)
    before = P.current_path(spark, base, "eav")
    held = P.read_current(spark, base, "eav")
    assert C.files(spark, before).count() == 48
    total = {r.folder.split("/")[-2]: r.b for r in C.files(spark, before).groupBy("folder").agg(F.sum("length").alias("b")).collect()}
    target = total["source=a"] // 3 - 1

    def lost(*a, **k):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(P, "point", lost)
        with pytest.raises(OSError):
            C.compact(spark, base, "eav", ["source", "scraped_at"], target_bytes=target)
    assert P.current_path(spark, base, "eav") == before           # a failed swap leaves the old version

    C.compact(spark, base, "eav", ["source", "scraped_at"], target_bytes=target)
    after = P.current_path(spark, base, "eav")
    assert after != before and compare.equal(P.read_current(spark, base, "eav"), held) and held.count() == 4000
    n = {r.folder.split("/")[-2]: r["count"] for r in C.files(spark, after).groupBy("folder").count().collect()}
    assert n["source=a"] <= 4 and n["source=b"] == 1
    assert compare.equal(P.read_current(spark, base, "eav").select(*df.columns), df)
