"""Plan-shape guards for every registered query (no execution of the query itself)."""
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from verdant.plans import publish as P  # noqa: E402

SF = "/root/testdata/sf0.001"
# their jobs run while the query is built: the plans of these are guarded by their own test modules
BUILT = {"full_build", "full_build_provenance", "full_build_review", "full_build_gates", "lookup_entity", "lookup_provenance",
         "incremental_rebuild", "incremental_review", "second_run", "facet_keys", "ranked_rows", "compacted_eav",
         "snapshots_staged", "labelled_gate"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "CollectLimit")


def test_no_pairwise_joins_or_windows(spark):
    if not os.path.isdir(SF):
        return
    for name, q in E.QUERIES.items():
        if name in BUILT:
            continue
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for bad in FORBIDDEN:
            assert bad not in plan, (name, bad)


def test_scans_are_pruned(spark):
    if not os.path.isdir(SF):
        return
    plan = E.queries()["price_bands"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_comment" not in plan


def test_csv_and_json_sinks(spark):
    base = tempfile.mkdtemp(prefix="verdant-sink-")
    df = spark.createDataFrame([("2", "b", None), ("10", "a", 1.5)], "source_id string, name string, price double")
    P.write_csv(df, base, "review", order_by=["source_id"])
    back = P.read_current(spark, base, "review", fmt="csv", header=True,
                          schema="source_id string, name string, price double")
    assert sorted(map(tuple, back.collect())) == [("10", "a", 1.5), ("2", "b", None)]
    P.write_json(df, base, "snap", partition_by=["name"])
    j = P.read_current(spark, base, "snap", fmt="json")
    assert sorted(r.source_id for r in j.collect()) == ["10", "2"]
    P.write_eav(spark.createDataFrame([("w", "1", "a", "v", None)],
                                      "source string, source_id string, attribute string, value string, "
                                      "scraped_at date"), base)
    assert P.read_current(spark, base, "eav").count() == 1


def test_offers_are_scanned_once(spark):
    """The final plans of the offer queries read the line items once: names and index are made before."""
    if not os.path.isdir(SF):
        return
    for name in ("offers_by_key", "precedence", "conflicts", "match_exact", "unmatched_offers"):
        plan = E.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("l_returnflag") > 0 and sum("Scan parquet" in x and "l_returnflag" in x for x in plan.split("\n")) == 1, name
    assert "tok" not in E.QUERIES["match_exact"](spark, SF)._jdf.queryExecution().executedPlan().toString()
