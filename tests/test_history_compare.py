"""Value history as of a day, and table comparison."""
import datetime as dt
import random

from pyspark.sql import functions as F

from verdant.operators import history as H
from verdant.operators.staging import EAV_COLUMNS
from verdant.plans import compare as C

from helpers import rows

EAV = ", ".join(f"{c} string" for c in EAV_COLUMNS)


def _eav(spark):
    rng = random.Random(2)
    out = []
    for i in range(12):
        for a in ("x", "y"):
            for day in rng.sample(range(1, 29), rng.randint(1, 9)):
                for _ in range(rng.choice([1, 1, 2])):           # a date with two values
                    v = rng.choice([None, "p", "q", "q"])
                    out.append(("s", str(i), None, None, a, v, "{}", f"2026-06-{day:02d}"))
    out += [("s", "0", None, None, "z", "undated", "{}", None)] * 3
    return spark.createDataFrame(out, EAV)


def test_as_of_equals_staging_up_to_the_day(spark):
    eav = _eav(spark)
    hist = H.intervals(eav).persist()
    for day in ("2026-05-31", "2026-06-01", "2026-06-09", "2026-06-17", "2026-06-28", "2027-01-01"):
        assert rows(H.as_of(hist, day), *H.RECORD, "value") == rows(H.latest(eav, day), *H.RECORD, "value"), day
    # intervals of a value do not touch: equal neighbours are one interval
    by = {}
    for r in hist.collect():
        by.setdefault((r.source_id, r.attribute), []).append(r)
    for rs in by.values():
        rs.sort(key=lambda r: r.valid_from)
        for a, b in zip(rs, rs[1:]):
            assert a.valid_to == b.valid_from and a.value != b.value
        assert rs[-1].valid_to is None and all(r.snapshots >= 1 for r in rs)
    assert len(by) == 25


def test_as_of_join(spark):
    hist = H.intervals(_eav(spark))
    asked = spark.createDataFrame([("s", str(i), a, dt.date(2026, 6, d), i) for i in range(13) for a in ("x", "z") for d in (1, 15)],
                                  "source string, source_id string, attribute string, day date, tag int")
    got = H.as_of_each(asked, hist)
    assert got.count() == asked.count()
    for day in (1, 15):
        d = dt.date(2026, 6, day)
        want = rows(H.as_of(hist, d), "source_id", "attribute", "value")
        have = rows(got.where((F.col("day") == d) & F.col("value").isNotNull()), "source_id", "attribute", "value")
        assert have == [w for w in want if w[1] in ("x", "z") and w[2] is not None]


def _numbers(spark, values):
    return spark.createDataFrame([(k, None if k % 7 == 0 else str(v)) for k, v in values], "k long, v string")


def test_differences_are_the_planted_changes(spark):
    base = [(i, i * i) for i in range(5000)] + [(3, 9)] * 4       # a row five times
    other = list(base)
    other[10] = (10, -1)                                          # changed
    other.remove((2500, 2500 ** 2))                               # lost
    other.remove((3, 9))                                          # one copy lost
    other += [(9999, 1), (8, 64), (7, 5)]                         # added, a second copy, a second null
    a, b = _numbers(spark, base).repartition(5), _numbers(spark, random.Random(1).sample(other, len(other)))
    want = [(3, "9", 5, 4), (7, None, 1, 2), (8, "64", 1, 2), (10, "-1", 0, 1), (10, "100", 1, 0), (2500, "6250000", 1, 0),
            (9999, "1", 0, 1)]
    assert rows(C.differences(a, b.select("v", "k")), "k", "v", "n_left", "n_right") == sorted(want, key=repr)
    assert not C.equal(a, b) and C.equal(a, _numbers(spark, reversed(base)))
    assert C.differences(a, a).count() == 0
    empty = a.limit(0)
    assert C.equal(empty, empty) and C.differences(empty, a).count() == a.distinct().count()


def test_many_differences_take_the_join(spark, monkeypatch):
    monkeypatch.setattr(C, "LISTED", 3)
    a, b = _numbers(spark, [(i, 1) for i in range(300)]), _numbers(spark, [(i, 2) for i in range(300)])
    got = C.differences(a, b)
    assert got.count() == 2 * 257 and "LeftSemi" in got._jdf.queryExecution().executedPlan().toString()


def test_equal_tables_cost_one_aggregate(spark):
    a = _numbers(spark, [(i, 1) for i in range(50)])
    plan = C._differing(C._hashes(a), C._hashes(a), "_b1")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("partial_sum") >= 2
