"""STG1 -> STG3 -> REC1: batch by batch equals a rebuild."""
import random

import pytest

from verdant import lookups as L
from verdant.operators.staging import EAV_COLUMNS
from verdant.plans.incremental import CatalogStore
from verdant.sources.services import MATCH_SCHEMA

EAV = ", ".join(f"{c} string" for c in EAV_COLUMNS)
IDS = "source string, source_id string"


def _record(rng, i, name):
    forms = [None, "עץ", "שיח", "עשבוני חד-שנתי"]
    day = f"2026-06-{rng.randint(1, 28):02d}"
    fields = {L.LABEL_NAME_HE: f"h{rng.randint(0, 9)}", L.LABEL_LIFE_FORM: rng.choice(forms), "x": str(i)}
    return [("w", str(i), fields[L.LABEL_NAME_HE], name, k, v, "{}", day) for k, v in fields.items()]


def _content(df):
    """Rows as text: lists keep their order, rows do not."""
    return sorted(str(r.asDict()) for r in df.collect())


@pytest.fixture
def match(spark):
    return spark.createDataFrame(
        [(f"genus species{k}", k + 1, None, f"Genus species{k}", None, "SPECIES", "ACCEPTED", "EXACT", 99, "Plantae",
          "F", "Genus") for k in range(30)], MATCH_SCHEMA)


def test_increments_equal_a_rebuild(spark, tmp_path, match):
    rng = random.Random(4)
    name = lambda: f"Genus species{rng.choice([0, 0, 0, *range(34)])}"  # noqa: E731 - a hot key, some unknown names
    store = CatalogStore(spark, str(tmp_path), match, slots=16)
    live: dict[int, str] = {}
    before = None
    for step in range(4):
        new, gone = [], []
        if step == 0:
            for i in range(60):
                live[i] = name()
                new += _record(rng, i, live[i])
        else:
            for i in rng.sample(sorted(live), 6):                # moved: withdrawn and scraped anew
                gone.append(i)
                live[i] = name()
                new += _record(rng, i, live[i])
            for i in rng.sample(sorted(live), 4):                # deleted
                if i not in gone:
                    gone.append(i)
                    del live[i]
            for i in range(100 * step, 100 * step + 3):          # added
                live[i] = name()
                new += _record(rng, i, live[i])
            i = rng.choice([i for i in live if i < 60 and i not in gone])
            new.append(("w", str(i), "late", live[i], "x", "late", "{}", "2026-07-01"))   # a later snapshot of a record
        eav = spark.createDataFrame(new, EAV)
        ids = spark.createDataFrame([("w", str(i)) for i in gone], IDS)
        assert store.apply(f"b{step}", eav, ids)
        assert not store.apply(f"b{step}", eav, ids)             # applied once
        now = store.state()
        assert _content(store.reconciled()) == _content(store.rebuilt())
        known = {i for i, n in live.items() if int(n.removeprefix("Genus species")) < 30}
        assert store.canonical().count() == len({live[i] for i in known})
        assert {r.source_id for r in store.review().collect()} == {str(i) for i in live if i not in known}
        if before is not None:                                   # slots that were not touched keep their files
            assert 0 < len(now.touched) < 16
            for s in set(before.spine) - set(now.touched):
                assert now.spine[s] == before.spine[s]
            assert all(now.spine[s] != before.spine.get(s) for s in now.touched if s in now.spine)
        before = now


def test_a_failed_batch_leaves_the_old_state(spark, tmp_path, match, monkeypatch):
    rng = random.Random(1)
    store = CatalogStore(spark, str(tmp_path), match, slots=4)
    rows = [x for i in range(8) for x in _record(rng, i, f"Genus species{i}")]
    store.apply("a", spark.createDataFrame(rows, EAV))
    old = _content(store.reconciled())
    moved = spark.createDataFrame(_record(rng, 1, "Genus species9"), EAV)
    ids = spark.createDataFrame([("w", "1")], IDS)
    monkeypatch.setattr(store.spine, "rewrite", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.apply("b", moved, ids)
    monkeypatch.undo()
    again = CatalogStore(spark, str(tmp_path), match, slots=4)
    assert _content(again.reconciled()) == _content(again.rebuilt()) == old and again.state().batch == "a"
    other = spark.createDataFrame(_record(rng, 1, "Genus species20"), EAV)      # a later batch goes first
    assert again.apply("b2", other, ids)
    assert _content(again.reconciled()) == _content(again.rebuilt()) != old
    late = _content(again.reconciled())
    assert again.apply("b", moved, ids)                          # the retry finishes the batch, its rows count once
    assert _content(again.reconciled()) == _content(again.rebuilt()) == late    # and are older than those of b2
    again.apply("c", moved.limit(0), spark.createDataFrame([("w", str(i)) for i in range(8)], IDS))
    assert again.canonical().count() == 0 and again.state().spine == {}


def test_only_touched_slots_are_read(spark, tmp_path, match):
    rng = random.Random(2)
    store = CatalogStore(spark, str(tmp_path), match, slots=16)
    store.apply("a", spark.createDataFrame([x for i in range(40) for x in _record(rng, i, f"Genus species{i % 30}")], EAV))
    store.apply("b", spark.createDataFrame(_record(rng, 50, "Genus species3"), EAV))
    s = store.state()
    assert len(s.touched) == 1
    files = store.spine.read(s.spine, store.spine_schema, s.touched).inputFiles()
    assert files and all(f"/slot={s.touched[0]}/" in f for f in files)
