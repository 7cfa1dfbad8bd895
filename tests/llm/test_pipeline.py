"""The pipeline: stage by stage against brute-force versions, on planted rows."""
import random
import sys

import corpus_pipeline as C

from verdant.llm import packing
from verdant.llm.decontaminate import words_of

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from test_models import PATH, check_packing  # noqa: E402
from test_text_ops import SYL, base  # noqa: E402

EN = "the of and to in a is that it for was on with as are be".split()


def text(rng, n):
    return " ".join(rng.choice(EN) if rng.random() < .4 else "".join(rng.choice(SYL) for _ in range(rng.randint(2, 4)))
                    for _ in range(n))


def test_stages(spark, tmp_path):
    rng = random.Random(12)
    clean = {i: "\n".join(text(rng, rng.randint(20, 60)) for _ in range(rng.randint(3, 6))) for i in range(60)}
    docs = dict(clean)
    passage = text(rng, 70)
    for i in range(100, 105):                                    # a passage that repeats across documents
        docs[i] = text(rng, 90) + "\n" + passage + "\n" + text(rng, 80)
    near = text(rng, 200)
    for i in range(110, 116):                                    # near copies in one line each
        w = near.split()
        w[rng.randrange(200)] = f"edit{i}"
        docs[i] = " ".join(w)
    item = text(rng, 40)
    docs[120] = text(rng, 80) + " " + item + " " + text(rng, 60)
    docs[130] = " ".join(["spam spam spam"] * 40)                # base rule
    docs[131] = "short text"
    docs[132], docs[133] = None, ""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs.items()]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    d.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    state = d
    seen = {}
    for name, stage in C.STAGES:
        state = stage(spark, state, sf)
        path = f"{sf}/{name}"
        state.write.parquet(path)
        state = spark.read.parquet(path)
        if name != "packing":
            assert state.columns == d.columns
            seen[name] = {r.doc_id: r.text for r in state.collect()}
    kept = seen["quality_rules"]
    assert set(kept) == {i for i, t in docs.items() if not base(t)[5]} and all(kept[i] == docs[i] for i in kept)
    lines = seen["line_dedup"]
    assert all(lines[i] == clean[i] for i in clean if i in kept)  # clean documents stay as they are
    assert sum(passage in lines.get(i, "") for i in range(100, 105)) == 1
    assert sum(i in lines for i in range(110, 116)) == 1          # whole-text lines: copies go with their lines
    assert set(seen["ngram_jaccard"]) == set(lines)
    left = seen["decontamination"]
    assert set(lines) - set(left) == {120} and " ".join(words_of(item)) not in " ".join(words_of(left.get(120)))
    check_packing(state.collect(), [(i, t) for i, t in left.items()])
    again = C.run(spark, sf)
    assert again.columns == state.columns and again.count() == state.count()


def test_near_copies_stage_alone(spark):
    rng = random.Random(2)
    one = text(rng, 300)
    rows = [(i, " ".join([*one.split()[:150], f"x{i}", *one.split()[151:]])) for i in range(5)] + [(9, text(rng, 300))]
    d = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                              "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in C.near_copies(spark, d, "")  .collect()) == [0, 9]


def test_near_copies_stage_takes_five_words_and_eighty_percent(spark):
    """Pairs at a 5-word similarity between 0.80 and 0.82, whose 4-word one is under 0.85."""
    def jaccard(a, b, n):
        a, b = ({tuple(t[i:i + n]) for i in range(len(t) - n + 1)} for t in (a, b))
        return len(a & b) / len(a | b)

    rows = []
    for k, (n, edits) in enumerate([(1000, 21), (1000, 22), (50, 1), (1000, 24)]):
        one = [f"w{k}x{i}" for i in range(n)]
        two = list(one)
        for e in range(edits):
            two[(2 * e + 1) * n // (2 * edits)] = f"edit{k}x{e}"
        assert .80 <= jaccard(one, two, 5) < .82 and jaccard(one, two, 4) < .85 or k == 3 and jaccard(one, two, 5) < .8
        rows += [(10 * k, " ".join(one), "en", "s", 1), (10 * k + 1, " ".join(two), "en", "s", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in C.near_copies(spark, d, "").collect()) == [0, 10, 20, 30, 31]


def test_empty_documents(spark):
    d = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in C.STAGES[:3]:
        assert stage(spark, d, "").count() == 0
    assert packing.pack(d, PATH).count() == 0
