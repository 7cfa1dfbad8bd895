"""Damerau distance, near names and homonyms."""
import random

import duckdb

from verdant.operators import homonyms as H

from helpers import rows


def test_distance_against_another_engine():
    rng = random.Random(4)
    pairs = [("", ""), ("ca", "abc"), ("ab", "ba"), ("abcd", "badc"), ("a", "")]
    pairs += [("".join(rng.choices("abc", k=rng.randint(0, 7))), "".join(rng.choices("abc", k=rng.randint(0, 7)))) for _ in range(400)]
    con = duckdb.connect()
    for a, b in pairs:
        assert H.damerau(a, b) == con.execute("SELECT damerau_levenshtein(?, ?)", [a, b]).fetchall()[0][0], (a, b)


def test_near_names_against_brute_force(spark):
    rng = random.Random(6)
    back = sorted({"".join(rng.choices("abcd", k=rng.randint(1, 9))) + rng.choice(["", " xy"]) for _ in range(150)})
    asked = []
    for n in back[::3]:
        s = list(n)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(s))
            if rng.random() < .5 and i + 1 < len(s):
                s[i], s[i + 1] = s[i + 1], s[i]
            else:
                s[i] = rng.choice("abcd")
        asked.append("".join(s))
    asked.append("Quite another name")
    q = spark.createDataFrame([(a,) for a in asked], "input_name string")
    b = spark.createDataFrame([(n, 1) for n in back], "name string, key int")
    for k in (1, 2):
        want = set()
        for a in set(asked):
            norm = " ".join(a.lower().split())
            d = {n: H.damerau(norm, n.lower()) for n in back}
            want |= {(a, n, x) for n, x in d.items() if x <= k and x == min(d.values())}
        assert set(rows(H.match_near(q, b, k))) == want
    swapped = H.match_near(spark.createDataFrame([("Qeurcus ilex",)], "input_name string"),
                           spark.createDataFrame([("Quercus ilex", 1)], "name string, key int"), 1)
    assert rows(swapped) == [("Qeurcus ilex", "Quercus ilex", 1)]


def test_homonyms_are_chosen_by_context(spark):
    back = spark.createDataFrame([
        ("Oenanthe", 1, "Animalia", "Muscicapidae", "ACCEPTED"), ("Oenanthe", 2, "Plantae", "Apiaceae", "ACCEPTED"),
        ("Oenanthe", 3, "Plantae", "Apiaceae", "SYNONYM"), ("Ficus", 9, None, None, "ACCEPTED")],
        "name string, key long, kingdom string, family string, status string")
    asked = spark.createDataFrame([
        ("a", "Oenanthe", "Plantae", None), ("b", "Oenanthe", "Animalia", None), ("c", "Oenanthe", None, None),
        ("d", "Oenanthe", "Plantae", "Muscicapidae"), ("e", "Ficus", "Plantae", "Moraceae"), ("f", "Unknown", None, None)],
        "input_name string, name string, kingdom string, family string")
    got = {r.input_name: (r.key, r.n_best) for r in H.choose(asked, back).collect()}
    assert got == {"a": (2, 2), "b": (1, 1), "c": (1, 3), "d": (1, 1), "e": (9, 1)}
