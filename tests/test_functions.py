from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.functions import display as D
from verdant.functions import enums as E
from verdant.functions import text as T


def one(spark, col_expr, values, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col_expr).collect()]


def test_normalize_name_nfkc_ws_and_null(spark):
    out = one(spark, T.normalize_name(F.col("s")),
              ["  Quercus  calliprinos ", "ﬁcus", None, "a\tb\nc"])
    assert out == ["Quercus calliprinos", "ficus", "", "a b c"]


def test_is_latin(spark):
    out = one(spark, T.is_latin(F.col("s")), ["Ficus", "אלון", "Ficus אלון", "123"])
    assert out == [True, False, False, False]


def test_strip_cultivar(spark):
    out = one(spark, T.strip_cultivar(F.col("s")), ["Rosa 'Iceberg'", 'Olea "Nabali" x', "Plain"])
    assert out == ["Rosa", "Olea x", "Plain"]


def test_bare_forms(spark):
    df = spark.createDataFrame([("Quercus Calliprinos Webb",), ("Ficus",), (None,)], "s string")
    got = df.select(T.bare_binomial("s"), T.bare_name("s")).collect()
    assert [tuple(r) for r in got] == [("quercus calliprinos", "Quercus Calliprinos"),
                                       ("ficus", "Ficus"), ("", "")]


def test_norm_local_name(spark):
    # marks removed, maqaf (inside the marks range) joins, hyphen splits, pot tokens blanked
    out = one(spark, T.norm_local_name(F.col("s")),
              ["הָדָס מצוי", "רב־שנתי", "רב-שנתי", "הדס קוטר 17 ס\"מ", "(בשרני)", None])
    assert out == ["הדס מצוי", "רבשנתי", "רב שנתי", "הדס", "בשרני", ""]


def test_url_decode_keeps_plus(spark):
    out = one(spark, T.url_decode_literal_plus(F.col("s")), ["a%20b+c", "%D7%97"])
    assert out == ["a b+c", "ח"]


def test_file_name(spark):
    out = one(spark, T.file_name(F.col("s")),
              ["http://x/wiki/Special:FilePath/Rosa%20canina.jpg", "http://x/other.jpg"])
    assert out == ["Rosa canina.jpg", None]


def test_ordered_enum_uses_map_order(spark):
    out = one(spark, E.ordered_enum(F.col("s"), L.LIFE_FORM_MAP), ["עשב עץ", "עשבוני", "", None, "x"])
    # 'עץ' precedes 'עשב' in the map although it appears later in the text
    assert out == ["tree", "perennial", None, None, None]


def test_split_regions_notes_commas_unknown(spark):
    rz = {"a": "z1", "b": "z2", "c": "z1"}
    out = one(spark, E.split_regions(F.col("s"), rz),
              ["a (note), b", "a (x, y), b", "b، a، b", "zz, c", None])
    # a note holding a comma loses its region (split happens first)
    assert out == [["a", "b"], ["b"], ["b", "a"], ["c"], []]
    out = one(spark, E.zones(E.split_regions(F.col("s"), rz), rz), ["c, b, a"])
    assert out == [["z1", "z2"]]


def test_statuses_and_flags(spark):
    df = spark.createDataFrame([("צמח מוגן; ;צמח רעיל",), (None,)], "s string")
    st = E.split_statuses(F.col("s"))
    got = df.select(st.alias("st"), *E.status_flags(st, L.STATUS_MAP)).collect()
    assert got[0]["st"] == ["צמח מוגן", "צמח רעיל"]
    assert got[0]["protected"] and got[0]["poisonous"] and not got[0]["nectar"]
    assert got[1]["st"] == [] and not any(got[1][f] for f in L.STATUS_FLAGS)


def test_price_band_half_open(spark):
    out = one(spark, E.price_band(F.col("p")), [None, 39.99, 40.0, 99.9, 100.0, 200.0],
              schema="p double")
    assert out == [None, "budget", "mid", "mid", "premium", "luxury"]


def test_list_text_null_vs_empty(spark):
    df = spark.createDataFrame([(None,), ([],), (["a", None, "b"],)], "l array<string>")
    assert [r[0] for r in df.select(D.list_text("l", ", ")).collect()] == [None, "", "a, b"]


def test_bloom_short_and_badge(spark):
    out = one(spark, D.bloom_short(F.col("s")), ["ינואר, פברואר, מרץ, אפריל", "מרץ אפריל", "", None])
    assert out == ["ינואר–אפריל", "מרץ, אפריל", "—", "—"]
    df = spark.createDataFrame([(True, "listed", True), (False, "potential", True),
                                (False, "not_listed", True), (False, "not_listed", False)],
                               "r boolean, i string, p boolean")
    assert [x[0] for x in df.select(D.badge("r", "i", "p")).collect()] == ["red", "potential", "prot", None]
