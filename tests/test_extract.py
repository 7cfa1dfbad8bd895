from verdant import lookups as L
from verdant.functions import text as T
from verdant.operators import extract as X

PAIR = '<li><span class="prop_name">{k}</span> <span class="prop_data">{v}</span></li>'


def page(*pairs, extra=""):
    return "<html>" + "".join(PAIR.format(k=k, v=v) for k, v in pairs) + extra + "</html>"


def test_clean_orders_differ(spark):
    df = spark.createDataFrame([("&lt;b&gt;x&lt;/b&gt;  &amp; y",)], "s string")
    r = df.select(T.clean_text("s").alias("a"), T.clean_credit("s").alias("b")).first()
    assert r["a"] == "<b>x</b> & y"      # strip, then decode
    assert r["b"] == "x & y"             # decode, then strip


def test_pairs_first_wins_and_empty_label(spark):
    html = page(("שם מדעי:", "Ficus"), ("שם מדעי", "Other"), ("", "dropped"), ("<b>צבע</b>", "לבן &amp; ורוד"))
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r.label, r.value) for r in X.page_pairs(df).orderBy("pos").collect()]
    assert got == [("שם מדעי", "Ficus"), ("צבע", "לבן & ורוד")]


def test_extract_records_outcomes(spark):
    status = ('<div class="prop-img_item"><img src="a" alt="צמח מוגן"></div>'
              '<div class="prop-img_item"><img alt="בסכנת הכחדה"></div>'
              '<div class="prop-img_item"><img alt="צמח מוגן"></div>')
    pages = spark.createDataFrame([
        (1, "u1", page((L.LABEL_NAME_LAT, "Ficus carica"), (L.LABEL_NAME_HE, "תאנה"), extra=status)),
        (2, "u2", page(("אחר", "x"))),
        (3, "u3", "Unauthorized Request Blocked " + page((L.LABEL_NAME_HE, "x"))),
    ], "page_id long, url string, html string")
    recs = {r.source_id: r for r in X.extract_records(pages, "wildflowers", "2026-06-25").collect()}
    assert recs["1"].outcome == "ok" and recs["1"].name_lat == "Ficus carica"
    assert recs["1"].fields[L.LABEL_STATUSES] == "בסכנת הכחדה; צמח מוגן"
    assert recs["2"].outcome == "no_fields"
    assert recs["3"].outcome == "blocked"
    counts = {r.outcome: r.n for r in X.outcome_counts(X.extract_records(pages, "w", "2026-06-25")).collect()}
    assert counts == {"ok": 1, "no_fields": 1, "blocked": 1}


def test_products(spark):
    html = ('<h1 class="product_title entry-title">הדס &amp; מצוי</h1>'
            '<p class="price"><bdi>1,234.50&nbsp;₪</bdi><bdi>9</bdi></p>'
            '<p class="price"><bdi>5</bdi></p> קוטר 17 ס"מ 3 ליטר קוטר 17 ס"מ '
            '<p class="stock out-of-stock">')
    bad = '<h1 class="product_title">x</h1><p class="price"><bdi>1.2.3</bdi></p>'
    notitle = '<p class="price"><bdi>5</bdi></p>'
    df = spark.createDataFrame([("a", "http://s/%D7%97+1", "c", html), ("b", "u", "c", bad),
                                ("c", "u", "c", notitle)],
                               "source_id string, url string, category string, html string")
    got = {r.source_id: r for r in X.extract_products(df, "azur", "2026-06-25").collect()}
    a = got["a"]
    assert a.name_he == "הדס & מצוי" and a.price == 1234.5 and a.availability == "out_of_stock"
    assert a.pot_sizes == ['3 ליטר', 'קוטר 17 ס"מ'] and a.url == "http://s/ח+1"
    assert got["b"].price is None and got["b"].availability == "in_stock"
    assert got["c"].outcome == "no_name"
