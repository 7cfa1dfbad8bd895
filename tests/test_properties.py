"""Property tests: reconciliation does not depend on input order."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.operators import reconcile as R

P = L.REFERENCE_PROFILE
WORDS = ["גליל", "כרמל", "שרון", "ערבה", "x"]
STATUSES = ["צמח מוגן", "צמח רעיל", "אחר"]

record = st.tuples(
    st.integers(min_value=1, max_value=3),                       # key
    st.sampled_from(["", None, "עץ", "שיח", "עשב"]),             # life form text
    st.lists(st.sampled_from(WORDS), max_size=3),                # regions
    st.lists(st.sampled_from(STATUSES), max_size=2),             # statuses
    st.sampled_from(["", None, "a", "b"]),                       # arabic name
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(record, min_size=1, max_size=12), st.randoms())
def test_reconcile_is_order_independent(spark, recs, rnd):
    labels = P.labels
    rows = []
    for i, (key, lf, regs, sts, ar) in enumerate(recs):
        attrs = {L.LABEL_LIFE_FORM: lf, L.LABEL_DISTRIB: ", ".join(regs),
                 L.LABEL_STATUSES: "; ".join(sts), L.LABEL_NAME_AR: ar}
        rows.append((str(i * 37 % 101), "wildflowers", key, f"Sci {key}", "F", "G", 90, f"he{i}",
                     f"Lat{i} sp", *[attrs.get(lab) for lab in labels]))
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    schema = ("source_id string, source string, canonical_taxon_id long, scientific_name string, "
              "family string, genus string, confidence int, name_he string, name_lat string, ") + \
        ", ".join(f"`{lab}` string" for lab in labels)
    a = R.canonical_table(R.reconcile(spark.createDataFrame(rows, schema), None, P))
    b = R.canonical_table(R.reconcile(spark.createDataFrame(shuffled, schema).repartition(3, F.rand(1)), None, P))
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
