"""Registered queries that keep state: match answers between runs, the
incremental rebuild.  Each builds its tables in a new folder under the shared
one (:func:`verdant.session.work_dir`) and reads its result from them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from verdant.lookups import OCCURRENCE_LIMIT
from verdant.operators import resolve as RS
from verdant.operators import staging as S
from verdant.operators import status as ST
from verdant.operators.homonyms import choose, match_near
from verdant.operators.offers import offer_provenance
from verdant.plans import gates as G
from verdant.plans import publish as P
from verdant.plans import published
from verdant.plans.answers import KeptAnswers
from verdant.plans.compaction import compact
from verdant.plans.demo_inputs import PARTS_PROFILE, SELLER, match_table, offers, part_records, table
from verdant.plans.demo_queries import _lists_as_text
from verdant.plans.gates import second_run_gate
from verdant.plans.incremental import CatalogStore
from verdant.plans.store_inputs import build_inputs, changes, doc_parts, eav_of, known_names, record_ids, typo
from verdant.plans.surface import lookup, provenance_of
from verdant.session import work_dir, written
from verdant.sources import snapshots as SN


def _parts(spark, sf):
    """The documents' part-like rows, made once from their texts."""
    return written(doc_parts(table(spark, sf, "documents")), "parts")


def _answered(spark, sf):
    """Two runs over misspelt names: the English documents', then (after a replay
    of the first run) all documents'."""
    parts = _parts(spark, sf)
    match = match_table(parts)
    backbone = parts.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("key"))

    def asked(of):
        return of.select(typo(F.col("p_name")).alias("input_name"), F.lit("lat").alias("input_lang"))

    store = KeptAnswers(spark, work_dir(spark))
    first = store.run(asked(parts.where("p_brand = 'Brand#en'")), match, backbone, "a", PARTS_PROFILE)
    if store.run(asked(parts), match, backbone, "a", PARTS_PROFILE).committed:
        raise RuntimeError("a replayed batch was committed")
    second = store.run(asked(parts), match, backbone, "b", PARTS_PROFILE)
    return store, first, second, asked(parts), match


def kept_answers(spark, sf):
    """RES7: the answers kept after two runs and a replay, with the batch that gave them."""
    store, *_ = _answered(spark, sf)
    return store.table.first_wins("name_key").select("name_key", "usageKey", "scientificName", "matchType",
                                                     "confidence", "batch")


def second_run(spark, sf):
    """GAT5: the counters of both runs, and of a third one that must ask nothing."""
    store, first, second, names, match = _answered(spark, sf)
    runs = [second_run_gate(first.stats), second_run_gate(second.stats), store.gate(names, match, PARTS_PROFILE)]
    out = [df.withColumn("run", F.lit(i + 1)) for i, df in enumerate(runs)]
    return out[0].unionByName(out[1]).unionByName(out[2])


def _catalog_store(spark, sf):
    """The catalogue after all batches of :func:`~verdant.plans.store_inputs.changes`."""
    store = CatalogStore(spark, work_dir(spark), known_names(spark, sf), PARTS_PROFILE)
    for batch, parts, gone in changes(spark, sf):
        store.apply(batch, eav_of(parts), None if gone is None else record_ids(gone))
    return store


def incremental_rebuild(spark, sf):
    """STG1 -> STG3 -> RES -> REC1 batch by batch: the spine after the last one."""
    return _lists_as_text(_catalog_store(spark, sf).canonical())


def incremental_review(spark, sf):
    """RES6 after the last batch: the review queue."""
    return _catalog_store(spark, sf).review()


def _published(spark, sf):
    """The whole build over published tables (a bucket count for small tables)."""
    return published.build(spark, work_dir(spark), build_inputs(spark, sf, OCCURRENCE_LIMIT), PARTS_PROFILE, buckets=16)


def full_build(spark, sf):
    """Phases 1 to 3 through every sink: the published catalogue (MED4, SNK4, SNK7)."""
    return _lists_as_text(_published(spark, sf).table("catalogue"))


def full_build_provenance(spark, sf):
    """The published provenance: spine, offers and images (OFR5, MED5, SNK5)."""
    return _published(spark, sf).table("provenance")


def full_build_review(spark, sf):
    """The review queue read back from its file (SNK3)."""
    return published.review_of(_published(spark, sf))


def full_build_gates(spark, sf):
    """GAT1 and GAT3 over the published tables, with the look-up and provenance counters."""
    given = build_inputs(spark, sf, OCCURRENCE_LIMIT)
    out = published.build(spark, work_dir(spark), given, PARTS_PROFILE, buckets=16)
    records = S.pivot_records(P.read_current(spark, out.base, "eav"), PARTS_PROFILE.labels)
    names = records.select(F.col("name_lat").alias("input_name"), F.lit("lat").alias("input_lang"))
    res = RS.resolve_records(records, given.match, "name_lat", "lat", PARTS_PROFILE)
    one = G.phase1_gate(records, res.where(F.col("status") == "resolved"), out.table("spine"), published.review_of(out),
                        out.table("provenance_spine"), RS.asked_keys(names, PARTS_PROFILE),
                        RS.unseen_keys(names, given.match, PARTS_PROFILE))
    matched = out.table("matched")
    three = G.phase3_gate(matched, out.table("spine"), out.table("catalogue"), out.table("offers"),
                          offer_provenance(matched, given.seller))
    counts = []
    for gate, df in (("GAT1", one), ("GAT3", three)):
        cols = [c for c, t in df.dtypes if t == "bigint"]
        counts.append(df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).alias("value"))
                                                    for c in cols])).alias("x")).select(F.lit(gate).alias("gate"), "x.*"))
    return counts[0].unionByName(counts[1])


def lookup_entity(spark, sf):
    """QRY16 over the published spine: one entity by its key, one bucket read."""
    spine = _published(spark, sf).table("spine")
    return _lists_as_text(lookup(spine, spine.agg(F.max(P.KEY)).first()[0]))


def lookup_provenance(spark, sf):
    """QRY17 over the published provenance: all rows of one key."""
    out = _published(spark, sf)
    return provenance_of(out.table("provenance"), out.table("spine").agg(F.max(P.KEY)).first()[0])


def snapshots_staged(spark, sf):
    """SNK8 -> SRC1 -> STG1 -> SNK1/STG4: records as dated JSON files, read back, staged, and
    staged again by a second run, whose version replaces the first."""
    records = part_records(doc_parts(table(spark, sf, "documents")))
    dated = records.withColumn("scraped_at", F.date_add(F.lit("2026-06-01").cast("date"), (F.col("source_id").cast("long") % 3).cast("int")))
    base = work_dir(spark)
    path = P.write_json(dated.withColumn("day", F.col("scraped_at")), base, "raw", partition_by=["day"])
    read = SN.read_records(spark, f"{path}/day=*/*.json", lines=True)
    P.write_eav(S.eav_from_records(read.where("source_id < '5'")), base)
    P.write_eav(S.eav_from_records(read), base)
    eav = P.read_current(spark, base, "eav")
    return eav.select("source_id", "raw_name_he", "raw_name_lat", "attribute", "value", F.col("scraped_at").cast("string").alias("scraped_at"))


def compacted_eav(spark, sf):
    """SNK1 after compaction: staged in many small files, rewritten in few, read back."""
    base = work_dir(spark)
    eav = eav_of(doc_parts(table(spark, sf, "documents"))).withColumn("scraped_at", F.lit("2026-06-01").cast("date"))
    P.write_eav(eav.repartition(40), base)
    compact(spark, base, "eav", ["source", "scraped_at"])
    return P.read_current(spark, base, "eav").select("source_id", "raw_name_he", "raw_name_lat", "attribute", "value")


def seller_snapshots(spark, sf):
    """SNK8 -> SRC2: a seller's records as JSON files, read back."""
    shop = offers(table(spark, sf, "lineitem"), table(spark, sf, "part"))
    given = shop.select(F.lit(SELLER).alias("source"), "source_id", "url", "category", "name_he", "price", "pot_sizes", "availability")
    path = P.write_json(given, work_dir(spark), "seller", partition_by=["category"])
    read = SN.read_seller_records(spark, f"{path}/*/*.json", lines=True)
    return read.select("source", "source_id", "url", "name_he", "price", F.array_join("pot_sizes", "|").alias("pot_sizes"), "availability")


def listed_names(spark, sf):
    """SRC3 -> RES9: a list file's names through the resolver: keys, and names left for review."""
    parts = _parts(spark, sf)
    lines = parts.select(F.concat(F.lit(" "), F.col("p_name"), F.lit(" ,"), F.col("p_type")).alias("name_lat"))
    path = f"{work_dir(spark)}/list"
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(path)
    names = ST.curated_names(SN.read_list_lines(spark, path))
    listed, unresolved = ST.listed_keys(names, match_table(parts), PARTS_PROFILE)
    none = F.lit(None)
    return listed.select(P.KEY, "name", none.cast("string").alias("reason")).unionByName(
        unresolved.select(none.cast("bigint").alias(P.KEY), "name", "reason"))


def labelled_gate(spark, sf):
    """SRC11 -> GAT4: labels from a file of their own, not made from the match table: the
    names of a document's label rows are expected to resolve, misspelt ones to go to review."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    parts = doc_parts(docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi"))
    good = parts.select(F.col("p_name").alias("input_name"), F.lit("resolve").alias("expected_bucket"))
    bad = parts.select(typo(F.col("p_name")).alias("input_name"), F.lit("review").alias("expected_bucket"))
    rows = good.unionByName(bad).distinct().select(
        F.lit(None).cast("int").alias("id"), "input_name", F.lit("lat").alias("input_lang"), F.lit("").alias("category"),
        "expected_bucket", F.lit("").alias("note"))
    path = f"{work_dir(spark)}/labelled"
    rows.write.option("header", True).csv(path)
    lab = SN.read_labelled(spark, path)
    res = RS.resolve_names(lab.select("input_name", "input_lang"), match_table(doc_parts(docs)), PARTS_PROFILE)
    return G.resolver_gate(lab, res)


def resolve_swapped(spark, sf):
    """RES8 with swapped letters: names whose second and third letters changed places."""
    parts = _parts(spark, sf)
    n = F.col("p_name")
    swapped = F.concat(F.substring(n, 1, 1), F.substring(n, 3, 1), F.substring(n, 2, 1), F.substring(n, 4, 1000))
    return match_near(parts.select(swapped.alias("input_name")), parts.select(n.alias("name")), 1, written)


def resolve_homonyms(spark, sf):
    """RES4 among several rows of a name: a name's brands are its families."""
    parts = doc_parts(table(spark, sf, "documents"))
    rows = parts.groupBy(F.col("p_name").alias("name"), F.col("p_brand").alias("family"), F.col("p_type").alias("kingdom")).agg(
        F.min("p_partkey").alias("key")).withColumn("status", F.when(F.col("key") % 2 == 0, "ACCEPTED").otherwise("SYNONYM"))
    asked = parts.select(F.col("p_name").alias("input_name"), F.col("p_name").alias("name"),
                         F.when(F.col("p_size") < 40, F.col("p_type")).alias("kingdom"),
                         F.when(F.col("p_size") > 10, F.col("p_brand")).alias("family"))
    return choose(asked, rows)


QUERIES = {
    "kept_answers": kept_answers,
    "second_run": second_run,
    "incremental_rebuild": incremental_rebuild,
    "incremental_review": incremental_review,
    "full_build": full_build,
    "full_build_provenance": full_build_provenance,
    "full_build_review": full_build_review,
    "full_build_gates": full_build_gates,
    "lookup_entity": lookup_entity,
    "lookup_provenance": lookup_provenance,
    "snapshots_staged": snapshots_staged,
    "compacted_eav": compacted_eav,
    "seller_snapshots": seller_snapshots,
    "listed_names": listed_names,
    "labelled_gate": labelled_gate,
    "resolve_swapped": resolve_swapped,
    "resolve_homonyms": resolve_homonyms,
}
