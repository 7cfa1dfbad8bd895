"""Incremental catalogue rebuild (STG1 -> STG3 -> RES -> REC1) by change propagation.

A batch brings new EAV rows and, for records that were deleted or scraped anew,
their ids (``gone``: all rows of earlier batches stop counting).  The change is
followed through the stages:

1. changed records: the ids in the new rows and in ``gone``;
2. only their live EAV rows are pivoted and resolved;
3. touched keys: the keys the changed records had *and* those they have now;
4. only the records of touched keys are reconciled, and only the slots that
   hold touched keys are rewritten (:mod:`verdant.plans.slot_table`).

State.  ``eav`` and ``gone`` are append-only, by batch id.  ``owners`` maps a
record to its key, dealt by record id.  ``records`` (resolved records and the
review queue) and ``spine`` are dealt by key, so that the records of a touched
key lie in the slots that are rewritten anyway.  One line a batch names the
manifests of all three; it is written last, so readers see a batch whole or not
at all, and a batch that is there already is not applied twice.  Batches are
applied one after the other.

The result equals a rebuild of all live rows (:meth:`CatalogStore.rebuilt`).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from verdant import lookups as L
from verdant.operators.reconcile import canonical_table, provenance, reconcile
from verdant.operators.resolve import resolve_records
from verdant.operators.staging import EAV_COLUMNS, pivot_records
from verdant.plans.append_table import AppendTable, read_lines, write_line
from verdant.plans.slot_table import Manifest, SlotTable

KEY = "canonical_taxon_id"
RECORD = ["source", "source_id"]
EAV_SCHEMA = StructType([*[StructField(c, StringType()) for c in EAV_COLUMNS[:-1]],
                         StructField("scraped_at", StringType())])
_OWNER = StructType([StructField(c, StringType()) for c in (*RECORD, "owner")])


@dataclass
class State:
    """The manifests after a batch, and what that batch touched."""
    step: int = -1
    batch: str = ""
    owners: Manifest = field(default_factory=dict)
    records: Manifest = field(default_factory=dict)
    spine: Manifest = field(default_factory=dict)
    touched: list[int] = field(default_factory=list)

    def line(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def of(cls, line: str) -> State:
        s = cls(**json.loads(line))
        for name in ("owners", "records", "spine"):
            setattr(s, name, {int(k): v for k, v in getattr(s, name).items()})
        return s


class CatalogStore:
    """A catalogue kept under ``base`` and brought up to date batch by batch."""

    def __init__(self, spark: SparkSession, base: str, match: DataFrame,
                 profile: L.Profile = L.REFERENCE_PROFILE, slots: int = 64):
        self.spark, self.home, self.match, self.profile = spark, base.rstrip("/"), match, profile
        self.eav = AppendTable(spark, base, "eav", EAV_SCHEMA)
        self.gone = AppendTable(spark, base, "gone", StructType(EAV_SCHEMA.fields[:2]))
        self.owners, self.records, self.spine = (SlotTable(spark, base, n, slots) for n in ("owners", "records", "spine"))
        # the schemas of the kept tables are those of the plans that fill them
        none = self._resolved(spark.createDataFrame([], EAV_SCHEMA))
        self.record_schema = none.schema
        self.spine_schema = reconcile(none, None, profile).schema

    # ------------------------------------------------------------ state

    def states(self) -> list[State]:
        first: dict[str, State] = {}
        for line in read_lines(self.spark, f"{self.home}/states"):
            s = State.of(line)
            first.setdefault(s.batch, s)
        return sorted(first.values(), key=lambda s: s.step)

    def state(self) -> State:
        return (self.states() or [State()])[-1]

    # ------------------------------------------------------------ plans

    def _resolved(self, eav: DataFrame) -> DataFrame:
        """Pivoted and resolved records, with ``owner``: the key, or the record itself."""
        dated = eav.withColumn("scraped_at", F.col("scraped_at").cast("date"))
        res = resolve_records(pivot_records(dated, self.profile.labels), self.match, "name_lat", "lat", self.profile)
        return res.withColumn("owner", F.coalesce(F.col(KEY).cast("string"), F.concat_ws("\u0001", F.lit("?"), *RECORD)))

    def live(self, batches: set[str], only: DataFrame | None = None) -> DataFrame:
        """The EAV rows of ``batches`` that no later one of them withdrew (of the
        records ``only``, or of all)."""
        eav, gone = self.eav.read(batches), self.gone.read(batches)
        if only is not None:
            eav = eav.join(only, RECORD, "left_semi")
        last = gone.groupBy(*RECORD).agg(F.max("order").alias("_gone"))
        return (eav.join(last, RECORD, "left").where(F.col("_gone").isNull() | (F.col("order") >= F.col("_gone")))
                .select(*EAV_COLUMNS))

    def _order(self, batch: str) -> int:
        """The batch's place: that of its rows, if a failed attempt left them, else the next."""
        seen = {c.batch: c.order for c in (*self.eav.commits(), *self.gone.commits())}
        return seen.get(batch, 1 + max(seen.values(), default=-1))

    # ------------------------------------------------------------ the job

    def apply(self, batch: str, eav: DataFrame, gone: DataFrame | None = None) -> bool:
        """Bring the catalogue up to date with one batch; False if it was applied before."""
        states = self.states()
        if any(s.batch == batch for s in states):
            return False
        old = states[-1] if states else State()
        order, version = self._order(batch), f"{batch}-{uuid.uuid4().hex[:8]}"
        applied = {s.batch for s in states} | {batch}
        self.eav.commit(eav.withColumn("scraped_at", F.col("scraped_at").cast("string")), batch, order)
        if gone is not None:
            self.gone.commit(gone.select(*RECORD), batch, order)
        changed = (self.eav.read({batch}).select(*RECORD).union(self.gone.read({batch}).select(*RECORD)).distinct())

        # the changed records: as they were (owner), and as they are
        ids = self.owners.touched(changed, *RECORD)
        was = self.owners.read(old.owners, _OWNER, ids)
        fresh = self._staged(self._resolved(self.live(applied, changed)), f"fresh-{version}")
        owners = was.join(changed, RECORD, "left_anti").unionByName(fresh.select(*RECORD, "owner"))

        touched_owners = self._staged(was.join(changed, RECORD, "left_semi").select("owner")
                                      .union(fresh.select("owner")).distinct(), f"touched-{version}")
        slots = self.records.touched(touched_owners, "owner")
        records = self._staged(self.records.read(old.records, self.record_schema, slots)
                               .join(changed, RECORD, "left_anti").unionByName(fresh), f"records-{version}")
        again = records.where(F.col("status") == "resolved").join(touched_owners, "owner", "left_semi")
        spine = (self.spine.read(old.spine, self.spine_schema, slots)
                 .join(touched_owners, F.col(KEY).cast("string") == F.col("owner"), "left_anti")
                 .unionByName(reconcile(again, None, self.profile)))
        new = State(old.step + 1, batch,
                    self.owners.rewrite(old.owners, owners, self.owners.slot(*RECORD), ids, version),
                    self.records.rewrite(old.records, records, self.records.slot("owner"), slots, version),
                    self.spine.rewrite(old.spine, spine, self.spine.slot(F.col(KEY).cast("string")), slots, version),
                    slots)
        write_line(self.spark, f"{self.home}/states/{version}", new.line())
        return True

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.home}/work/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ------------------------------------------------------------ results

    def reconciled(self, state: State | None = None) -> DataFrame:
        return self.spine.read((state or self.state()).spine, self.spine_schema)

    def canonical(self, state: State | None = None) -> DataFrame:
        return canonical_table(self.reconciled(state))

    def provenance(self, state: State | None = None) -> DataFrame:
        return provenance(self.reconciled(state), self.profile)

    def review(self, state: State | None = None) -> DataFrame:
        rows = self.records.read((state or self.state()).records, self.record_schema)
        return rows.where(F.col("status") != "resolved").select(
            "source_id", "name_he", "name_lat", "reason", "confidence", "matchType")

    def rebuilt(self) -> DataFrame:
        """The spine from scratch: all live rows of all batches."""
        res = self._resolved(self.live({s.batch for s in self.states()}))
        return reconcile(res.where(F.col("status") == "resolved"), None, self.profile)
