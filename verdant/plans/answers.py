"""Kept match answers (RES7, GAT5).

The original asks a remote service once a name and keeps each answer in a file
cache, also a negative one, so that a second run asks nothing.  Here the
answers to the misses of a run are committed to an append-only table under the
run's batch id (:class:`~verdant.plans.append_table.AppendTable`):

* a replayed run adds nothing;
* runs that overlap in time may answer the same name; the earliest commit wins,
  for every reader alike;
* rows of the given match table win over kept answers.

The misses are found by an anti-join on distinct look-up keys, so a run costs
one pass over its names and one over the keys of the kept answers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant import lookups as L
from verdant.operators.matcher import responses_for
from verdant.operators.resolve import MATCH_FIELDS, cache_stats, unseen_keys
from verdant.plans.append_table import AppendTable
from verdant.plans.gates import second_run_gate
from verdant.session import written
from verdant.sources.services import MATCH_SCHEMA


@dataclass
class Run:
    """``stats``: one row (keys, hits, misses) as the run found them; ``committed``:
    False for a replay."""
    stats: DataFrame
    committed: bool


class KeptAnswers:
    def __init__(self, spark: SparkSession, base: str, name: str = "match_answers"):
        self.table = AppendTable(spark, base, name, MATCH_SCHEMA)

    def known(self, match: DataFrame) -> DataFrame:
        """The match table with the kept answers of other names."""
        kept = self.table.first_wins("name_key").join(match.select("name_key"), "name_key", "left_anti")
        cols = ["name_key", *MATCH_FIELDS]
        return match.select(*cols).unionByName(kept.select(*cols))

    def run(self, names: DataFrame, match: DataFrame, backbone: DataFrame, batch: str,
            profile: L.Profile = L.REFERENCE_PROFILE, order: int | None = None) -> Run:
        """Answer and keep what ``names`` (input_name, input_lang) ask and nobody has answered."""
        known = self.known(match)
        stats = cache_stats(names, known, profile)
        if any(c.batch == batch for c in self.table.commits()):     # a replay: nothing is matched
            return Run(stats, False)
        answers = responses_for(unseen_keys(names, known, profile), backbone, written)
        cast = {f.name: f.dataType for f in MATCH_SCHEMA.fields}
        answers = answers.select(*[F.col(c).cast(t).alias(c) for c, t in cast.items()])
        return Run(stats, self.table.commit(answers, batch, order))

    def gate(self, names: DataFrame, match: DataFrame, profile: L.Profile = L.REFERENCE_PROFILE) -> DataFrame:
        """GAT5: what a further run over ``names`` would ask (must be nothing)."""
        return second_run_gate(cache_stats(names, self.known(match), profile))
