"""Value history (SRC1/STG1 over all dates, QRY17 as of a day).

The staging table keeps every snapshot of a record.  :func:`intervals` turns the
values of each (record, attribute) into validity intervals: a run of equal
values on consecutive snapshot dates is one interval, which ends where the next
one begins.  :func:`as_of` answers what was valid on a day.

Rows are first reduced to one value a date (the least, as the pivot's ties), by
an aggregate that combines map-side; the list that is then put in order holds
one entry a snapshot date, however many rows a record has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORD = ["source", "source_id", "attribute"]


def intervals(eav: DataFrame) -> DataFrame:
    """``(source, source_id, attribute, value, valid_from, valid_to, snapshots)``; the last
    interval has no end.  Rows without a date come before all dates."""
    day = F.coalesce(F.col("scraped_at").cast("date"), F.lit("0001-01-01").cast("date"))
    daily = eav.groupBy(*RECORD, day.alias("day")).agg(F.min("value").alias("value"))
    runs = daily.groupBy(*RECORD).agg(F.array_sort(F.collect_list(F.struct("day", "value"))).alias("s"))
    starts = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda i: (i == 0) | ~F.get(F.col("s"), i)["value"].eqNullSafe(
        F.get(F.col("s"), i - 1)["value"]))
    runs = runs.select(*RECORD, "s", starts.alias("at"))
    # an interval: the entries from one start to the next
    cut = F.transform(F.sequence(F.lit(0), F.size("at") - 1), lambda k: F.struct(
        F.get(F.col("s"), F.get(F.col("at"), k))["value"].alias("value"),
        F.get(F.col("s"), F.get(F.col("at"), k))["day"].alias("valid_from"),
        F.get(F.col("s"), F.get(F.col("at"), k + 1))["day"].alias("valid_to"),
        (F.coalesce(F.get(F.col("at"), k + 1), F.size("s")) - F.get(F.col("at"), k)).alias("snapshots")))
    return runs.select(*RECORD, F.explode(cut).alias("i")).select(*RECORD, "i.*")


def as_of(history: DataFrame, day) -> DataFrame:
    """The value of every (record, attribute) on ``day``: one filter, no join."""
    d = F.lit(day).cast("date")
    return (history.where((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") > d)))
            .select(*RECORD, "value", F.col("valid_from").alias("since")))


def as_of_each(asked: DataFrame, history: DataFrame) -> DataFrame:
    """As-of join: ``asked`` (source, source_id, attribute, day, ...) with the value valid
    on each row's own day; null where there was none."""
    h = history.select(*[F.col(c).alias(f"_{c}") for c in RECORD], "value", "valid_from", "valid_to")
    on = [F.col(c) == F.col(f"_{c}") for c in RECORD]
    inside = (F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("day")))
    return asked.join(h, [*on, inside], "left").drop(*[f"_{c}" for c in RECORD], "valid_from", "valid_to")


def latest(eav: DataFrame, day=None) -> DataFrame:
    """What staging only the snapshots up to ``day`` shows as current: the last date's value."""
    rows = eav if day is None else eav.where(F.col("scraped_at").isNull() | (F.col("scraped_at").cast("date") <= F.lit(day).cast("date")))
    last = F.coalesce(F.col("scraped_at").cast("date"), F.lit("0001-01-01").cast("date"))
    # the latest date first, its least value (a null last) second
    return (rows.groupBy(*RECORD).agg(F.min_by("value", F.struct((-F.unix_date(last)).alias("d"), F.col("value").isNull(),
                                                                 F.col("value"))).alias("value")))
