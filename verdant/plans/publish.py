"""Sinks (SNK1-SNK9) with versioned directories.

A table is never overwritten in place (a job cannot overwrite the path it is
reading).  Each write goes to ``<base>/<name>/v=<version>``; then a one-line
pointer of its own, ``<base>/<name>/_pointers/v=<version>``, names it.  The live
version is the latest pointer.  Nothing is ever overwritten or deleted, so a
half-written version is never seen and a failed job, or a failed repoint,
leaves the previous version live.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEY = "canonical_taxon_id"
# quotes are doubled, blanks at the ends of a value are part of it, texts may hold line ends
CSV = dict(header=True, escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def new_version() -> str:
    return time.strftime("%Y%m%dT%H%M%S") + f"{int(time.time() * 1000) % 1000:03d}"


def _pointers(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}/_pointers"


def write_version(df: DataFrame, base: str, name: str, fmt: str = "parquet",
                  partition_by: list[str] | None = None, version: str | None = None,
                  repoint: bool = True, **options) -> str:
    """Write ``df`` as a new version and repoint; returns the version path.

    ``repoint=False`` writes the version only, for callers that keep the
    returned path themselves.
    """
    v = version or new_version()
    path = f"{base.rstrip('/')}/{name}/v={v}"
    w = df.write.mode("errorifexists").format(fmt)
    for k, val in options.items():
        w = w.option(k, val)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    if not repoint:
        return path
    point(df.sparkSession, base, name, path, v)
    return path


def point(spark: SparkSession, base: str, name: str, target: str, version: str | None = None) -> None:
    """Make ``target`` the live version of ``name``: one small pointer file of its own."""
    v = version or f"{new_version()}-{uuid.uuid4().hex[:6]}"
    spark.createDataFrame([(f"{time.time_ns():020d}\t{target}",)], "pointer string").coalesce(1) \
         .write.mode("errorifexists").text(f"{_pointers(base, name)}/v={v}")


def current_path(spark: SparkSession, base: str, name: str) -> str:
    """Path of the latest version whose pointer was written (one small file a version)."""
    latest = spark.read.text(f"{_pointers(base, name)}/*").agg(F.max("value")).first()[0]
    if latest is None:
        raise FileNotFoundError(f"no version of {name} under {base}")
    return latest.split("\t", 1)[1]


def read_current(spark: SparkSession, base: str, name: str, fmt: str = "parquet",
                 schema=None, **options) -> DataFrame:
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, val in options.items():
        r = r.option(k, val)
    return r.load(current_path(spark, base, name))


def write_bucketed(df: DataFrame, base: str, name: str, buckets: int, key: str = KEY,
                   repoint: bool = True) -> str:
    """SNK4/SNK7 co-partitioned: a new version bucketed and sorted by ``key``.

    Tables of one bucket count join on ``key`` without a shuffle, and a look-up of
    one key reads one bucket.  Rows are dealt before writing as the buckets are, so
    a bucket is one file; a table with hot keys (provenance) is written by
    :func:`write_bucketed_as_is`.
    """
    return _write_buckets(df.repartition(buckets, key), base, name, buckets, key, repoint)


def write_bucketed_as_is(df: DataFrame, base: str, name: str, buckets: int, key: str = KEY,
                         repoint: bool = True) -> str:
    """As :func:`write_bucketed`, but each task writes its own file of a bucket: no
    shuffle, and no task writes all rows of a hot key."""
    return _write_buckets(df, base, name, buckets, key, repoint)


def _write_buckets(df: DataFrame, base: str, name: str, buckets: int, key: str, repoint: bool) -> str:
    path = f"{base.rstrip('/')}/{name}/v={new_version()}-{uuid.uuid4().hex[:6]}"
    (df.write.mode("errorifexists").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
     .saveAsTable(_table_of(path)))
    if repoint:
        point(df.sparkSession, base, name, f"{path}\t{buckets}\t{key}\t{df.schema.json()}")
    return path


def _table_of(path: str) -> str:
    """The session catalogue's name of a bucketed version (a function of its path)."""
    return f"verdant_{hashlib.sha1(path.encode()).hexdigest()[:20]}"


def read_bucketed(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The live version with its buckets.  The session catalogue that Spark keeps bucket
    counts in may be new (another application): the version is registered again
    from its pointer."""
    path, buckets, key, schema = current_path(spark, base, name).split("\t")
    table = _table_of(path)
    if not spark.catalog.tableExists(table):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(schema)).fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def write_eav(eav: DataFrame, base: str) -> str:
    """SNK1: EAV partitioned by source and snapshot date."""
    return write_version(eav, base, "eav", partition_by=["source", "scraped_at"])


def write_csv(df: DataFrame, base: str, name: str, order_by: list[str] | None = None) -> str:
    """SNK2/SNK3/SNK6: CSV with header (optionally globally ordered)."""
    if order_by:
        df = df.orderBy(*order_by)
    return write_version(df, base, name, fmt="csv", **CSV)


def read_csv(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    """A CSV sink read back."""
    return read_current(spark, base, name, fmt="csv", schema=schema, **CSV)


def write_json(df: DataFrame, base: str, name: str, partition_by=None) -> str:
    """SNK8/SNK9: JSON lines."""
    return write_version(df, base, name, fmt="json", partition_by=partition_by)


def published_columns() -> list[str]:
    from verdant.operators.layers import MEDIA_COLUMNS, OFFER_COLUMNS
    from verdant.operators.reconcile import CANONICAL_COLUMNS
    return CANONICAL_COLUMNS + list(OFFER_COLUMNS) + list(MEDIA_COLUMNS)


def ensure_columns(df: DataFrame) -> DataFrame:
    """All 41 columns in published order; missing layer columns typed null."""
    from verdant.operators.layers import MEDIA_COLUMNS, OFFER_COLUMNS, with_layer_columns
    df = with_layer_columns(with_layer_columns(df, OFFER_COLUMNS), MEDIA_COLUMNS)
    return df.select(*[F.col(c) for c in published_columns()])
