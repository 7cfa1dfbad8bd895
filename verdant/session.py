"""Session helpers: a tuned builder for local runs and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes
# (so a small side is broadcast only after its real size is known), splits
# skewed shuffle partitions and coalesces tiny ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "verdant", checkpoint: str | None = None) -> SparkSession:
    """Session for tests and benchmarks on one machine (UI off)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         # the plans are built from many small Column expressions; capturing a
         # Python call site for each one costs a JVM round trip per function
         # (it only enriches error messages)
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    if checkpoint:
        b = b.config("spark.checkpoint.dir", checkpoint)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, or the folder
    set on the context.  Without either this raises: a machine-local folder
    would be read back incompletely on a cluster, and a stream would lose its state."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a cached frame."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 ** 2,
                 shuffled_share: float = 0.1) -> dict[str, str]:
    """Settings that size scan splits and shuffle partitions for a given input.

    * scan splits of ``target_partition_bytes`` (row groups permitting);
    * a shuffle width from the bytes expected in a shuffle, ``shuffled_share``
      of the input after pruning and map-side aggregation (extraction is
      map-only, names are reduced to distinct ones).  It lies between two and
      eight waves of the cluster's cores: map tasks times reduce tasks is what
      the driver must track, and AQE only coalesces;
    * skew handling for partitions five times the median and above twice
      the target, split by AQE instead of spilling one task;
    * broadcasts only for build sides AQE has measured below 64 MB.

    For 100 TB on 8000 cores: 256 MB splits, about 40k shuffle partitions.
    """
    wanted = -(-int(input_bytes * shuffled_share) // target_partition_bytes)
    width = min(max(2 * total_cores, wanted), 8 * total_cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        **SCALE_CONF,
    }


_OWN_DIRS: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """A new folder for tables that a query keeps between its runs: under
    ``spark.checkpoint.dir``; on a ``local`` master without that setting (tests)
    under a private folder of the application; on a cluster without it, an error."""
    master = spark.sparkContext.master
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or not (
            master == "local" or master.startswith("local[")):
        base = checkpoint_dir(spark)
    else:
        app = spark.sparkContext.applicationId
        if app not in _OWN_DIRS:
            _OWN_DIRS[app] = tempfile.mkdtemp(prefix="verdant-")
        base = _OWN_DIRS[app]
    return f"{base.rstrip('/')}/verdant-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str = "kept") -> DataFrame:
    """A written table in place of a plan that several branches read: made once, and
    read back after the loss of an executor."""
    path = f"{work_dir(df.sparkSession)}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
