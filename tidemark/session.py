"""SparkSession construction and the shared staging folder.

Scale notes
-----------
* Timestamps are parsed and rendered in UTC (``spark.sql.session.timeZone``),
  so results never depend on where the driver runs.
* AQE is on: it coalesces the small shuffle partitions a narrow market batch
  produces, and splits skewed join partitions at 100 TB.
* Anything the jobs materialise between actions (round-trip files, stream
  checkpoints, lineage cuts) goes under ``spark.checkpoint.dir``, which on a
  cluster names a shared folder.  We only invent one when it is unset *and*
  the master is local (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # streaming state (dedup keys inside the watermark, open candle windows) off the JVM heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session configured for the pipeline (UTC, AQE, no UI)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Shuffle sizing for a cluster run over ``input_bytes`` of input with ``cores`` task slots.

    Start with enough shuffle partitions that each holds about
    ``partition_bytes`` of the input (never fewer than 2 waves of tasks), and
    let AQE coalesce them toward the same advisory size once real sizes are
    known.  Scan splits stay at 128 MB, so a scan task's rows fit in
    memory.  At 100 TB and 256 MB per partition this starts at ~400k
    partitions; AQE then merges the small ones.
    """
    initial = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024**2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def apply_runtime_conf(spark: SparkSession) -> None:
    """Session settings every query relies on (safe to call repeatedly)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    store = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(store, DEFAULT_CONF[store])


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Local sessions without one get a private temporary folder; a cluster
    session without one is a configuration error, since executor-local paths
    would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder (HDFS/S3/ABFS) on a cluster"
            )
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one materialisation."""
    return f"{shared_root(spark)}/tidemark-staging/{name}-{uuid.uuid4().hex}"
