"""Session construction and the shared scratch / checkpoint folder.

All lineage cuts (``DataFrame.checkpoint``), streaming checkpoints and intermediate tables go
under the folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is absent
*and* Spark runs in local mode (tests, benchmarks) do we create a private folder under the
system temp directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (broadcast only when the
# measured side is below the threshold), coalesces small shuffle partitions and splits skewed
# join partitions; the RocksDB provider keeps streaming state off the JVM heap.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "stationdw",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only in local mode when none is given."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stationdw-ckpt-"))
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the checkpoint root for intermediate tables and stream state."""
    root = checkpoint_root(spark)
    leaf = f"{name or 'tmp'}-{uuid.uuid4().hex[:12]}"
    return root.rstrip("/") + "/" + leaf


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder the library wrote itself, if it is there, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20
               ) -> dict[str, str]:
    """Shuffle and scan settings for a given input size and cluster (spill-aware sizing).

    * scans split files into ~256 MB partitions, so a task holds at most one such split;
    * shuffles move pruned, partially aggregated rows, typically a tenth of the scanned bytes
      or less, so a job starts with one shuffle partition per ~1 GiB of input (at least three
      waves of tasks) and AQE
      coalesces them to ~128 MB each once sizes are measured;
    * a shuffle partition 4x the median and over 512 MB counts as skewed and is split.

    Example: 100 TiB on 1,000 executors x 8 cores -> 102,400 initial shuffle partitions,
    coalesced at runtime. Pass the result as ``build_session(conf=scale_conf(...))``.
    """
    initial = max(3 * total_cores, -(-input_bytes // (1 << 30)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file through Spark's file systems (no Spark job); replaces one that is there."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
