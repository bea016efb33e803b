"""Session construction and shared-storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every keelson job relies on: adaptive execution for runtime
# re-planning (partition coalescing, skew-join splitting), UTC so that day
# boundaries and epoch seconds match across engines, no UI server.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "keelson", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with keelson's base settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that may change at runtime and make sure a
    checkpoint folder is known (GBT fitting and lineage cuts need it)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        spark.sparkContext  # classic session
    except Exception:  # a remote (Connect) session: the server owns the checkpoint folder
        return spark
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Read from ``spark.checkpoint.dir`` (the cluster's shared folder). Only a
    local-mode session without that setting (tests) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif _is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="keelson-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder on shared storage for tables and files a job writes.

    ``keelson.work.dir`` wins; otherwise a sub-folder of the checkpoint
    folder. Each call returns a new, unique path; Spark's writers make it.
    """
    root = spark.conf.get("keelson.work.dir", None)
    if not root:
        root = checkpoint_dir(spark).rstrip("/") + "/keelson"
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (Hadoop FileSystem, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return int(total)


def size_partitions(spark: SparkSession, total_input_bytes: int, target_bytes: int = 128 << 20,
                    max_split_bytes: int = 256 << 20) -> int:
    """Size shuffles and scans for the data at hand.

    Shuffle partitions ≈ input / 128 MiB (at least 2 × cores), so each reduce
    task's share fits executor memory and spills rarely; AQE then coalesces
    small ones to the same advisory size and splits skewed ones. Scan splits
    are capped at 256 MiB. At 100 TB this gives ~800k initial shuffle
    partitions before coalescing; at sf0.1 it gives 2 × cores."""
    cores = spark.sparkContext.defaultParallelism
    n = max(2 * cores, -(-total_input_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(max_split_bytes, max(target_bytes, 1 << 20))))
    return n
