"""Session construction and the shared output folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates and ANSI casts, so a
# strict CAST that overflows raises instead of silently returning NULL.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tallyhouse", driver_memory: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs assume.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to roughly input bytes / 128 MB (AQE coalesces
    the small ones at runtime).
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if driver_memory:  # local mode: the executors live in the driver JVM
        builder = builder.config("spark.driver.memory", driver_memory)
    # static: the whole refresh compiles a few hundred distinct stage classes;
    # the default cache of 100 would evict and recompile them on every run
    builder = builder.config("spark.sql.codegen.cache.maxEntries", "1000")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    Reads ``spark.checkpoint.dir`` from the session. Only in local mode
    (tests, the bench) and only when it is unset, a private folder is created
    and registered as the checkpoint dir; on a cluster an unset value is an
    error rather than a silent fallback to machine-local disk.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this job")
        root = tempfile.mkdtemp(prefix="tallyhouse-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    sub = name or f"run-{uuid.uuid4().hex[:12]}"
    return os.path.join(root.rstrip("/"), sub) if "://" not in root else f"{root.rstrip('/')}/{sub}"


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        fs = hpath.getFileSystem(conf)
        if fs.exists(hpath):
            total += fs.getContentSummary(hpath).getLength()
    return int(total)


def partition_bytes(total: int, least: int = 128 * 1024 * 1024, most: int = 1024 * 1024 * 1024) -> int:
    """Bytes per map and per reduce task for ``total`` bytes of input: 128 MB up to
    1 TB, then growing with the square root (maps x reducers grows in proportion
    to the input, not to its square), 1 GB at most."""
    return int(min(most, max(least, least * (total / (1 << 40)) ** 0.5)))


def size_shuffle_partitions(spark: SparkSession, paths: list[str],
                            target_bytes: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` to about input bytes over
    :func:`partition_bytes` (never below the default parallelism), scan splits
    to the same size, and return it.

    This is the starting point for the widest shuffles (the dedup and the
    per-key pre-aggregations read roughly the whole input); AQE then coalesces
    the smaller shuffles toward ``advisoryPartitionSizeInBytes``.
    """
    total = input_bytes(spark, paths)
    target_bytes = target_bytes or partition_bytes(total)
    wanted = -(-total // target_bytes)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    n = max(int(wanted), spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return n
