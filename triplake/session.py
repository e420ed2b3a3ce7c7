"""SparkSession construction and the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings that change results or robustness (not just speed).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # partition values are strings ('05'), never inferred ints
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # replace only the periods a write touches
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.mergeSchema": "false",
}
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizing for a large cluster reading the full history (opt-in: ``build_session(cluster=True)``).
# Splits of 256 MB keep a task's input and its shuffle output well inside executor memory; the
# shuffle starts wide and AQE coalesces it to ~256 MB partitions and splits skewed ones.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.enableVectorizedReader": "true",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}


def build_session(master: str | None = None, app: str = "triplake",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  cluster: bool = False) -> SparkSession:
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in {**TUNING_CONF, **(CLUSTER_CONF if cluster else {}), **REQUIRED_CONF}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant settings to an existing session (e.g. the driver's)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


FIRST_PARTITIONS = 200
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def bound_tasks(spark: SparkSession, on: bool = True) -> None:
    """Settings that keep a task of the trip queries from holding a fixed share of the input.

    Shuffles begin with many partitions, which AQE merges by their size, so what a task sorts or joins is bounded by the
    partition size it aims at. A task writes its first period as rows come; only rows of further periods are sorted
    before, so a month that holds most rows, and has one file, is never sorted for its writing.
    """
    if on:
        spark.conf.set(_FIRST, str(max(FIRST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
        spark.conf.set(_WRITERS, "2")
    else:
        spark.conf.unset(_FIRST)
        spark.conf.unset(_WRITERS)


def at_once(*jobs: Callable) -> list:
    """Run independent jobs at the same time; their results in order, or the first error."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(job)) for job in jobs]
        return [r.result() for r in running]


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared lineage-cut folder.

    Uses ``spark.checkpoint.dir`` from the session (the cluster names a shared folder there).
    Only a local-mode session without the setting gets a private folder, as in tests.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): the server names the folder
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return d
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="triplake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()
