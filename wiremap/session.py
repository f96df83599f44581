"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS, S3, ABFS, ...).  We only set our own folder when the setting is
missing, which is the case in unit tests on a laptop.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from wiremap import fs

# Settings every wiremap job expects; they are Spark's own knobs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # remove checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "wiremap",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written snapshots."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if re.match(r"local(\[|$)", spark.sparkContext.master) is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # One process (tests): any folder is shared.
        d = tempfile.mkdtemp(prefix="wiremap-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder."""
    return f"{shared_dir(spark)}/wiremap/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files of a query go when it ends; otherwise they stay until the driver collects its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the writes of a block; the old ones come back after it."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def materialize(df, name: str = "materialized"):
    """Cut the lineage: write ``df`` as parquet under the shared folder, read it back.

    Used where one result feeds several branches of a plan (the packet map
    on both sides of the connection self-join), so it is computed once.  A
    written table survives executor loss (unlike a local checkpoint), is
    columnar, so each branch reads only its columns, and gives the planner
    real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with settings(spark, FREE_SHUFFLES):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_LISTING = "spark.sql.sources.parallelPartitionDiscovery."
#: File systems that answer so quickly that the driver lists a batch's files faster than a job does.
_NEAR = ("file:", "hdfs:", "viewfs:")


def list_cheaply(spark: SparkSession, path: str) -> None:
    """List many files in as many tasks as there are cores, and a batch of near ones without a job.

    Spark's defaults start a task for each path, also for the few files of each
    micro-batch, and a file stream writes the names of all files it has seen anew
    every ten batches.  Settings that differ from these defaults are left alone.
    """
    for name, default, value in ((_LISTING + "parallelism", "10000", 2 * spark.sparkContext.defaultParallelism),
                                 (_LISTING + "threshold", "32", 256 if fs.uri(spark, path).startswith(_NEAR) else 32),
                                 ("spark.sql.streaming.fileSource.log.compactInterval", "10", 100)):
        if spark.conf.get(name) == default:
            spark.conf.set(name, str(value))


def sizing_conf(input_bytes: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for an input of ``input_bytes`` (compressed parquet).

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input so no task has to spill much; AQE then merges small ones to the
    advisory size and splits skewed ones.  Apply with ``spark.conf.set`` before
    the job (these are runtime SQL settings).
    """
    parts = max(8, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
