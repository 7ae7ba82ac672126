"""Session helpers.

``get_session`` is for tests and the bench; on a cluster the caller brings
its own session.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session and only sets one when it is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "vigil", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("VIGIL_MASTER", "local[8]")
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local runs on small tables: let AQE keep enough partitions for the
        # CPU-bound window stages (the 1 MB default leaves 1-2 tasks busy)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VIGIL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(raw_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Suggested settings for a large run (a starting point, not a rule).

    Shuffle partitions sized so a partition of the raw readings' shuffle is
    about ``target_partition_bytes`` (AQE coalesces the later, smaller
    shuffles), at least 2-3 tasks per core; file splits of 256 MB; AQE with
    skew-join splitting on.  Broadcasts stay at Spark's measured-size
    threshold."""
    cores = executors * cores_per_executor
    parts = max(3 * cores, raw_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster.  If none is named, a
    local session gets a scratch folder; on a cluster that would put files on
    the executors' own disks, so it is an error there."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        path = tempfile.mkdtemp(prefix="vigil-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001  core confs may be read-only at runtime
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder: no call overwrites what an
    earlier, still lazy frame reads.  The folder is the cluster's scratch
    space; whoever owns it clears it after the job."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write ``df`` once as Parquet to the shared checkpoint folder and read it
    back: survives the loss of an executor, and what follows reads only the
    columns that it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
