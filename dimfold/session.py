"""Spark session defaults and the shared checkpoint folder.

The library never creates a session behind the caller's back: operators take
DataFrames. These helpers are for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "dimfold") -> SparkSession:
    """A session tuned for the modelling jobs.

    AQE stays on: it coalesces the small shuffle partitions of the period
    tables, re-plans joins to broadcast only after it has measured the real
    size of a side, and splits skewed partitions of the sort-merge joins.
    """
    master = master or os.environ.get("DIMFOLD_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DIMFOLD_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if os.environ.get("DIMFOLD_WAREHOUSE"):
        builder = builder.config("spark.sql.warehouse.dir", os.environ["DIMFOLD_WAREHOUSE"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must name a shared folder (HDFS, object store);
    it is read from the session and used as is. Only a local-mode session
    without the setting (tests, the bench) gets a private folder under the
    system temp dir, because there every task runs on this machine.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running incremental folds")
    local_dir = tempfile.mkdtemp(prefix="dimfold-ckpt-")
    sc.setCheckpointDir(local_dir)
    try:
        spark.conf.set("spark.checkpoint.dir", local_dir)
    except Exception:  # noqa: BLE001 - a session may refuse to change a core setting; the context has it
        pass
    return local_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable, not local).

    Used by driver-side folds over periods, where the plan would otherwise grow
    by one join per period. A reliable checkpoint survives executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, executor_memory_gb: int = 16, executor_cores: int = 4) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of Parquet on a large cluster.

    Partitions are sized so a task's share of a shuffle (~256 MB) fits in an
    executor core's share of memory with room for sort buffers; AQE then
    coalesces small partitions and splits skewed ones at runtime. Broadcasts
    stay small and are decided from measured sizes; lost executors are
    tolerated by task retries and by migrating their shuffle blocks on
    decommission.
    """
    target = 256 * 1024 * 1024
    per_core = executor_memory_gb * 1024 ** 3 // max(executor_cores, 1)
    advisory = min(target, max(64 * 1024 ** 2, per_core // 8))
    partitions = max(200, int(input_bytes // advisory))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(advisory * 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 ** 2),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(advisory),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        "spark.task.maxFailures": "8",
        "spark.stage.maxConsecutiveAttempts": "8",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
