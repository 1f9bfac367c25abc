"""Spark session settings used by the jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants.  ANSI mode stays on (the 4.x default); cleaning uses
# try_* functions where bad input must become NULL instead of failing.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what the planner / AQE measured to be below this size;
    # anything larger falls back to a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Partition values such as state codes stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "rosterline",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only when neither the setting nor the context's checkpoint folder
    exists and the master is local (tests) is a scratch folder chosen; a cluster
    without the setting is an error.  The folder is registered
    through ``setCheckpointDir`` because the setting itself cannot change once
    the context is running.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share; "
                "a machine-local folder would lose intermediate tables"
            )
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rosterline-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def written_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again, with its size known to the planner."""
    spark = df.sparkSession
    path = scratch_path(spark, os.path.join("tables", f"{label}-{uuid.uuid4().hex}"))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Shuffle partitions at most: map tasks x partitions is the number of blocks the
# driver tracks, and a partition that turns out too large is split by AQE.
MAX_SHUFFLE_PARTITIONS = 20_000


def scale_conf(
    input_bytes: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
    shuffled_share: float = 0.1,
    cores: int = 0,
) -> dict[str, str]:
    """Settings for a job that reads ``input_bytes`` on a large cluster.

    Scan splits hold about ``target_partition_bytes``.  What crosses a shuffle are
    pruned columns and partial aggregates, ``shuffled_share`` of the input, so the
    shuffle partitions follow that size and the number of ``cores`` (three tasks
    a core at least), between a few hundred and MAX_SHUFFLE_PARTITIONS; AQE then
    coalesces small partitions and splits skewed ones.
    """
    by_size = -(-int(input_bytes * shuffled_share) // target_partition_bytes)
    shuffle_partitions = min(MAX_SHUFFLE_PARTITIONS, max(200, by_size, 3 * cores))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Size this session's scans and shuffles for ``input_bytes`` of input."""
    conf = scale_conf(input_bytes, cores=spark.sparkContext.defaultParallelism)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
