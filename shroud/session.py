"""Session helpers: one place for the configuration every job here assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness or for the plans this library relies on.
#  - ANSI mode: a masked constant that cannot be cast must raise, not turn into NULL.
#  - AQE with skew-join splitting: grant, tag and membership relations have hot keys
#    (the everyone-group, one popular tag); AQE splits such partitions at run time.
#  - UTC session zone: timestamps compare equal with the DuckDB oracle.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "shroud", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


MB = 1 << 20


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Partition sizing for a cluster run, so that every task's share fits in executor
    memory and spills rarely.

    Scans split files into ``target_partition_mb`` pieces; the initial shuffle partition
    count covers the input at that size (never fewer than two waves of the cores), and AQE
    coalesces small partitions to the same advisory size at run time. A partition five times
    the median and above twice the target is treated as skewed and split. The broadcast bound
    is explicit: sides under 64 MB are broadcast, larger ones stay shuffle joins.
    """
    target = target_partition_mb * MB
    parts = max(2 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
    }


def apply_cluster_conf(spark: SparkSession, input_bytes: int, total_cores: int) -> None:
    """Set the sizing above on a running session (runtime SQL settings only), keeping any
    value the cluster set at submit time."""
    submitted = spark.sparkContext.getConf()
    for k, v in cluster_conf(input_bytes, total_cores).items():
        if not submitted.contains(k):
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in spark.checkpoint.dir.

    A cluster sets it to a shared file system, and it is an error if it does not. Only in
    local mode (tests) do we pick a scratch folder of our own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="shroud-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder, for tables written to cut lineage."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return f"{base}/{name}"
