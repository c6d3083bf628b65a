"""Session settings shared by tests, the benchmark and the driver entry.

The settings only matter when this package creates the session (local runs and
tests); on a cluster the operator code reads whatever the session already has.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions, and turn a sort-merge join into a broadcast join when the
# measured (not estimated) size of a side is under the threshold.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "planpulse") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in ADAPTIVE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is left
    alone; the local fallback exists for tests and the benchmark and is only
    used with a ``local[...]`` master -- a machine-local folder would not
    survive the loss of an executor.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                           "distributed file system) before running reports")
    local = tempfile.mkdtemp(prefix="planpulse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's checkpoint folder.

    Used where one derived frame feeds several reports; a lost executor then
    re-reads the checkpoint instead of recomputing the whole upstream plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
