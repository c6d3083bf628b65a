"""Report sinks (S7): full replace of a named output, with its row count."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: Sequence[str] = (), order_by: Sequence = ()) -> int:
    """Drop and rewrite ``path`` with ``df`` (the original replaced the whole tab).

    A lost executor's task is simply re-run, and only committed files count.
    Overwriting deletes the old output first: a reader must not read ``path``
    meanwhile; ``publish_report`` keeps the old one until the new one is whole.
    ``order_by`` sorts within the write (report order, O1-O3); CSV gets a
    header.  Returns the number of rows written, counted by an
    ``Observation`` during the same pass (no second job).
    """
    obs = Observation("rows_written")
    # Counted above the sort: what lies below it also runs for the sampling of its ranges.
    out = (df.orderBy(*order_by) if order_by else df).observe(obs, F.count(F.lit(1)).alias("rows"))
    w = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"])


COMMITS = "version string, rows bigint, format string"


def publish_report(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                   order_by: Sequence = ()) -> int:
    """Replace the report under ``path`` at once: readers see the old or the new one, never a part.

    The rows go to a fresh folder ``path/versions/<version>``; only when it is whole, one
    row in ``path/commits`` names it (a single file, which appears when its job commits).
    A write that dies before leaves the old report current, and its folder unused.  Old
    versions stay readable until ``expire_versions``.  Returns the number of rows.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows = write_report(df, f"{path.rstrip('/')}/versions/{version}", fmt, partition_by, order_by)
    commit = df.sparkSession.createDataFrame([(version, rows, fmt)], COMMITS)
    commit.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/commits")
    return rows


def report_versions(spark: SparkSession, path: str) -> DataFrame:
    """``version, rows, format`` of the committed versions of a report; the greatest is the current one."""
    return spark.read.schema(COMMITS).json(f"{path.rstrip('/')}/commits")


def read_report(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The current (or the named) version of a published report."""
    known = report_versions(spark, path)
    known = known.filter(F.col("version") == version) if version else known.orderBy(F.desc("version"))
    found = known.take(1)
    if not found:
        raise ValueError(f"no committed version {version or ''} under {path}")
    reader = spark.read.option("header", True) if found[0].format == "csv" else spark.read
    return reader.format(found[0].format).load(f"{path.rstrip('/')}/versions/{found[0].version}")


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the folders of all versions older than the ``keep`` newest committed ones.

    Folders of writes that died are older than a later commit and go too; a folder newer
    than the current version may be a write in progress and stays.
    """
    kept = sorted(r.version for r in report_versions(spark, path).orderBy(F.desc("version")).take(keep))
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/versions")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if kept and name < kept[0]:
            files.delete(status.getPath(), True)
            gone.append(name)
    return gone
