"""Helpers that several operators share: scratch tables, document columns, ordering.

Scratch tables are Parquet folders below ``spark.checkpoint.dir``, the folder that
driver and executors share.  They cut lineage like a checkpoint (a lost executor
re-reads the files) and, unlike a cached frame, hold no executor memory.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import planpulse
from planpulse.session import ensure_checkpoint_dir

COPIES = 1000   # of one row, dealt to a task together
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Functions run in tasks are found by import; a cluster that already has the package
    (``--py-files``) only gets the same files again.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(planpulse.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="planpulse-package-"), "planpulse_package.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; never reused, so retries cannot mix."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/planpulse-{uuid.uuid4().hex}/{name}"


def to_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and return a frame that reads it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         more: Iterable[Column] = ()) -> DataFrame:
    """The id and text columns (plus ``more``), under fixed names and nothing else.

    Further columns of the input, whatever their names, cannot clash with results.
    """
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"), *more)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def slices(n: int, step: int) -> Iterator[tuple[int, int]]:
    for a in range(0, n, step):
        yield a, min(n, a + step)


def rows_batch(schema: pa.Schema, columns: list[Any]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)],
                                      schema=schema)


def in_order(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` written in ascending order of ``order`` (nulls first), with ``_part``, the
    number of its range partition: parts ascend with the order and hold whole key ranges.

    One range shuffle; every part is an ordinary task's share, so no task sees all rows.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    return to_scratch(ranged.withColumn("_part", F.spark_partition_id()), name)


def part_offsets(parts: DataFrame, group: list[str], sums: dict[str, str]) -> DataFrame:
    """Exclusive running sums over ``_part`` (within ``group``) of totals per part.

    ``parts`` has one row per part (and group); with no group the window's single
    task reads as many rows as there were partitions, not as there are documents.
    """
    w = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*group, "_part", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(out)
                                           for c, out in sums.items()])


def slots(df: DataFrame, group: str, order: list[str], copies: str, name: str, out: str = "slot") -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, in the order of ``order``.

    A row stands for ``copies`` equal ones and gets the number of the first; ``expanded``
    gives each copy its own.  Rows are range partitioned on (group, order), counted per
    part, and numbered inside their part; the part's offset is added.  A group of any size
    spans many parts where it differs in ``order``; rows alike in it should be few, with copies.
    """
    kept = in_order(df, [group, *order], name)
    counts = kept.groupBy(group, "_part").agg(F.sum(copies).alias("_n"))
    base = part_offsets(counts, [group], {"_n": "_base"})
    w = Window.partitionBy("_part", group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    before = F.sum(copies).over(w.rowsBetween(Window.unboundedPreceding, -1))
    inside = kept.withColumn("_i", F.coalesce(before, F.lit(0)))
    joined = inside.join(base, ["_part", group])
    return joined.withColumn(out, (F.col("_base") + F.col("_i")).cast("bigint")).drop("_base", "_i", "_part")


def expanded(df: DataFrame, copies: str, number: str, tasks: int) -> DataFrame:
    """Each row ``copies`` times, with ascending ``number``.

    Rows of many copies become runs of ``COPIES`` first, dealt evenly over ``tasks``.
    """
    one, many = df.filter(F.col(copies) == 1), df.filter(F.col(copies) > 1)
    at, n = F.col("_run") * COPIES, F.col(copies)
    runs = many.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({copies} - 1) div {COPIES}")))) \
               .withColumn(number, F.col(number) + at).withColumn(copies, F.least(n - at, F.lit(COPIES))).drop("_run") \
               .repartition(tasks)
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    return one.unionByName(runs.withColumn("_copy", each).withColumn(number, F.col(number) + F.col("_copy")).drop("_copy")).drop(copies)
