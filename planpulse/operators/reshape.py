"""Role pivot and unpivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_roles(df: DataFrame, cols: Sequence[str], name: str,
                  keep: Sequence[str] = (), role: str = "role") -> DataFrame:
    """One row per (row, role column) with a non-NULL value.

    Same as ``UNION ALL`` of the role columns: a person in both roles of one
    row appears twice.
    """
    ids = list(keep) if keep else []
    base = df.select(*ids, *cols)
    if not ids:
        base = base.withColumn("_row", F.lit(1))
        ids = ["_row"]
    out = base.unpivot(ids, list(cols), role, name).filter(F.col(name).isNotNull())
    return out.drop("_row") if "_row" in out.columns else out


def pivot_roles(df: DataFrame, key: str, role: str, value: str,
                roles: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """``MAX(CASE WHEN role = r THEN value END)`` per listed role (A5).

    The role list is passed in, so Spark does not run a job to find it.
    """
    names = list(names) if names else list(roles)
    out = df.groupBy(key).pivot(role, list(roles)).agg(F.max(value))
    for r, n in zip(roles, names):
        if r != n:
            out = out.withColumnRenamed(r, n)
    return out
