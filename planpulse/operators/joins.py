"""Joins: exclusions, existence flags, lookups, the in-force range join, spines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse.functions.dates import as_date, month_start
from planpulse.operators.skew import bucket, hot_buckets


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    out = []
    for item in on:
        out.append((item, item) if isinstance(item, str) else tuple(item))
    return out


def exclude(df: DataFrame, terms: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with no match in ``terms`` (J3, J4, J5: ``NOT EXISTS``).

    ``on`` is a column name, or a list of names / (left, right) pairs.  A NULL
    key never matches, so such rows are kept, as ``NOT EXISTS`` keeps them.
    Written as ``left_anti`` directly: Catalyst does not turn the
    ``LEFT JOIN ... IS NULL`` spelling into an anti join.
    """
    pairs = _pairs(on)
    keys = terms.select(*[F.col(rk).alias(f"_x{i}") for i, (_, rk) in enumerate(pairs)])
    cond = None
    for i, (lk, _) in enumerate(pairs):
        c = df[lk] == keys[f"_x{i}"]
        cond = c if cond is None else cond & c
    return df.join(keys, cond, "left_anti")


def with_flag(df: DataFrame, keys_df: DataFrame, on, name: str) -> DataFrame:
    """Add boolean ``name``: the row's key exists in ``keys_df`` (J6, ``EXISTS``).

    The key side is reduced to distinct keys first (a map-side partial
    aggregate), so the join never fans out.
    """
    pairs = _pairs(on)
    keys = (keys_df.select(*[F.col(rk).alias(f"_k{i}") for i, (_, rk) in enumerate(pairs)])
                   .dropna().distinct().withColumn("_hit", F.lit(True)))
    cond = None
    for i, (lk, _) in enumerate(pairs):
        c = df[lk] == keys[f"_k{i}"]
        cond = c if cond is None else cond & c
    out = df.join(keys, cond, "left")
    return (out.withColumn(name, F.coalesce(F.col("_hit"), F.lit(False)))
               .drop("_hit", *[f"_k{i}" for i in range(len(pairs))]))


def lookup(df: DataFrame, dim: DataFrame, left_on: str, right_on: str,
           values: Sequence[str], default=None, bounded: bool = False) -> DataFrame:
    """Left join to a keyed dimension and keep ``values``.

    ``dim`` must have one row per key (dedup it with ``latest_per_key``
    first).  ``bounded=True`` marks a dimension whose size is known to be
    small by construction (a fixed label list, a calendar); only then is it
    broadcast explicitly.  Otherwise Spark's size estimate and AQE's runtime
    statistics choose between a broadcast and a sort-merge join.
    """
    right = dim.select(F.col(right_on).alias("_lk"), *values)
    if bounded:
        right = F.broadcast(right)
    out = df.join(right, df[left_on] == right["_lk"], "left").drop("_lk")
    if default is not None:
        out = out.fillna({v: default for v in values})
    return out


def salted_join(big: DataFrame, frame: DataFrame, on: str, salt_by: Sequence[str], salts: int = 8,
                how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """Join a large side whose key may be hot with a frame that has one row per key.

    A row's salt is a hash of ``salt_by`` (columns that tell the large side's rows apart, so
    a retried task gives the same salts); the frame is repeated once per salt.  A key that
    holds a third of all rows is then spread over ``salts`` tasks, whatever the plan around
    the join allows Spark to split at run time.  ``how``: ``inner`` or ``left``.

    ``counted`` is a frame that is cheap to read and has at least as many rows of each key as
    ``big`` (the table that ``big`` was made from): then only keys in its hot buckets
    (``operators.skew``) are salted, and the frame is repeated for those alone.
    """
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")
    if counted is not None:
        hot = hot_buckets(counted.select(on), on).withColumn("_hot", F.lit(True))

        def told(df: DataFrame) -> DataFrame:
            return df.withColumn("_bucket", bucket(on)).join(F.broadcast(hot), "_bucket", "left")

        of_key = F.when(F.col("_hot"), salt).otherwise(F.lit(0))
        last = F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(F.lit(0))
        wide = told(frame).withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_bucket", "_hot")
        return told(big).withColumn("_salt", of_key).drop("_bucket", "_hot").join(wide, [on, "_salt"], how).drop("_salt")
    wide = frame.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", salt).join(wide, [on, "_salt"], how).drop("_salt")


def in_force(plans: DataFrame, start: str, due: str, first_month: dt.date | str,
             as_of: dt.date | str, month_col: str = "month_start") -> DataFrame:
    """One row per (month, plan) in force at the month's reference date.

    Months run from ``first_month`` to the month of ``as_of``; a month's
    reference date is its last day, or ``as_of`` in the current month, and a
    plan is in force when ``start < ref < due`` (both strict).

    Instead of a theta join of months x plans (a nested-loop join), each plan
    expands to the months between its own start and due months, clipped to
    the window -- the reference date always lies in its own month, so no
    other month can match.  The expansion is a narrow operator: no shuffle,
    and at most (window length) rows per plan.
    """
    s, d = F.col(start), F.col(due)
    lo = F.greatest(F.trunc(s, "month"), as_date(first_month))
    hi = F.least(F.trunc(d, "month"), month_start(as_of))
    months = F.when(s.isNotNull() & d.isNotNull() & (lo <= hi),
                    F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH")))
    ref = F.least(F.last_day(F.col(month_col)), as_date(as_of))
    return (plans.withColumn(month_col, F.explode(months))
                 .withColumn("ref_date", ref)
                 .filter((s < F.col("ref_date")) & (d > F.col("ref_date")))
                 .withColumn("is_current_month", F.col(month_col) == month_start(as_of)))


def spine_join(frames: Sequence[DataFrame], key: str, metrics: Sequence[str],
               fill=0) -> DataFrame:
    """Every key seen in any frame, with each frame's metrics, missing -> ``fill``.

    Each frame has one row per key.  Instead of a spine plus one left join
    per frame, the frames are unioned (missing metric columns are NULL) and
    grouped once: one shuffle of already-aggregated rows.
    """
    parts = [f.select(key, *[c for c in metrics if c in f.columns]) for f in frames]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    for c in metrics:
        if c not in u.columns:
            u = u.withColumn(c, F.lit(None).cast("bigint"))
    out = (u.filter(F.col(key).isNotNull())
            .groupBy(key).agg(*[F.sum(c).alias(c) for c in metrics]))
    return out.select(key, *[F.coalesce(F.col(c), F.lit(fill)).cast("bigint").alias(c)
                             for c in metrics])
