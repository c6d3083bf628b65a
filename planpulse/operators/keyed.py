"""Keyed deduplication and per-key flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the stated order (``DISTINCT ON``; W1, W6).

    ``order`` must state NULL placement and end in a unique tie-break (traps
    T2, T3).  Catalyst plans ``row_number() = 1`` as a ``WindowGroupLimit``
    that keeps one row per key inside every map task *before* the shuffle, so
    a hot key ships at most one row per task instead of its whole group.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(w))
              .filter(F.col("_rank") == 1)
              .drop("_rank"))


def best_flag(df: DataFrame, keys: Sequence[str], flag: str, out: str) -> DataFrame:
    """One row per key with the best value of a nullable boolean.

    ``ORDER BY flag DESC NULLS LAST`` then first row equals ``max(flag)``:
    TRUE > FALSE > NULL.  Aggregating before the join replaces the original
    fan-out-then-dedup, and the aggregate combines map-side.
    """
    return df.groupBy(*keys).agg(F.max(F.col(flag)).alias(out))


def first_flag(df: DataFrame, entity: str, day: str, eligible: Column | None = None,
               out: str = "is_repeat", history: DataFrame | None = None) -> DataFrame:
    """Flag rows whose entity has an eligible row on a strictly earlier day.

    Equivalent to the original ``LEFT JOIN (DISTINCT entity, day) ON
    earlier day`` existence test, without the fan-out: the entity's first
    eligible day is one partial aggregate, joined back on the entity key.  Where
    an entity may be hot, build a frame per entity and use ``salted_join``.
    ``history`` (default ``df``) is where earlier rows are looked for, so a
    caller can flag only the rows of a window against the whole history.
    """
    cond = F.lit(True) if eligible is None else eligible
    hist = df if history is None else history
    first = (hist.filter(cond).groupBy(entity)
                 .agg(F.min(F.col(day)).alias("_first_day")))
    return (df.join(first, on=entity, how="left")
              .withColumn(out, F.coalesce(F.col("_first_day") < F.col(day), F.lit(False)))
              .drop("_first_day"))
