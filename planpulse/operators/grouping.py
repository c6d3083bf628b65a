"""Aggregates: scoped grouping sets, arg-best, extremes, label ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planpulse import constants as K


def group_count(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(out))


def group_sum(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(col).alias(out))


def drop_dup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(keys))


def scoped_agg(df: DataFrame, scope: str, keys: Sequence[str], aggs: Sequence[Column],
               overall: str = K.OVERALL_LABEL) -> DataFrame:
    """Aggregate per (scope, keys) and over all scopes in one pass.

    ``GROUPING SETS ((scope, keys), (keys))``: the overall row covers every
    row, including those whose scope is NULL or unknown (trap T18).  One
    shuffle with map-side partial aggregation, instead of one scan per scope.
    """
    keys = list(keys)
    g = df.groupingSets([[scope, *keys], keys], scope, *keys) \
          .agg(*aggs, F.grouping(scope).alias("_overall"))
    return (g.withColumn(scope, F.when(F.col("_overall") == 1, F.lit(overall))
                                  .otherwise(F.col(scope)))
              .drop("_overall"))


def arg_best(df: DataFrame, keys: Sequence[str], value: str, period: str,
             period_order: str, out_value: str = "best_value",
             out_period: str = "best_period") -> DataFrame:
    """Best value per key and the period it came from.

    Strictly greater wins, so among equal values the earliest period
    (smallest ``period_order``) is kept; a best of 0 or less has no period
    (trap T20).  ``max_by`` is an ordinary aggregate, so it combines map-side.
    """
    best = F.max(F.col(value))
    which = F.max_by(F.col(period), F.struct(F.col(value), -F.col(period_order)))
    g = df.groupBy(*keys).agg(best.alias(out_value), which.alias("_p"))
    return (g.withColumn(out_value, F.greatest(F.coalesce(F.col(out_value), F.lit(0)), F.lit(0)))
             .withColumn(out_period, F.when(F.col(out_value) > 0, F.col("_p")))
             .drop("_p"))


def extreme_flags(df: DataFrame, cols: Sequence[str], reverse: Sequence[str] = (),
                  suffix: str = "_flag") -> DataFrame:
    """Mark the best and worst non-zero value of each metric column.

    Best is the maximum (the minimum for ``reverse`` columns), worst the
    other end; when all non-zero values are equal only 'best' is set; zeros
    are never marked.  The extremes are one global partial aggregate read as
    a scalar subquery: computed once, no join and no single-partition window.
    """
    stats = df.agg(*[F.max(F.when(F.col(c) != 0, F.col(c))).alias(f"hi{i}") for i, c in enumerate(cols)],
                   *[F.min(F.when(F.col(c) != 0, F.col(c))).alias(f"lo{i}") for i, c in enumerate(cols)])
    ext = stats.select(F.struct(*stats.columns).alias("x")).scalar()
    flags = {}
    for i, c in enumerate(cols):
        hi, lo, v = ext.getField(f"hi{i}"), ext.getField(f"lo{i}"), F.col(c)
        good, bad = (lo, hi) if c in reverse else (hi, lo)
        flags[c + suffix] = (F.when((v != 0) & (v == good), F.lit("best"))
                              .when((v != 0) & (v == bad) & (hi != lo), F.lit("worst")))
    return df.withColumns(flags)


def ordered_labels(df: DataFrame, label: str, preferred: Sequence,
                   last: Sequence = (), out: str = "label_rank") -> DataFrame:
    """Rank column: listed labels first in list order, then others, then ``last``.

    Sort by (``out``, label) to get: preferred order, extras ascending, then
    the trailing labels.
    """
    pref = F.array(*[F.lit(p) for p in preferred])
    pos = F.array_position(pref, F.col(label))
    n = len(preferred)
    rank = F.when(pos > 0, pos)
    if last:
        rank = rank.when(F.col(label).isin(list(last)), F.lit(n + 2))
    return df.withColumn(out, rank.otherwise(F.lit(n + 1)).cast("int"))
