"""Best-month benchmark and target versus achieved."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from planpulse import constants as K
from planpulse.functions.dates import as_date, month_label, nth_working_day
from planpulse.functions.numbers import derived_target, prorate
from planpulse.operators.grouping import arg_best
from planpulse.plans.calendar import month_progress
from planpulse.plans.scorecards import tagged_metrics


def _months(first: dt.date, stop: dt.date) -> list[dt.date]:
    out, m = [], first.replace(day=1)
    while m < stop:
        out.append(m)
        m = (m + dt.timedelta(days=32)).replace(day=1)
    return out


def best_period(facts: DataFrame, as_of: dt.date, best_from: dt.date) -> DataFrame:
    """Per scope, category and span: the best earlier month and its value.

    Months run from ``best_from`` to the month before yesterday's month.  Span
    'same' covers the 1st to the n-th working day, n = working days so far
    this month; span 'full' the whole month.  Strictly greater wins, so the
    earliest month keeps ties; a best of 0 has an empty label (trap T20).
    ``facts`` is ``scorecards.metric_facts(...)``.
    """
    y = as_of - dt.timedelta(days=1)
    m0 = y.replace(day=1)
    sofar, _ = month_progress(as_of)
    months = _months(best_from, m0)
    month_of = F.when(F.col("metric") == "Active", F.col("month")) \
        .otherwise(F.trunc(F.col("day"), "month"))
    in_range = (month_of >= as_date(best_from)) & (month_of < as_date(m0))
    same = (F.col("metric") == "Active") | (F.col("day") <= nth_working_day(month_of, sofar))
    label = F.date_format(month_of, "yyyy-MM-dd")
    tags = F.array(F.when(in_range, F.concat(label, F.lit("|full"))),
                   F.when(in_range & same, F.concat(label, F.lit("|same"))))
    periods = F.array(*[F.lit(f"{m.isoformat()}|{s}") for m in months for s in ("same", "full")])
    long = tagged_metrics(facts, tags, periods).filter(F.col("metric") != K.REVENUE_LABEL)
    long = long.withColumn("month", F.to_date(F.substring("period", 1, 10))) \
               .withColumn("span", F.substring_index("period", "|", -1)) \
               .withColumn("_order", F.datediff("month", F.lit("1970-01-01").cast("date")))
    best = arg_best(long, ["scope", "metric", "span"], "value", "month", "_order",
                    out_value="best_value", out_period="_best_month")
    return best.withColumn("best_label", F.coalesce(month_label("_best_month"), F.lit(""))) \
               .withColumnRenamed("_best_month", "best_month")


def resolve_targets(metrics: DataFrame, targets: DataFrame | None) -> DataFrame:
    """(scope, metric, target, achieved): the month-to-date rows with the looked-up target,
    Renewals' derived from last month's Active (a window over a scope's few rows)."""
    active = F.when((F.col("period") == "last_month") & (F.col("metric") == "Active"), F.col("value"))
    base = metrics.withColumn("_lm_active", F.max(active).over(Window.partitionBy("scope"))) \
        .filter(F.col("period") == "mtd").select("scope", "metric", "_lm_active", F.col("value").alias("achieved"))
    if targets is not None:
        t = targets.select(F.col("scope").alias("_ts"), F.col("category").alias("_tc"),
                           F.col("target").cast("bigint").alias("_t"))
        base = base.join(t, (base.scope == t._ts) & (base.metric == t._tc), "left").drop("_ts", "_tc")
    else:
        base = base.withColumn("_t", F.lit(None).cast("bigint"))
    target = F.when(F.col("metric") == "Renewals",
                    derived_target(F.coalesce(F.col("_lm_active"), F.lit(0.0)))).otherwise(F.col("_t"))
    return base.select("scope", "metric", target.alias("target"), "achieved")


def target_vs_achieved(metrics: DataFrame, best: DataFrame, targets: DataFrame | None,
                       as_of: dt.date) -> DataFrame:
    """Target, month-to-date pro-rated target, best month, achieved and met.

    Pro-rated target = round-half-even(target x working days so far / working
    days in the month); met = achieved >= pro-rated.  Ratio metrics and
    Revenue are left out.
    """
    sofar, total = month_progress(as_of)
    ratio = (sofar / total) if total else 0.0
    cats = [c for c in K.CATEGORIES if c not in K.RATIO_CATEGORIES]
    b = best.filter(F.col("span") == "same").select("scope", "metric", "best_value", "best_label")
    t = resolve_targets(metrics, targets).filter(F.col("metric").isin(cats))
    out = t.join(b, ["scope", "metric"], "left")
    pro = prorate(F.col("target"), F.lit(ratio))
    return out.select("scope", "metric", "target",
                      F.when(F.col("target").isNotNull(), pro).alias("prorated_target"),
                      F.coalesce(F.col("best_value"), F.lit(0.0)).alias("best_value"),
                      F.coalesce(F.col("best_label"), F.lit("")).alias("best_label"),
                      "achieved",
                      F.when(F.col("target").isNotNull(), F.col("achieved") >= pro).alias("met"))
