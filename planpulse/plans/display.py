"""Display form of the reports: headings, formatted numbers, report order.

The computed reports keep typed columns; this module only renames, formats
and orders them for the written output, as the original's sheets did.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse import constants as K
from planpulse.functions.numbers import thousands_label


def with_headings(df: DataFrame, headings: Sequence[tuple[str, str]]) -> DataFrame:
    """Select the listed columns, in order, under their display headings."""
    return df.select(*[F.col(c).alias(h) for c, h in headings])


def period_headings(as_of: dt.date) -> dict[str, str]:
    """Column headings of the scorecard periods, e.g. 'Yesterday (15-Mar)' (F25)."""
    from planpulse.plans.scorecards import report_periods
    p = report_periods(as_of)
    return {name: form.format(d1=p[name][0].day, m1=p[name][0].strftime("%b"), d2=p[name][1].day, m2=p[name][1].strftime("%b"))
            for name, form in K.PERIOD_HEADINGS}


def display_scorecard(card: DataFrame, as_of: dt.date) -> DataFrame:
    """Scorecard with period headings, ratio rows as 'x%', amounts as '1,234' (blank for 0)."""
    h = period_headings(as_of)
    is_ratio = F.col("metric").isin(list(K.RATIO_CATEGORIES))
    is_rev = F.col("metric") == K.REVENUE_LABEL

    def value(c):
        v = F.col(c)
        return (F.when(is_ratio, F.concat(v.cast("string"), F.lit("%")))
                 .when(is_rev, thousands_label(v))
                 .otherwise(v.cast("bigint").cast("string")))

    order = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in (*K.CATEGORIES, K.REVENUE_LABEL)]),
                                        F.col("metric")), F.lit(99))
    return card.orderBy("scope", order).select(
        "scope", F.col("metric").alias("Category"),
        value("yesterday").alias(h["yesterday"]), value("mtd").alias(h["mtd"]),
        value("last_month").alias(h["last_month"]),
        F.col("direction").alias("vs Last Month"), F.col("change_pct").alias("Change %"),
        thousands_label("amount").alias("Amount"), F.col("target").alias("Target"),
        F.col("attained").alias("% Achieved"), F.col("pending").alias("Pending %"))


def display_reports(reports: dict[str, DataFrame], as_of: dt.date) -> dict[str, DataFrame]:
    """The written form of each report that has one; others are returned unchanged."""
    out = dict(reports)
    for name in ("staff_yesterday", "staff_mtd"):
        if name in out:
            out[name] = with_headings(out[name].orderBy("staff"), K.STAFF_HEADINGS)
    if "scorecard" in out:
        out["scorecard"] = display_scorecard(out["scorecard"], as_of)
    if "target_vs_achieved" in out:
        out["target_vs_achieved"] = with_headings(
            out["target_vs_achieved"].orderBy("scope", "metric"), (("scope", "scope"), *K.TARGET_HEADINGS))
    if "source_mix" in out:
        out["source_mix"] = with_headings(out["source_mix"], K.SOURCE_HEADINGS) \
            .withColumn("NO2P %", F.concat(F.col("NO2P %").cast("string"), F.lit("%")))
    if "duration_mix" in out:
        out["duration_mix"] = out["duration_mix"].orderBy("period", "scope", "label_rank", "duration_months")
    return out
