"""Working-day calendar.

Working days are every day but Sunday.  The per-month figures are column
expressions (closed forms), so a calendar over any set of months is a narrow
projection, not a day-by-day expansion.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse.functions.dates import nth_working_day, working_days_between


def working_days_py(d1: dt.date, d2: dt.date) -> int:
    """Working days in ``[d1, d2]`` for driver-side report parameters (0 if d2 < d1)."""
    if d2 < d1:
        return 0
    days = (d2 - d1).days + 1
    return sum(1 for i in range(days) if (d1 + dt.timedelta(days=i)).weekday() != 6)


def month_progress(as_of: dt.date) -> tuple[int, int]:
    """(working days from the 1st of yesterday's month to yesterday, in the whole month)."""
    y = as_of - dt.timedelta(days=1)
    m0 = y.replace(day=1)
    nxt = (m0 + dt.timedelta(days=32)).replace(day=1)
    return working_days_py(m0, y), working_days_py(m0, nxt - dt.timedelta(days=1))


def working_calendar(months: DataFrame, month_col: str, nth: tuple[int, ...] = ()) -> DataFrame:
    """Per month: days, working days, and the date of each requested n-th working day.

    n < 1 gives the 1st; n beyond the month's working days gives its last
    working day.
    """
    m = F.trunc(F.col(month_col), "month")
    out = months.select(m.alias("month_start")).distinct() \
        .withColumn("days_in_month", F.dayofmonth(F.last_day("month_start"))) \
        .withColumn("working_days", working_days_between(F.col("month_start"), F.last_day("month_start")))
    for n in nth:
        name = f"working_day_{n}" if n >= 0 else f"working_day_m{-n}"
        out = out.withColumn(name, nth_working_day(F.col("month_start"), n))
    return out


def month_refs(spark, first_month: dt.date, as_of: dt.date) -> DataFrame:
    """(month_start, ref_date, is_current_month) from ``first_month`` to the month of ``as_of``.

    The reference date is the month's last day, or ``as_of`` in the current
    month.  One row per calendar month: bounded by the calendar.
    """
    from planpulse.functions.dates import as_date, is_current_month, month_end_capped, month_start
    months = F.explode(F.sequence(as_date(first_month), month_start(as_of), F.expr("INTERVAL 1 MONTH")))
    return spark.range(1).select(months.alias("month_start")).select(
        "month_start", month_end_capped("month_start", as_of).alias("ref_date"),
        is_current_month("month_start", as_of).alias("is_current_month"))


def periods(spark, as_of: dt.date) -> DataFrame:
    """(period, d1, d2, active_month): yesterday, month-to-date, last month's same span."""
    from planpulse.plans.scorecards import report_periods
    rows = [(name, d1, d2, m) for name, (d1, d2, m) in report_periods(as_of).items()]
    return spark.createDataFrame(rows, "period string, d1 date, d2 date, active_month date")
