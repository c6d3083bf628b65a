"""Calendar expressions (F1-F6, F23, F25, C11 pieces)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d) -> Column:
    """A date literal from ``datetime.date`` / ISO text, or a date column as is."""
    if isinstance(d, Column):
        return d
    if isinstance(d, dt.date):
        d = d.isoformat()
    return F.lit(d).cast("date")


def month_start(d) -> Column:
    return F.trunc(as_date(d), "month")


def month_end_capped(m, as_of) -> Column:
    """``LEAST(month_start + 1 month - 1 day, as_of)`` (F2)."""
    return F.least(F.last_day(_c(m)), as_date(as_of))


def is_current_month(m, as_of) -> Column:
    """``month_start = date_trunc('month', as_of)``."""
    return _c(m) == month_start(as_of)


def trailing_months(c, as_of, n: int = 12) -> Column:
    """``c BETWEEN month_start(as_of) - n months AND as_of`` (P5)."""
    return _c(c).between(F.add_months(month_start(as_of), -n), as_date(as_of))


def whole_months(start, due) -> Column:
    """Whole months from ``start`` to ``due``, as years*12 + months of AGE.

    31 Jan -> 28 Feb is 0 months; ``months_between`` would say 1.
    """
    return F.timestamp_diff("MONTH", _c(start).cast("timestamp"), _c(due).cast("timestamp"))


def month_label(c) -> Column:
    """``Mon-YY`` label, e.g. ``Mar-26``."""
    return F.date_format(_c(c), "MMM-yy")


def day_month_label(c) -> Column:
    """``15-Mar``."""
    return F.concat(F.dayofmonth(_c(c)).cast("string"), F.lit("-"), F.date_format(_c(c), "MMM"))


def range_label(d1, d2) -> Column:
    """``1-15 Mar``."""
    return F.concat(F.dayofmonth(_c(d1)).cast("string"), F.lit("-"),
                    F.dayofmonth(_c(d2)).cast("string"), F.lit(" "), F.date_format(_c(d2), "MMM"))


def _sundays_between(d1: Column, d2: Column) -> Column:
    first_sunday = F.next_day(F.date_sub(d1, 1), "Sun")
    n = F.floor(F.datediff(d2, first_sunday) / 7) + 1
    return F.when(first_sunday > d2, F.lit(0)).otherwise(n)


def working_days_between(d1, d2) -> Column:
    """Days in ``[d1, d2]`` other than Sunday; 0 when ``d2 < d1`` (C11)."""
    a, b = _c(d1), _c(d2)
    total = F.datediff(b, a) + 1
    return F.when(b < a, F.lit(0)).otherwise(total - _sundays_between(a, b)).cast("int")


def nth_working_day(m, n) -> Column:
    """Date of the n-th non-Sunday day of the month that starts at ``m`` (C11).

    n < 1 gives the 1st itself; n beyond the month's working days gives the
    month's last working day.  Closed form: working day k (1-based) sits at
    offset k-1 before the first Sunday, and one more day is skipped for every
    six working days after it.
    """
    m = _c(m)
    n = n if isinstance(n, Column) else F.lit(n)
    first_sunday_offset = F.datediff(F.next_day(F.date_sub(m, 1), "Sun"), m)
    k0 = n - 1
    offset = F.when(k0 < first_sunday_offset, k0).otherwise(
        k0 + 1 + F.floor((k0 - first_sunday_offset) / 6))
    last = F.last_day(m)
    last_working = F.when(F.dayofweek(last) == 1, F.date_sub(last, 1)).otherwise(last)
    candidate = F.date_add(m, offset.cast("int"))
    return (F.when(n < 1, m)
             .when(candidate > last_working, last_working)
             .otherwise(candidate))
