"""Row predicates (P2-P8). All keep SQL three-valued logic: a NULL input gives
NULL, and ``filter`` drops it, as the reference's WHERE clauses do."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from planpulse.functions.dates import month_start


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_in(c, values: Iterable) -> Column:
    """``c NOT IN (...)``: NULL input is dropped too."""
    return ~_c(c).isin(list(values))


def in_list(c, values: Iterable) -> Column:
    return _c(c).isin(list(values))


def non_empty(c) -> Column:
    """``c IS NOT NULL AND c <> ''`` (P7); ``c <> ''`` alone already drops NULL."""
    return _c(c) != F.lit("")


def reject_affix(c, word: str) -> Column:
    """Case-insensitive ``NOT LIKE 'word%' AND NOT LIKE '%word'``."""
    low = F.lower(_c(c))
    w = word.lower()
    return ~low.startswith(w) & ~low.endswith(w)


def since_months(c, as_of: dt.date | str, n: int = 12) -> Column:
    """``c >= month_start(as_of) - n months`` with no upper bound."""
    return _c(c) >= F.add_months(month_start(as_of), -n)
