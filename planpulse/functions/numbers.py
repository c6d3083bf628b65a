"""Numeric report expressions.

Rounding is half-to-even (``bround``) throughout, like Python's ``round``;
Spark's ``round`` is half-up (trap T6).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from planpulse import constants as K


def _c(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def default_zero(c, value=0) -> Column:
    return F.coalesce(_c(c), F.lit(value))


MONEY = "decimal(18,2)"


def money(c) -> Column:
    """Tolerant money: unparsable or missing -> 0, as an exact DECIMAL(18,2)."""
    return F.coalesce(_c(c).try_cast(MONEY), F.lit(0).cast(MONEY))


def cents(c) -> Column:
    """Money as whole cents (BIGINT).  Sums of cents are exact and run on Spark's
    fast long aggregation path; wide DECIMAL sums fall back to BigDecimal."""
    return (_c(c).cast(MONEY) * 100).cast("bigint")


def from_cents(c) -> Column:
    """Cents back to a DOUBLE amount: one correctly rounded division, the same
    value a cast of the exact decimal sum gives."""
    return _c(c).cast("double") / 100.0


def default_amount(c, value=K.DEFAULT_VISIT_AMOUNT) -> Column:
    """Tolerant money, then 0 -> ``value`` (P11).  Sums of money stay exact DECIMAL."""
    x = money(c)
    return F.when(x == 0, F.lit(value).cast(MONEY)).otherwise(x)


def clamp_low(c, low=1) -> Column:
    """NULL or below ``low`` -> ``low``."""
    x = _c(c)
    return F.when(x.isNull() | (x < low), F.lit(low)).otherwise(x)


def ratio_pct(a, b, digits: int = 1) -> Column:
    """``a / b * 100`` to ``digits`` decimals, 0.0 when b is 0 or NULL."""
    a, b = _c(a), _c(b)
    return F.when(F.coalesce(b, F.lit(0)) == 0, F.lit(0.0)) \
        .otherwise(F.bround(a.cast("double") / b.cast("double") * 100.0, digits))


def _flag(reverse) -> Column:
    return reverse if isinstance(reverse, Column) else F.lit(bool(reverse))


def change_pct(cur, prev, reverse=False, flat: float = K.FLAT_CHANGE) -> Column:
    """Change against the previous period as a struct.

    Fields: ``pct`` (absolute percent to 1 decimal, NULL when there is no
    base), ``direction`` (none / new / flat / up / down) and ``signal``
    (good / bad / none; reversed metrics treat up as bad).
    """
    cur, prev, rev = _c(cur).cast("double"), _c(prev).cast("double"), _flag(reverse)
    change = (cur - prev) / prev * 100.0
    up = cur > prev
    good_if_up = F.when(rev, F.lit("bad")).otherwise(F.lit("good"))
    bad_if_up = F.when(rev, F.lit("good")).otherwise(F.lit("bad"))
    both_zero = (prev == 0) & (cur == 0)
    is_new = prev == 0
    is_flat = F.abs(change) < flat
    direction = (F.when(both_zero, "none").when(is_new, "new").when(is_flat, "flat")
                  .when(up, "up").otherwise("down"))
    signal = (F.when(both_zero, "none").when(is_new, good_if_up).when(is_flat, "none")
               .when(up, good_if_up).otherwise(bad_if_up))
    pct = (F.when(both_zero | is_new, F.lit(None).cast("double"))
            .when(is_flat, F.lit(0.0)).otherwise(F.abs(F.bround(change, 1))))
    return F.struct(pct.alias("pct"), direction.alias("direction"), signal.alias("signal"))


def change_pp(cur, prev, flat: float = K.FLAT_CHANGE) -> Column:
    """Change in percentage points for ratio metrics, same struct as ``change_pct``."""
    cur, prev = _c(cur).cast("double"), _c(prev).cast("double")
    diff = F.bround(cur - prev, 1)
    any_value = (cur != 0) | (prev != 0)
    is_flat = F.abs(diff) < flat
    up = cur > prev
    direction = (F.when(~any_value, "none").when(is_flat, "flat").when(up, "up").otherwise("down"))
    signal = (F.when(~any_value | is_flat, "none").when(up, "good").otherwise("bad"))
    pct = F.when(~any_value, F.lit(None).cast("double")).when(is_flat, F.lit(0.0)) \
        .otherwise(F.abs(diff))
    return F.struct(pct.alias("pct"), direction.alias("direction"), signal.alias("signal"))


def attainment(achieved, target) -> Column:
    """``achieved / target * 100`` to 1 decimal; 0 when the target is 0; NULL without target (F16)."""
    a, t = _c(achieved).cast("double"), _c(target).cast("double")
    return F.when(t.isNull(), F.lit(None).cast("double")).when(t == 0, F.lit(0.0)) \
        .otherwise(F.bround(a / t * 100.0, 1))


def pending_pct(attained) -> Column:
    """``max(0, 100 - attained)`` to 1 decimal (F16)."""
    p = _c(attained)
    return F.when(p.isNotNull(), F.bround(F.greatest(F.lit(0.0), F.lit(100.0) - p), 1))


def derived_target(active, share: float = K.RENEWAL_TARGET_SHARE) -> Column:
    """``round(active * share)``, half to even (F17): 6 * 0.75 = 4.5 -> 4."""
    return F.bround(_c(active).cast("double") * share, 0).cast("bigint")


def prorate(target, ratio) -> Column:
    """``round(target * ratio)``, half to even."""
    return F.bround(_c(target).cast("double") * _c(ratio).cast("double"), 0).cast("bigint")


def to_whole(c) -> Column:
    """``int(round(x))``."""
    return F.bround(_c(c).cast("double"), 0).cast("bigint")


def thousands_label(c) -> Column:
    """``1,234,567``; blank for 0 or NULL."""
    x = _c(c)
    return F.when(F.coalesce(x, F.lit(0)) == 0, F.lit("")) \
        .otherwise(F.format_string("%,d", to_whole(x)))
