"""Column -> Column helpers (all JVM-side expressions, no Python UDFs)."""

from planpulse.functions.dates import (  # noqa: F401
    as_date, day_month_label, is_current_month, month_end_capped, month_label,
    month_start, nth_working_day, range_label, trailing_months, whole_months,
    working_days_between,
)
from planpulse.functions.numbers import (  # noqa: F401
    attainment, change_pct, change_pp, clamp_low, default_amount, default_zero,
    derived_target, pending_pct, prorate, ratio_pct, thousands_label, to_whole,
)
from planpulse.functions.predicates import (  # noqa: F401
    in_list, non_empty, not_in, reject_affix, since_months,
)
from planpulse.functions.text import (  # noqa: F401
    clean_text, duration_label, json_list_text, recode, source_rule, strip_ws,
)
from planpulse.functions.nested import iso_local_date, variant_text  # noqa: F401
