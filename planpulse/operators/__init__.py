"""Relational building blocks shared by the composite reports."""

from planpulse.operators.grouping import (  # noqa: F401
    arg_best, drop_dup, extreme_flags, group_count, group_sum, ordered_labels, scoped_agg,
)
from planpulse.operators.history import plan_history  # noqa: F401
from planpulse.operators.joins import (  # noqa: F401
    exclude, in_force, lookup, salted_join, spine_join, with_flag,
)
from planpulse.operators.keyed import best_flag, first_flag, latest_per_key  # noqa: F401
from planpulse.operators.reshape import pivot_roles, unpivot_roles  # noqa: F401
