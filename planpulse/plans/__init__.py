"""Composite reports (the public API).

Input frames use neutral column names (see ``planpulse.schemas``):

* plans:        plan_id, plan_ref, entity_id, start_date, due_date, amount, source,
                branch, owner_a, owner_b
* entities:     entity_id, name, branch, source, contact, csr_id
* assignments:  plan_id, status
* terms:        plan_ref, and the visit key columns
* visits:       visit key columns, entity_id, visit_date, slot, status, staff, amount
* prescriptions: entity_id, suggested (nullable boolean)
* roster:       roster_id, staff_id, slot_date, task, booked, is_active
* roster_map:   roster_id, entity_id
"""

from planpulse.plans.snapshots import active_snapshots, lapsed_entities  # noqa: F401
from planpulse.plans.cycle import plan_cycle, plan_cycle_simple  # noqa: F401
from planpulse.plans.visits import conversions, sessions_by_staff, visits_classified  # noqa: F401
