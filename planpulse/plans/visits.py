"""Visits: first versus repeat, sessions per staff, conversions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse import constants as K
from planpulse.functions.dates import as_date, month_label, trailing_months
from planpulse.functions.predicates import in_list, non_empty, not_in
from planpulse.operators.joins import exclude, salted_join
from planpulse.operators.keyed import latest_per_key


def visits_classified(visits: DataFrame, entities: DataFrame, prescriptions: DataFrame,
                      terms: DataFrame | None, as_of: dt.date | str,
                      statuses: Sequence[int] = K.COMPLETED_VISIT_STATUSES,
                      excluded_sources: Sequence[str] = K.EXCLUDED_SOURCES,
                      visit_keys: Sequence[str] = ("visit_id",),
                      history_months: int = K.HISTORY_MONTHS,
                      entity_cols: Sequence[str] = (), entity_kind: str | None = None) -> DataFrame:
    """Completed visits of the trailing window, NEW or OLD, with the suggestion flag.

    * OLD when the entity has a visit with a non-empty slot on a strictly
      earlier day, of any status (trap T19); two visits on the first day are
      both NEW;
    * kept: status in ``statuses``, non-empty slot, day in the window ending
      at ``as_of``, entity source not excluded, no exclusion term on the visit;
    * ``is_suggest``: 'Yes' / 'No' / NULL from the entity's best prescription
      flag (TRUE > FALSE > NULL) -- per entity, not per visit (trap T16);
    * ``entity_cols`` are further attributes copied from the entity table, ``entity_kind`` is a
      constant column.
    """
    keys = list(visit_keys)
    # Row filters and the term exclusion (keyed by visit) come first; earlier visits are
    # looked up in the whole history.  What depends on the entity alone -- attributes, first
    # day, best flag -- is one frame with a row per entity, joined to the visits once.
    v = visits.filter(trailing_months("visit_date", as_of, history_months)
                      & non_empty("slot") & in_list("status", statuses))
    if terms is not None:
        v = exclude(v, terms.select(*keys).dropna(), keys)
    frame = visit_history(visits, prescriptions)
    extra = [c for c in entity_cols if c not in ("entity_id", "name", "source", "branch")]
    ent = entities.select("entity_id", F.col("source").alias("entity_source"),
                          F.col("branch").alias("entity_branch"), "name", *extra)
    frame = ent.filter(not_in("entity_source", excluded_sources)).join(frame, "entity_id", "left")
    v = salted_join(v, frame, "entity_id", keys)
    repeat = F.coalesce(F.col("_first_day") < F.col("visit_date"), F.lit(False))
    if entity_kind is not None:
        v = v.withColumn("entity_kind", F.lit(entity_kind))
    return (v.withColumn("opd_status", F.when(repeat, F.lit("OLD OPD")).otherwise(F.lit("NEW OPD")))
             .withColumn("is_suggest", F.when(F.col("_suggested"), F.lit("Yes"))
                                        .when(~F.col("_suggested"), F.lit("No")))
             .withColumn("opd_month", month_label("visit_date"))
             .drop("_first_day", "_suggested"))


def visit_history(visits: DataFrame, prescriptions: DataFrame) -> DataFrame:
    """Per entity the first day with a non-empty slot (J9) and the best prescription flag.

    Both inputs go through one aggregate with map-side partial results: a hot entity ships
    one row per task, and the entity is shuffled once.  Prescriptions without a flag say
    nothing and are left out first.
    """
    days = visits.filter(non_empty("slot")).select("entity_id", F.col("visit_date").alias("_first_day"),
                                                   F.lit(None).cast("boolean").alias("_suggested"))
    flags = prescriptions.filter(F.col("suggested").isNotNull()).select("entity_id", F.lit(None).cast("date").alias("_first_day"),
                                 F.col("suggested").alias("_suggested"))
    return days.unionByName(flags).groupBy("entity_id").agg(F.min("_first_day").alias("_first_day"),
                                                            F.max("_suggested").alias("_suggested"))


def session_entity_type(csr_id, source, corporate_sources=K.CORPORATE_SOURCES):
    """csr_id NULL (also: no entity) or 'regular' -> Regular; corporate source -> Corporate; else NTPC."""
    c = F.col(csr_id)
    return (F.when(c.isNull() | (c == "regular"), F.lit("Regular"))
             .when(F.col(source).isin(list(corporate_sources)), F.lit("Corporate"))
             .otherwise(F.lit("NTPC")))


def sessions_by_staff(roster: DataFrame, roster_map: DataFrame, entities: DataFrame,
                      first_day: dt.date | str, as_of: dt.date | str, task: str,
                      corporate_sources: Sequence[str] = K.CORPORATE_SOURCES) -> DataFrame:
    """Booked, active sessions of one task type per slot day, staff and entity.

    The roster map and the entity table are reduced to one row per key with
    a stated tie-break (the original picked an arbitrary row, trap T3), then
    left-joined; ``csr_id`` is a grouping key but not an output column.
    """
    r = roster.filter((F.col("booked") == 1) & (F.col("is_active") == 1)
                      & (F.col("task") == task)
                      & F.col("slot_date").between(as_date(first_day), as_date(as_of)))
    m = latest_per_key(roster_map.select("roster_id", "entity_id"), ["roster_id"],
                       [F.col("entity_id").asc_nulls_last()])
    e = latest_per_key(entities.select("entity_id", "csr_id", "source", "name", "contact", "branch"),
                       ["entity_id"], [F.col("name").asc_nulls_last(), F.col("contact").asc_nulls_last(),
                                       F.col("branch").asc_nulls_last(), F.col("source").asc_nulls_last(),
                                       F.col("csr_id").asc_nulls_last()])
    # Slots without an entity share a NULL key: salted, they are no single task's share.
    j = salted_join(r.join(m, "roster_id", "left"), e, "entity_id", ["roster_id"], how="left")
    keys = ["slot_date", "task", "is_active", "booked", "staff_id", "entity_id",
            "branch", "name", "contact", "csr_id", "source"]
    g = j.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("total_sessions"))
    return (g.withColumn("entity_type", session_entity_type("csr_id", "source", corporate_sources))
             .drop("csr_id"))


def conversions(visits: DataFrame, plans: DataFrame, d1: dt.date | str, d2: dt.date | str,
                staff: str = "staff", new_visit: str = "NEW OPD",
                new_plan: str = "NEW PLAN") -> DataFrame:
    """Per staff, distinct entities with a new visit and a new plan both in ``[d1, d2]``.

    No order between the two dates is required.  NULL ids never match
    (trap T11: the original compared the text 'None').

    Visits are reduced to distinct (entity, staff) pairs first, within each task and then by
    both columns, so an entity with a third of all visits meets the plans with one row per
    staff member; the plans' entities are distinct too.
    """
    lo, hi = as_date(d1), as_date(d2)
    nv = visits.filter((F.col("opd_status") == new_visit) & F.col("visit_date").between(lo, hi)
                       & F.col(staff).isNotNull() & F.col("entity_id").isNotNull())
    np_ = plans.filter((F.col("plan_status") == new_plan) & F.col("start_date").between(lo, hi)) \
               .select("entity_id")
    conv = nv.select("entity_id", staff).distinct().join(np_.distinct(), "entity_id", "left_semi")
    return conv.groupBy(staff).agg(F.count(F.lit(1)).cast("bigint").alias("conversions"))
