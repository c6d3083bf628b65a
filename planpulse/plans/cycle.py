"""Plan classification: new / renewal / late renewal / revival."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse import constants as K
from planpulse.functions.dates import as_date, trailing_months, whole_months
from planpulse.functions.predicates import non_empty, not_in, reject_affix, since_months
from planpulse.operators.history import plan_history
from planpulse.operators.joins import exclude, salted_join, with_flag
from planpulse.operators.keyed import latest_per_key
from planpulse.operators.reshape import pivot_roles
from planpulse.plans.snapshots import primary_diagnosis


def entity_type(source, amount, csr_id, corporate: str = K.CORPORATE_PLAN_SOURCE, csr_like: str = K.CSR_PLAN_SOURCE,
                zero_amount_csr: Sequence[str] = K.ZERO_AMOUNT_CSR_SOURCES):
    """Entity type of a plan, first match wins (C3)::

        source = corporate                   -> Corporate
        source = csr_like                    -> CSR
        source in zero_amount_csr, amount 0  -> CSR
        csr_id NULL or 'regular'             -> Regular
        else                                 -> CSR
    """
    s, a, c = F.col(source), F.col(amount), F.col(csr_id)
    rule = (F.when(s == corporate, F.lit("Corporate"))
             .when(s == csr_like, F.lit("CSR")))
    for z in zero_amount_csr:
        rule = rule.when((s == z) & (a == 0), F.lit("CSR"))
    return (rule.when(c.isNull() | (c == "regular"), F.lit("Regular"))
                .otherwise(F.lit("CSR")))


def cycle_status(start="start_date", prev_start="prev_start", prev_due="prev_due",
                 grace_days: int = K.GRACE_DAYS):
    """Four-way status (C3): NEW PLAN / RENEWAL / LATE RENEWAL / REVIVAL, first match wins."""
    s, pd_ = F.col(start), F.col(prev_due)
    return (F.when(F.col(prev_start).isNull(), F.lit("NEW PLAN"))
             .when(s <= pd_, F.lit("RENEWAL"))
             .when(s <= F.date_add(pd_, grace_days), F.lit("LATE RENEWAL"))
             .otherwise(F.lit("REVIVAL")))


def simple_type(start="start_date", prev_due="prev_due", grace_days: int = K.GRACE_DAYS):
    """Three-way type (C4): New Plan when the previous *due* is NULL (trap T8), Renewal
    within the grace period (late ones included), else Revival."""
    pd_ = F.col(prev_due)
    return (F.when(pd_.isNull(), F.lit("New Plan"))
             .when(F.col(start) <= F.date_add(pd_, grace_days), F.lit("Renewal"))
             .otherwise(F.lit("Revival")))


def latest_roles(assignments: DataFrame, visits: DataFrame, roles=K.STAFF_ROLES, names=None,
                 on: str = "plan_id", order: Sequence[str] = ("staff",)) -> DataFrame:
    """Latest staff per entity and role, one column per role (A5 over W1).

    Assignments (``on``, role, staff, created_at) reach the entity through the visits of the
    same plan, so a plan without a visit gives no names.  Per (entity, role) the most
    recent assignment wins (NULL time first, as PostgreSQL's DESC; then ``order``, descending).
    """
    names = names or [f"{r.lower()}_name" for r in roles]
    seen = visits.select(on, "entity_id").dropna().distinct()
    a = assignments.filter(F.col("role").isin(list(roles))).join(seen, on, "inner")
    last = latest_per_key(a, ["entity_id", "role"], [F.col("created_at").desc_nulls_first(),
                                                     *[F.col(c).desc_nulls_last() for c in order]])
    return pivot_roles(last, "entity_id", "role", "staff", list(roles), list(names))


def plan_cycle(plans: DataFrame, entities: DataFrame, visits: DataFrame, as_of: dt.date | str,
               grace_days: int = K.GRACE_DAYS, test_word: str = "test",
               history_months: int = K.HISTORY_MONTHS, type_rule=None,
               roles: DataFrame | None = None, entity_cols: Sequence[str] = (),
               diagnoses: DataFrame | None = None) -> DataFrame:
    """Four-way plan classification with acquisition path and entity type.

    * previous start NULL -> NEW PLAN; start <= previous due -> RENEWAL;
      start <= previous due + ``grace_days`` -> LATE RENEWAL; else REVIVAL
      (previous = the entity's preceding plan by start, then plan id);
    * ``direct_after_opd``: first plan and the entity never had a visit with
      a non-empty slot -> 'Direct Plan'; first plan with one -> 'After OPD';
    * entities whose name starts or ends with ``test`` (any case) are out;
    * one row per (contact, start day), the smallest plan id kept (the
      original ordered by the partition key itself, trap T3);
    * start day within the trailing window ending at ``as_of``;
    * ``roles`` (optional, one row per entity, e.g. ``pivot_roles`` of the
      latest assignment per role) is left-joined to add the role names;
    * ``diagnoses`` add the entity's ``primary_diagnosis``;
    * ``entity_cols`` are further attributes copied from the entity table.

    No source or exclusion-term filter here (the original has none).
    """
    # A plan starting after as_of can never be the predecessor (or a same-day
    # peer) of a plan inside the window, so it is dropped before the history
    # windows -- a placement Catalyst cannot derive by itself.
    hist = plan_history(plans.filter(F.col("start_date") <= as_date(as_of)),
                        "entity_id", "start_date", "due_date", "plan_id")
    # The window bound is on start_date, which is part of the dedup key below,
    # so it may go right after the history (never before it).
    hist = hist.filter(trailing_months("start_date", as_of, history_months))
    seen = visits.filter(non_empty("slot")).select("entity_id")
    extra = [c for c in entity_cols if c not in ("entity_id", "name", "contact", "csr_id")]
    ent = entities.select("entity_id", "name", "contact",
                          F.col("source").alias("entity_source"), "csr_id", *extra)
    # One frame with a row per entity -- attributes, visit flag, roles, diagnosis -- joined once.
    frame = with_flag(ent.filter(reject_affix("name", test_word)), seen, "entity_id", "has_visit")
    for more in (roles, primary_diagnosis(diagnoses) if diagnoses is not None else None):
        if more is not None:
            frame = frame.join(more, "entity_id", "left")
    p = salted_join(hist, frame, "entity_id", ["plan_id"], counted=plans)
    first = F.col("prev_start").isNull()
    p = p.withColumn("plan_status", cycle_status(grace_days=grace_days))
    p = p.withColumn("direct_after_opd",
                     F.when(first & ~F.col("has_visit"), F.lit("Direct Plan"))
                      .when(first & F.col("has_visit"), F.lit("After OPD")))
    rule = type_rule or entity_type
    p = p.withColumn("entity_type", rule("entity_source", "amount", "csr_id"))
    p = p.withColumn("months_with_us", F.col("running_count"))
    p = latest_per_key(p, ["contact", "start_date"], [F.col("plan_id").asc()])
    return p.drop("has_visit", "running_count", "seq", "prev_start", "prev_due")


def plan_cycle_simple(plans: DataFrame, entities: DataFrame, visits: DataFrame,
                      terms: DataFrame | None, as_of: dt.date | str,
                      grace_days: int = K.GRACE_DAYS,
                      excluded_sources: Sequence[str] = K.EXCLUDED_SOURCES,
                      visit_keys: Sequence[str] = ("visit_id",),
                      history_months: int = K.HISTORY_MONTHS,
                      entity_cols: Sequence[str] = ()) -> DataFrame:
    """Three-way plan type and the entity's total service months (C4).

    * previous due NULL -> New Plan (trap T8: not previous start);
      start <= previous due + ``grace_days`` -> Renewal (late ones included);
      else Revival;
    * ``plan_months``: whole months from start to due (trap T5);
      ``total_service_months``: their sum over all the entity's plans;
    * entity source not excluded; entities with exclusion terms on any visit
      are out (the whole entity); start from the window's first month on,
      with no upper bound;
    * ``entity_cols`` are further attributes copied from the entity table.
    """
    hist = plan_history(plans, "entity_id", "start_date", "due_date", "plan_id")
    p = (hist.withColumn("plan_type", simple_type(grace_days=grace_days))
             .withColumn("plan_months", whole_months("start_date", "due_date")))
    # Tenure comes from the plans themselves: it needs no history, so not its joins either.
    tenure = plans.groupBy("entity_id").agg(F.sum(whole_months("start_date", "due_date")).cast("bigint")
                                            .alias("total_service_months"))
    extra = [c for c in entity_cols if c not in ("entity_id", "name", "source", "branch")]
    ent = entities.select("entity_id", F.col("source").alias("entity_source"),
                          F.col("branch").alias("entity_branch"), "name", *extra)
    frame = ent.filter(not_in("entity_source", excluded_sources))
    if terms is not None:
        keys = list(visit_keys)
        marked = visits.join(terms.select(*keys).dropna(), keys, "left_semi").select("entity_id")
        frame = exclude(frame, marked, "entity_id")
    # One frame with a row per entity -- attributes, exclusions, tenure -- joined once.
    p = p.filter(since_months("start_date", as_of, history_months))
    return salted_join(p, frame.join(tenure, "entity_id", "left"), "entity_id", ["plan_id"], counted=plans) \
        .drop("seq", "running_count", "prev_start", "prev_due")
