"""Monthly active snapshots and lapsed entities."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse import constants as K
from planpulse.functions.dates import as_date
from planpulse.functions.predicates import not_in
from planpulse.functions.text import json_list_text
from planpulse.operators.history import plan_history
from planpulse.operators.joins import exclude, in_force, salted_join, with_flag
from planpulse.operators.keyed import latest_per_key


def _eligible_plans(plans: DataFrame, terms: DataFrame | None, excluded_sources: Sequence[str]) -> DataFrame:
    p = plans.filter(not_in("source", excluded_sources))
    return p if terms is None else exclude(p, terms.select("plan_ref").dropna(), "plan_ref")


def _entity_frame(entities: DataFrame, entity_cols: Sequence[str]) -> DataFrame:
    """What the INNER JOIN to the entity table (one row per entity) adds; without attributes it only tests existence."""
    return entities.select("entity_id", *entity_cols) if entity_cols else entities.select("entity_id").dropna().distinct()


def primary_diagnosis(diagnoses: DataFrame) -> DataFrame:
    """Latest diagnosis per entity (updated desc, NULLs last): primary, else the joined list."""
    latest = latest_per_key(diagnoses, ["entity_id"],
                            [F.col("updated_at").desc_nulls_last(),
                             F.col("primary_diagnosis").asc_nulls_last(),
                             F.col("diagnosis_list").asc_nulls_last()])
    return latest.select("entity_id", F.coalesce(F.col("primary_diagnosis"),
                                                 json_list_text("diagnosis_list")).alias("primary_diagnosis"))


def first_statuses(assignments: DataFrame) -> DataFrame:
    """The alphabetically first assignment status per plan (trap T1)."""
    return assignments.groupBy("plan_id").agg(F.min("status").alias("first_status"))


def active_snapshots(plans: DataFrame, assignments: DataFrame, entities: DataFrame,
                     terms: DataFrame | None, first_month: dt.date | str, as_of: dt.date | str,
                     excluded_sources: Sequence[str] = K.EXCLUDED_SOURCES,
                     expired_status: str = K.EXPIRED_STATUS,
                     diagnoses: DataFrame | None = None,
                     entity_cols: Sequence[str] = (),
                     extras: Sequence[str] = ("first_status", "months_with_us"),
                     entity_kind: str | None = None) -> DataFrame:
    """One row per (month, plan) in force at the month's reference date.

    * months from ``first_month`` to the month of ``as_of``; reference date =
      month end, or ``as_of`` in the current month;
    * in force: ``start < ref < due``;
    * in the current month only plans with a live assignment (some
      assignment whose status is not ``expired_status``; NULL does not count);
    * plans from excluded sources or with exclusion terms are left out;
    * ``first_status`` is the alphabetically first assignment status (trap T1);
    * ``months_with_us`` is the plan's sequence number within the entity;
    * ``entity_cols`` are copied from the entity table (name, age, ...);
    * ``extras`` picks the derived columns to compute: each costs a shuffle
      of its own input, so reports that only count rows pass ``()``.

    An entity with two plans in force appears twice.
    """
    # Only plans that are in force at some reference date go into the joins.
    near = plans.filter((F.col("start_date") < as_date(as_of)) & (F.col("due_date") > as_date(first_month)))
    p = salted_join(_eligible_plans(near, terms, excluded_sources), _entity_frame(entities, entity_cols),
                    "entity_id", ["plan_id"], counted=plans)
    p = with_flag(p, assignments.filter(F.col("status") != F.lit(expired_status)),
                  "plan_id", "has_live_assignment")
    snap = in_force(p, "start_date", "due_date", first_month, as_of, month_col="active_date")
    snap = snap.filter(~F.col("is_current_month") | F.col("has_live_assignment"))
    if "first_status" in extras:
        snap = snap.join(first_statuses(assignments), "plan_id", "left")
    if "months_with_us" in extras:
        # Plans starting after as_of are never in force and only follow the
        # others in the sequence, so they are left out of the history.
        early = plans.filter(F.col("start_date") <= as_date(as_of))
        seq = plan_history(early.select("plan_id", "entity_id", "start_date", "due_date"),
                           "entity_id", "start_date", "due_date", "plan_id", prefix="_h_") \
            .select("plan_id", F.col("_h_seq").alias("months_with_us"))
        snap = snap.join(seq, "plan_id", "left")
    if diagnoses is not None:
        snap = snap.join(primary_diagnosis(diagnoses), "entity_id", "left")
    if entity_kind is not None:
        snap = snap.withColumn("entity_kind", F.lit(entity_kind))
    return snap.drop("ref_date", "is_current_month", "has_live_assignment")


def lapsed_entities(plans: DataFrame, entities: DataFrame, terms: DataFrame | None,
                    as_of: dt.date | str,
                    excluded_sources: Sequence[str] = K.EXCLUDED_SOURCES,
                    entity_cols: Sequence[str] = (),
                    extras: Sequence[str] = ("months_with_us",),
                    assignments: DataFrame | None = None, diagnoses: DataFrame | None = None,
                    entity_kind: str | None = None) -> DataFrame:
    """Each entity's last plan, if it ended before ``as_of``.

    ``plans`` are all plans, those that start after ``as_of`` included: an entity
    with a pre-booked plan has not lapsed.

    Last = greatest due date with NULL first (PostgreSQL ``DESC``), then the
    greatest plan id (trap T3).  An entity whose latest row has a NULL due
    date therefore never lapses (trap T2).  Kept when ``due <= as_of - 1``;
    ``inactive_date = due + 1``; ``months_with_us`` (in ``extras``) is the
    running plan count up to the plan's start day (same-day plans share it).
    ``assignments`` add the plan's ``first_status`` (trap T1), ``diagnoses`` the
    entity's ``primary_diagnosis``, ``entity_kind`` a constant column.
    """
    # Whether the entity exists and what it is called is the same for all its plans: only the
    # last one is joined, and an entity that is listed twice still has one.
    order = [F.col("due_date").desc_nulls_first(), F.col("plan_id").desc()]
    last = latest_per_key(_eligible_plans(plans, terms, excluded_sources), ["entity_id"], order) \
        .filter(F.col("due_date") <= F.date_sub(as_date(as_of), 1))
    last = last.join(_entity_frame(entities, entity_cols), "entity_id")
    if entity_cols:
        last = latest_per_key(last, ["entity_id"], order)
    out = last.withColumn("inactive_date", F.date_add(F.col("due_date"), 1))
    if "months_with_us" in extras:
        hist = plan_history(plans.select("plan_id", "entity_id", "start_date", "due_date"),
                            "entity_id", "start_date", "due_date", "plan_id", prefix="_h_") \
            .select("plan_id", F.col("_h_running_count").alias("months_with_us"))
        out = out.join(hist, "plan_id", "left")
    if assignments is not None:
        out = out.join(first_statuses(assignments), "plan_id", "left")
    if diagnoses is not None:
        out = out.join(primary_diagnosis(diagnoses), "entity_id", "left")
    if entity_kind is not None:
        out = out.withColumn("entity_kind", F.lit(entity_kind))
    return out
