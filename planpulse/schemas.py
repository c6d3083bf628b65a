"""Declared schemas of the inputs (read with these, never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


PLANS = _s(("plan_id", StringType()), ("plan_ref", StringType()), ("entity_id", StringType()),
           ("start_date", DateType()), ("due_date", DateType()), ("amount", DecimalType(18, 2)),
           ("source", StringType()), ("branch", StringType()), ("owner_a", StringType()),
           ("owner_b", StringType()))
ENTITIES = _s(("entity_id", StringType()), ("name", StringType()), ("branch", StringType()),
              ("source", StringType()), ("contact", LongType()), ("csr_id", StringType()))
ASSIGNMENTS = _s(("plan_id", StringType()), ("status", StringType()), ("role", StringType()),
                 ("staff", StringType()), ("created_at", TimestampType()))
DIAGNOSES = _s(("entity_id", StringType()), ("diagnosis_list", StringType()),
               ("primary_diagnosis", StringType()), ("updated_at", TimestampType()))
TERMS = _s(("plan_ref", StringType()), ("visit_id", StringType()))
VISITS = _s(("visit_id", StringType()), ("plan_id", StringType()), ("entity_id", StringType()), ("visit_date", DateType()),
            ("slot", StringType()), ("status", IntegerType()), ("staff_raw", StringType()),
            ("amount", StringType()))
PRESCRIPTIONS = _s(("entity_id", StringType()), ("suggested", BooleanType()))
ROSTER = _s(("roster_id", StringType()), ("staff_id", StringType()), ("slot_date", DateType()),
            ("task", StringType()), ("booked", IntegerType()), ("is_active", IntegerType()))
ROSTER_MAP = _s(("roster_id", StringType()), ("entity_id", StringType()))

ALIAS_MAP = _s(("tech_name", StringType()), ("final_name", StringType()))
STAFF_MAP = _s(("user_id", StringType()), ("therapist_name", StringType()))
TARGETS = _s(("branch", StringType()), ("category", StringType()), ("target", StringType()))
TARGETS_OUT = _s(("scope", StringType()), ("category", StringType()), ("target", LongType()))
ASSESSMENTS_OUT = _s(("date", DateType()), ("center", StringType()), ("assess_no", StringType()),
                     ("cost", StringType()))

# One landed feed page: {"data": [...records...], "meta": {"hasNextPage": bool}}.
# Records stay VARIANT because their nested fields change shape.
FEED_PAGE = "struct<data: array<variant>, meta: struct<hasNextPage: boolean>>"

TABLES = {
    "plans": PLANS, "entities": ENTITIES, "assignments": ASSIGNMENTS, "diagnoses": DIAGNOSES,
    "terms": TERMS, "visits": VISITS, "prescriptions": PRESCRIPTIONS, "roster": ROSTER,
    "roster_map": ROSTER_MAP,
}
