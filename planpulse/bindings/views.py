"""Stand-in input frames over the driver's tables (Spark side).

Mapping (the DuckDB twin is ``planpulse.bindings.oracle``):

* entities      = customer + nation + region: entity_id=c_custkey, name=c_name,
                  contact=c_nationkey, branch=r_name, source=c_mktsegment,
                  csr_id from c_acctbal bands
* days          = order and ship dates run four times as fast from 1995-01-01 on, for half of
                  the customers 0, 8 or 12 months later, for the others 23 months later:
                  when these begin, the others renew, revive and lapse
* plans         = orders: plan_id=plan_ref=o_orderkey, entity_id=o_custkey,
                  start_date=day of o_orderdate, due_date=start + (1 + key % 12) months,
                  amount=o_totalprice, source=o_orderpriority, owners from the key
* assignments   = lineitem: plan_id=l_orderkey, status=l_linestatus ('F' = expired)
* terms         = lineitem rows with l_returnflag='R' and l_quantity > 45
* visits        = lineitem + orders: key (l_orderkey, l_linenumber, l_partkey,
                  l_suppkey), visit_date=day of l_shipdate, staff=l_suppkey,
                  status=l_linenumber, slot non-empty when l_quantity > 5
* prescriptions = lineitem + orders: suggested from l_returnflag (R true, A false)
* roster        = events: staff_id=user_id, task=event_type, slot day moved back
                  325 months (2024-01 -> 1996-12), booked when value >= 10,
                  inactive when event_id % 10 = 0
* roster_map    = events: entity from props.k
* staff names   = supplier: s_suppkey -> s_name
* diagnoses     = orders: one record per order (JSON list from the order priority,
                  a primary diagnosis on every third order, no update time on every fifth)
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- binding constants (shared with the oracle SQL) ----------------------
SNAP = dt.date(1998, 6, 16)          # as-of for snapshots / lapsed / plan cycle
SNAP_FIRST_MONTH = dt.date(1997, 7, 1)
SCORE = dt.date(1996, 12, 16)        # as-of for the daily scorecards: the second cohort begins, the first lapses
CONV = dt.date(1997, 1, 1)           # as-of for conversions: the second cohort's first month
SESSIONS_FROM = dt.date(1996, 12, 1)
BEST_FROM = dt.date(1996, 1, 1)
DAY_ZERO, PACE = dt.date(1995, 1, 1), 4
EXCLUDED_PLAN_SOURCES = ("5-LOW",)
EXCLUDED_ENTITY_SOURCES = ("MACHINERY",)
EXPIRED = "F"
VISIT_STATUSES = (1, 2, 3, 5, 6)
SESSION_TASK = "click"
CORPORATE_SEGMENTS = ("AUTOMOBILE", "HOUSEHOLD")
SESSION_SHIFT_MONTHS = -325
VISIT_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
# ------------------------------------------------------------------------


_TABLES: dict[tuple[int, str, str], tuple[SparkSession, DataFrame]] = {}


def _shared(fn):
    """Build a view once per (session, folder): every query that reads it shares
    one logical subtree, which keeps plans small and lets Spark reuse exchanges."""
    memo: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, d: str) -> DataFrame:
        key = (id(spark), d)
        hit = memo.get(key)
        if hit is None or hit[0] is not spark:
            hit = memo[key] = (spark, fn(spark, d))
        return hit[1]
    return wrapper


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One DataFrame per (session, folder, table): repeated uses share one relation,
    so the file listing happens once and Spark can reuse identical exchanges."""
    key = (id(spark), d, name)
    hit = _TABLES.get(key)
    if hit is None or hit[0] is not spark:
        hit = _TABLES[key] = (spark, spark.read.parquet(f"{d}/{name}.parquet"))
    return hit[1]


@_shared
def branches(spark: SparkSession, d: str) -> DataFrame:
    """nation -> region name.  Both tables are fixed-size dimensions (25 and 5 rows
    by the schema's definition), so the broadcast is bounded."""
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey) \
            .select(F.col("n_nationkey").alias("_nation"), F.col("r_name").alias("branch"))


def timeline(date: str, entity: str):
    """The stand-in day of a test table's date, by the cohort of its entity."""
    zero = F.lit(DAY_ZERO)
    day = F.date_add(zero, F.floor(F.datediff(F.col(date).cast("date"), zero) / PACE).cast("int"))
    cohort = F.col(entity) % 8
    return F.add_months(day, F.when(cohort < 2, F.lit(0)).when(cohort == 2, F.lit(8)).when(cohort == 3, F.lit(12)).otherwise(F.lit(23)))


@_shared
def entities(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    e = c.select(
        F.col("c_custkey").alias("entity_id"),
        F.when(F.col("c_custkey") % 41 == 0, F.concat(F.lit("TEST "), "c_name"))
         .when(F.col("c_custkey") % 43 == 0, F.concat("c_name", F.lit(" test"))).otherwise(F.col("c_name")).alias("name"),
        F.col("c_nationkey").alias("contact"), F.col("c_mktsegment").alias("source"),
        F.when(F.col("c_acctbal") < 0, F.lit("corp"))
         .when(F.col("c_acctbal") < 5000, F.lit("regular")).alias("csr_id"))
    e = e.join(F.broadcast(branches(spark, d)), F.col("contact") == F.col("_nation"), "left").drop("_nation")
    return e.withColumn("branch", F.when(F.col("entity_id") % 37 != 0, F.col("branch")))   # some have none


@_shared
def plans(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    start = timeline("o_orderdate", "o_custkey")
    term = (F.lit(1) + F.col("o_orderkey") % 12).cast("int")
    return o.select(
        F.col("o_orderkey").alias("plan_id"), F.col("o_orderkey").alias("plan_ref"),
        F.col("o_custkey").alias("entity_id"), start.alias("start_date"),
        F.when(F.col("o_orderkey") % 97 != 0, F.add_months(start, term)).alias("due_date"),
        F.when(F.col("o_orderkey") % 53 == 0, F.lit(0)).otherwise(F.col("o_totalprice")).cast("decimal(18,2)").alias("amount"),
        F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("status"),
        (F.col("o_orderkey") % 25).alias("owner_a"), (F.col("o_orderkey") % 7).alias("owner_b"))


@_shared
def plans_with_branch(spark: SparkSession, d: str) -> DataFrame:
    """Plans with the entity's branch (the plan's own branch in the original)."""
    e = entities(spark, d).select(F.col("entity_id").alias("_eid"), "branch")
    p = plans(spark, d)
    return p.join(e, p.entity_id == e._eid, "left").drop("_eid")


@_shared
def assignments(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("plan_id"), F.col("l_linestatus").alias("status"))


@_shared
def terms(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)) \
             .select(F.col("l_orderkey").alias("plan_ref"), *VISIT_KEYS)


@_shared
def _lineitem_entity(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select(F.col("o_orderkey"), F.col("o_custkey").alias("entity_id"))
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")


@_shared
def visits(spark: SparkSession, d: str) -> DataFrame:
    v = _lineitem_entity(spark, d)
    return v.select(
        *VISIT_KEYS, "entity_id",
        timeline("l_shipdate", "entity_id").alias("visit_date"),
        F.when(F.col("l_quantity") > 5, F.lit("S")).otherwise(F.lit("")).alias("slot"),
        F.col("l_linenumber").alias("status"),
        F.col("l_suppkey").alias("staff_id"),
        F.when(F.col("l_orderkey") % 31 == 0, F.lit(0)).otherwise(F.col("l_extendedprice"))
         .cast("decimal(18,2)").alias("amount"))


@_shared
def prescriptions(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_returnflag") == "R", F.lit(True))
                                            .when(F.col("l_returnflag") == "A", F.lit(False)).alias("suggested"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("entity_id"))
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select("entity_id", "suggested")


@_shared
def roster(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select(
        F.col("event_id").alias("roster_id"), F.col("user_id").alias("staff_id"),
        F.add_months(F.col("ts").cast("date"), SESSION_SHIFT_MONTHS).alias("slot_date"),
        F.col("event_type").alias("task"),
        F.when(F.col("value") >= 10, F.lit(1)).otherwise(F.lit(0)).alias("booked"),
        F.when(F.col("event_id") % 10 == 0, F.lit(0)).otherwise(F.lit(1)).alias("is_active"))


@_shared
def roster_map(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select(F.col("event_id").alias("roster_id"),
                     F.get_json_object("props", "$.k").cast("bigint").alias("entity_id"))


@_shared
def diagnoses(spark: SparkSession, d: str) -> DataFrame:
    """One diagnosis record per order: a JSON list from the order priority's parts,
    a primary diagnosis on every third order, no update time on every fifth."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("entity_id"),
        F.concat(F.lit('[" '), F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit('", "')),
                 F.lit(' "]')).alias("diagnosis_list"),
        F.when(k % 3 == 0, F.col("o_orderstatus")).alias("primary_diagnosis"),
        F.when(k % 5 != 0, F.col("o_orderdate").cast("timestamp")).alias("updated_at"))


@_shared
def staff_names(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("staff_id"), F.col("s_name").alias("staff_name"))


# --- report-level stand-ins ----------------------------------------------
BRANCH_RECODE = {"MIDDLE EAST": "MIDEAST"}
TARGET_ROWS = (
    ("Overall", "New OPDs", 40), ("Overall", "New Plan", 6), ("Overall", "Revivals", 0),
    ("Overall", "Revenue", 2000000), ("AMERICA", "New OPDs", 8), ("ASIA", "F/U OPDs", 30),
    ("EUROPE", "Inactive", 5), ("AFRICA", "Revenue", 0),
)


def messy_staff(col: str = "s_name"):
    """Supplier names as hand-typed staff names: padded, with a doubled space."""
    return F.concat(F.lit("  "), F.regexp_replace(F.col(col), "#", "  #"), F.lit(" "))


@_shared
def staff_raw(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("staff_id"), messy_staff().alias("staff_raw"))


@_shared
def alias_map(spark: SparkSession, d: str) -> DataFrame:
    """Alias table derived from supplier: staff of nations 1-2 merge into a team
    name; nation 0 maps to '' (dropped)."""
    s = table(spark, d, "supplier").filter(F.col("s_nationkey") < 3)
    return s.select(F.regexp_replace("s_name", "#", " #").alias("tech_name"),
                    F.when(F.col("s_nationkey") == 0, F.lit(""))
                     .otherwise(F.concat(F.lit("Team "), F.col("s_nationkey").cast("string")))
                     .alias("final_name")).distinct()


@_shared
def assessments(spark: SparkSession, d: str) -> DataFrame:
    """Assessments from purchase events, moved to three months: region by user, count and cost from the event."""
    ev = table(spark, d, "events").filter(F.col("event_type") == "purchase")
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    j = ev.join(F.broadcast(r), (ev.user_id % 5) == r.r_regionkey, "left")
    month = (F.lit(SESSION_SHIFT_MONTHS) - F.col("event_id") % 3).cast("int")
    return j.select(F.add_months(F.col("ts").cast("date"), month).alias("date"),
                    F.col("r_name").alias("center"),
                    (F.lit(1) + F.col("event_id") % 3).cast("double").alias("assess_no"),
                    F.col("value").cast("decimal(18,2)").alias("cost"))


def targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TARGET_ROWS), "scope string, category string, target bigint")
