"""Registered queries: each binds one operator to the stand-in views.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names match the DuckDB oracle in ``planpulse.bindings.oracle``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from planpulse.bindings import views as V
from planpulse.functions.dates import as_date
from planpulse.operators.history import plan_history
from planpulse.operators.joins import exclude, with_flag
from planpulse.operators.keyed import best_flag, latest_per_key
from planpulse.plans.cycle import entity_type, latest_roles, plan_cycle, plan_cycle_simple
from planpulse.plans.snapshots import active_snapshots, lapsed_entities
from planpulse.plans.visits import conversions, sessions_by_staff, visits_classified


def _money(c: str = "amount"):
    return F.col(c).cast("double").alias(c)


def _type_rule(source, amount, csr_id):
    return entity_type(source, amount, csr_id, corporate=V.CORPORATE_SEGMENTS[0],
                       csr_like="BUILDING", zero_amount_csr=("FURNITURE", "HOUSEHOLD"))


# ---------------------------------------------------------------- C1, C2
def q_active_snapshots(spark: SparkSession, d: str) -> DataFrame:
    snap = active_snapshots(V.plans(spark, d), V.assignments(spark, d), V.entities(spark, d),
                            V.terms(spark, d), V.SNAP_FIRST_MONTH, V.SNAP,
                            excluded_sources=V.EXCLUDED_PLAN_SOURCES, expired_status=V.EXPIRED,
                            entity_cols=["name"], diagnoses=V.diagnoses(spark, d), entity_kind="Regular")
    return snap.select("active_date", "plan_id", "entity_id", "name", "start_date", "due_date",
                       _money(), "first_status", "months_with_us", "primary_diagnosis", "entity_kind")


def q_lapsed_entities(spark: SparkSession, d: str) -> DataFrame:
    lapsed = lapsed_entities(V.plans(spark, d), V.entities(spark, d), V.terms(spark, d), V.SNAP,
                             excluded_sources=V.EXCLUDED_PLAN_SOURCES, entity_cols=["name"],
                             assignments=V.assignments(spark, d), diagnoses=V.diagnoses(spark, d),
                             entity_kind="Regular")
    return lapsed.select("entity_id", "name", "plan_id", "start_date", "due_date", "inactive_date",
                         _money(), "months_with_us", "first_status", "primary_diagnosis", "entity_kind")


# ---------------------------------------------------------------- joins
def q_live_flag(spark: SparkSession, d: str) -> DataFrame:
    a = V.assignments(spark, d).filter(F.col("status") != V.EXPIRED)
    p = V.plans(spark, d).select("plan_id")
    return with_flag(p, a, "plan_id", "has_live")


def q_exclude_terms(spark: SparkSession, d: str) -> DataFrame:
    p = V.plans(spark, d).select("plan_id", "plan_ref", "entity_id", "start_date", "amount")
    return exclude(p, V.terms(spark, d), "plan_ref") \
        .select("plan_id", "entity_id", "start_date", _money())


def q_exclude_entity(spark: SparkSession, d: str) -> DataFrame:
    marked = V.visits(spark, d).join(V.terms(spark, d).select(*V.VISIT_KEYS),
                                     list(V.VISIT_KEYS), "left_semi").select("entity_id")
    e = V.entities(spark, d).select("entity_id", "name")
    return exclude(e, marked, "entity_id")


# ---------------------------------------------------------------- windows
def q_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    p = V.plans(spark, d).select("entity_id", "plan_id", "start_date", "due_date")
    return latest_per_key(p, ["entity_id"], [F.col("due_date").desc_nulls_first(),
                                             F.col("plan_id").desc()])


def q_plan_sequence(spark: SparkSession, d: str) -> DataFrame:
    p = V.plans(spark, d).select("plan_id", "entity_id", "start_date", "due_date")
    h = plan_history(p, "entity_id", "start_date", "due_date", "plan_id")
    return h.select("plan_id", "entity_id", "start_date", "seq", "running_count")


def q_contact_day_dedup(spark: SparkSession, d: str) -> DataFrame:
    p = V.plans(spark, d).select("plan_id", "entity_id", "start_date")
    e = V.entities(spark, d).select("entity_id", "contact")
    return latest_per_key(p.join(e, "entity_id", "inner"), ["contact", "start_date"],
                          [F.col("plan_id").asc()]) \
        .select("contact", "start_date", "plan_id", "entity_id")


def q_role_pivot(spark: SparkSession, d: str) -> DataFrame:
    return _roles(spark, d)


def _roles(spark: SparkSession, d: str) -> DataFrame:
    """Latest staff per (entity, role), one column per role (order priority plays the role,
    an order's lines are its assignments and, by order, its visits)."""
    li = V.table(spark, d, "lineitem")
    o = V.table(spark, d, "orders").select(F.col("o_orderkey").alias("plan_id"), F.col("o_custkey").alias("entity_id"),
                                           F.col("o_orderpriority").alias("role"))
    given = (li.join(o.select("plan_id", "role"), F.col("l_orderkey") == F.col("plan_id"))
               .join(V.staff_names(spark, d), F.col("l_suppkey") == F.col("staff_id"), "left")
               .select("plan_id", "role", F.col("staff_name").alias("staff"), F.col("l_shipdate").alias("created_at"),
                       *V.VISIT_KEYS))
    return latest_roles(given, o, roles=["1-URGENT", "2-HIGH", "3-MEDIUM"],
                        names=["urgent_name", "high_name", "medium_name"], order=V.VISIT_KEYS)


# ---------------------------------------------------------------- C3, C4
def q_plan_cycle(spark: SparkSession, d: str) -> DataFrame:
    c = plan_cycle(V.plans(spark, d), V.entities(spark, d), V.visits(spark, d), V.SNAP,
                   type_rule=_type_rule, roles=_roles(spark, d), diagnoses=V.diagnoses(spark, d))
    return c.select("plan_id", "entity_id", "contact", "name", "start_date", "due_date", "plan_status",
                    "direct_after_opd", "entity_type", "months_with_us", _money(),
                    "urgent_name", "high_name", "medium_name", "primary_diagnosis")


def q_plan_cycle_simple(spark: SparkSession, d: str) -> DataFrame:
    c = plan_cycle_simple(V.plans(spark, d), V.entities(spark, d), V.visits(spark, d), V.terms(spark, d),
                          V.SNAP, excluded_sources=V.EXCLUDED_ENTITY_SOURCES,
                          visit_keys=V.VISIT_KEYS)
    return c.select("plan_id", "entity_id", "start_date", "due_date", "plan_type",
                    "plan_months", "total_service_months", _money())


# ---------------------------------------------------------------- C5, W7, C6, C7
def _visits_c5(spark: SparkSession, d: str, as_of: dt.date) -> DataFrame:
    return visits_classified(V.visits(spark, d), V.entities(spark, d), V.prescriptions(spark, d),
                             V.terms(spark, d), as_of, statuses=V.VISIT_STATUSES,
                             excluded_sources=V.EXCLUDED_ENTITY_SOURCES, visit_keys=V.VISIT_KEYS, entity_kind="Regular")


def q_visits_first_repeat(spark: SparkSession, d: str) -> DataFrame:
    v = _visits_c5(spark, d, V.SCORE)
    return v.select(*V.VISIT_KEYS, "entity_id", "visit_date", "opd_month", "opd_status",
                    "is_suggest", "entity_kind", _money())


def q_suggest_flag(spark: SparkSession, d: str) -> DataFrame:
    f = best_flag(V.prescriptions(spark, d), ["entity_id"], "suggested", "_best")
    return f.select("entity_id", F.when(F.col("_best"), F.lit("Yes"))
                                  .when(~F.col("_best"), F.lit("No")).alias("entity_suggested"))


def q_sessions_by_staff(spark: SparkSession, d: str) -> DataFrame:
    s = sessions_by_staff(V.roster(spark, d), V.roster_map(spark, d), V.entities(spark, d),
                          V.SESSIONS_FROM, V.SCORE, V.SESSION_TASK,
                          corporate_sources=V.CORPORATE_SEGMENTS)
    return s.select("slot_date", "task", "is_active", "booked", "staff_id", "entity_id",
                    "branch", "name", "contact", "source", "entity_type", "total_sessions")


def q_conversions(spark: SparkSession, d: str) -> DataFrame:
    yesterday = V.CONV - dt.timedelta(days=1)
    d1 = yesterday.replace(day=1)
    v = _visits_c5(spark, d, V.CONV)
    v = v.join(V.staff_names(spark, d), "staff_id", "left").withColumnRenamed("staff_name", "staff")
    p = plan_cycle(V.plans(spark, d), V.entities(spark, d), V.visits(spark, d), V.CONV,
                   type_rule=_type_rule)
    return conversions(v, p, d1, yesterday, staff="staff")


# ---------------------------------------------------------------- report inputs
def _branch(col: str):
    from planpulse.functions.text import recode
    return recode(F.col(col), V.BRANCH_RECODE, null_label="Unknown").alias("branch")


def _with_owner_names(df: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    s = V.staff_raw(spark, d)
    a = s.select(F.col("staff_id").alias("_a"), F.col("staff_raw").alias("owner_a_name"))
    b = s.select(F.col("staff_id").alias("_b"), F.col("staff_raw").alias("owner_b_name"))
    return (df.join(a, df.owner_a == a._a, "left").join(b, df.owner_b == b._b, "left")
              .drop("_a", "_b"))


class _ReportInputs:
    """The C1-C6 frames a report at ``as_of`` reads, bound to the stand-in views.

    Each frame is built on first use and then shared, so a query builds only
    the inputs it reads and two reports in one session share one subtree.
    """

    def __init__(self, spark: SparkSession, d: str, as_of: dt.date):
        self.spark, self.d, self.as_of = spark, d, as_of
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = getattr(self, "_" + name)()
        return self._built[name]

    def _visits(self) -> DataFrame:
        spark, d = self.spark, self.d
        v = _visits_c5(spark, d, self.as_of).join(V.staff_raw(spark, d), "staff_id", "left")
        return v.withColumn("branch", _branch("entity_branch"))

    def _plans4(self) -> DataFrame:
        spark, d = self.spark, self.d
        p = plan_cycle_simple(V.plans(spark, d), V.entities(spark, d),
                              V.visits(spark, d), V.terms(spark, d), self.as_of,
                              excluded_sources=V.EXCLUDED_ENTITY_SOURCES, visit_keys=V.VISIT_KEYS)
        return p.withColumn("branch", _branch("entity_branch"))

    def _plans3(self) -> DataFrame:
        spark, d = self.spark, self.d
        return plan_cycle(V.plans(spark, d), V.entities(spark, d), V.visits(spark, d), self.as_of,
                          type_rule=_type_rule)

    def _active(self) -> DataFrame:
        spark, d = self.spark, self.d
        a = active_snapshots(V.plans(spark, d), V.assignments(spark, d),
                             V.entities(spark, d), V.terms(spark, d), V.BEST_FROM, self.as_of,
                             excluded_sources=V.EXCLUDED_PLAN_SOURCES, expired_status=V.EXPIRED,
                             entity_cols=["branch"], extras=())
        return _with_owner_names(a.withColumn("branch", _branch("branch")), spark, d)

    def _lapsed(self) -> DataFrame:
        spark, d = self.spark, self.d
        lapsed = lapsed_entities(V.plans(spark, d), V.entities(spark, d), V.terms(spark, d), self.as_of,
                                 excluded_sources=V.EXCLUDED_PLAN_SOURCES, entity_cols=["branch"], extras=())
        return _with_owner_names(lapsed.withColumn("branch", _branch("branch")), spark, d)

    def _sessions(self) -> DataFrame:
        spark, d = self.spark, self.d
        return sessions_by_staff(V.roster(spark, d), V.roster_map(spark, d), V.entities(spark, d),
                                 V.SESSIONS_FROM, self.as_of, V.SESSION_TASK,
                                 corporate_sources=V.CORPORATE_SEGMENTS)

    def _assessments(self) -> DataFrame:
        return V.assessments(self.spark, self.d)


_INPUTS: dict[tuple[int, str, dt.date], _ReportInputs] = {}


def report_inputs(spark: SparkSession, d: str, as_of: dt.date) -> _ReportInputs:
    key = (id(spark), d, as_of)
    hit = _INPUTS.get(key)
    if hit is None or hit.spark is not spark:
        hit = _INPUTS[key] = _ReportInputs(spark, d, as_of)
    return hit


_KEPT: dict[tuple, tuple[SparkSession, DataFrame]] = {}


def _kept(name: str, spark: SparkSession, d: str, as_of: dt.date, make) -> DataFrame:
    """A small result that several reports read: checkpointed once per session, folder and as-of day."""
    from planpulse import session
    key = (name, id(spark), d, as_of)
    hit = _KEPT.get(key)
    if hit is None or hit[0] is not spark:
        hit = _KEPT[key] = (spark, session.materialize(make()))
    return hit[1]


def _facts(spark: SparkSession, d: str, as_of: dt.date) -> DataFrame:
    """Daily metric facts of the report inputs (a row per branch, metric and day)."""
    from planpulse.plans.scorecards import daily_facts, metric_facts
    r = report_inputs(spark, d, as_of)
    return _kept("facts", spark, d, as_of, lambda: daily_facts(metric_facts(
        r["visits"], r["plans4"], r["active"], r["lapsed"], r["assessments"])))


def _period_metrics(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.scorecards import period_metrics_from_facts
    return _kept("metrics", spark, d, V.SCORE, lambda: period_metrics_from_facts(_facts(spark, d, V.SCORE), V.SCORE))


def _best(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.benchmarks import best_period
    return _kept("best", spark, d, V.SCORE, lambda: best_period(_facts(spark, d, V.SCORE), V.SCORE, V.BEST_FROM))


# ---------------------------------------------------------------- C8, U1, W9
def _staff_scorecard(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.scorecards import staff_scorecard
    r = report_inputs(spark, d, V.SCORE)
    y = V.SCORE - dt.timedelta(days=1)
    return _kept("staff", spark, d, V.SCORE, lambda: staff_scorecard(
        r["visits"], r["sessions"], r["plans3"], r["active"], r["lapsed"], V.staff_raw(spark, d), V.alias_map(spark, d),
        y.replace(day=1), y, role_cols=("owner_a_name", "owner_b_name")))


def q_staff_scorecard(spark: SparkSession, d: str) -> DataFrame:
    return _staff_scorecard(spark, d)


def q_owner_counts(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.operators.grouping import group_count
    from planpulse.operators.reshape import unpivot_roles
    p = V.plans(spark, d).select("owner_a", "owner_b")
    return group_count(unpivot_roles(p, ["owner_a", "owner_b"], "owner"), ["owner"], "n")


def q_extreme_flags(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.operators.grouping import extreme_flags
    from planpulse.plans.scorecards import SCORECARD_METRICS
    return extreme_flags(_staff_scorecard(spark, d), list(SCORECARD_METRICS), reverse=["inactive"])


# ---------------------------------------------------------------- C9-C16
def q_period_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _period_metrics(spark, d).select("scope", "period", "metric", "value", "amount")


def q_period_metrics_refreshed(spark: SparkSession, d: str) -> DataFrame:
    """C9 from daily facts that are kept: built as of a month before, then brought up to date.

    The second load brings a month's rows and corrections of earlier days (lapses that a
    revival took back); the report opens the days of its periods only.
    """
    from planpulse import session
    from planpulse.plans.fact_store import FactStore, fact_rows
    from planpulse.plans.scorecards import metric_facts, period_metrics_from_facts, report_periods

    def rows(as_of: dt.date) -> DataFrame:
        r = report_inputs(spark, d, as_of)
        return fact_rows(metric_facts(r["visits"], r["plans4"], r["active"], r["lapsed"], r["assessments"])) \
            .withColumn("as_of", as_date(as_of))

    # One job for both days: what does not depend on the day is shuffled once and reused.
    before = V.SCORE - dt.timedelta(days=30)
    both = session.materialize(rows(before).unionByName(rows(V.SCORE)))
    old, new = [both.filter(F.col("as_of") == as_date(day)).drop("as_of") for day in (before, V.SCORE)]

    store = FactStore(spark, f"{session.ensure_checkpoint_dir(spark).rstrip('/')}/planpulse-facts-{uuid.uuid4().hex}")
    store.sync(old, "first")
    store.apply(old, new, "second")
    first = min(day for day, _, _ in report_periods(V.SCORE).values())
    return period_metrics_from_facts(store.read(first, V.SCORE), V.SCORE).select("scope", "period", "metric", "value", "amount")


def q_scorecard_change(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.scorecards import scorecard
    return scorecard(_period_metrics(spark, d), V.targets(spark))


def q_working_days(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.calendar import working_calendar
    return working_calendar(V.plans(spark, d), "start_date", nth=(0, 10, 30))


def q_best_period(spark: SparkSession, d: str) -> DataFrame:
    return _best(spark, d).select("scope", "metric", "span", "best_value", "best_month", "best_label")


def q_target_vs_achieved(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.benchmarks import target_vs_achieved
    return target_vs_achieved(_period_metrics(spark, d), _best(spark, d),
                              V.targets(spark), V.SCORE)


def _branches(spark: SparkSession, d: str) -> DataFrame:
    """The report's branch labels: region names after recode."""
    from planpulse.functions.text import recode
    r = V.table(spark, d, "region").select(
        recode(F.col("r_name"), V.BRANCH_RECODE, null_label="Unknown").alias("scope")).distinct()
    return r.filter("scope NOT IN ('', 'Unknown')")


def q_duration_mix(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.mixes import duration_mix
    r = report_inputs(spark, d, V.SCORE)
    return duration_mix(r["plans4"], V.SCORE, _branches(spark, d))


def q_duration_table(spark: SparkSession, d: str) -> DataFrame:
    """The wide table of month to date, a column per branch and Total."""
    from planpulse.plans.mixes import duration_table
    return duration_table(q_duration_mix(spark, d), _branches(spark, d), "mtd")


def q_source_mix(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.mixes import source_mix
    r = report_inputs(spark, d, V.SCORE)
    y = V.SCORE - dt.timedelta(days=1)
    return source_mix(r["visits"], r["plans4"], y.replace(day=1), y)


def q_branch_metric_table(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.mixes import branch_metric_table
    return branch_metric_table(_period_metrics(spark, d), _best(spark, d))


# ---------------------------------------------------------------- expressions
def q_json_list_join(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.functions.text import json_list_text
    p = V.table(spark, d, "part")
    words = F.replace(F.col("p_name"), F.lit(" "), F.lit('\\n", "\\t'))
    arr = (F.when(F.col("p_size") % 10 == 0, F.lit("[]"))
            .when(F.col("p_size") % 10 == 1, F.lit("[null]"))
            .when(F.col("p_size") % 10 == 2, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit('[" '), words, F.lit('\\r"]'))))
    primary = F.when(F.col("p_size") % 7 == 0, F.col("p_brand"))
    return p.select("p_partkey", F.coalesce(primary, json_list_text(arr)).alias("primary_diagnosis"))


def q_name_canonical(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.operators.names import canonical_names
    s = V.table(spark, d, "supplier")
    raw = (F.when(F.col("s_suppkey") % 11 == 0, F.lit("  nan "))
            .when(F.col("s_suppkey") % 13 == 0, F.lit(" \t "))
            .otherwise(V.messy_staff()))
    df = s.select(F.col("s_suppkey").alias("staff_id"), raw.alias("staff_raw"))
    return canonical_names(df, "staff_raw", V.alias_map(spark, d), "staff") \
        .select("staff_id", "staff")


def q_source_normalise(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.functions.text import source_rule
    docs = V.table(spark, d, "documents")
    return docs.select("doc_id", "source",
                       source_rule(F.col("source"), brand="src1", variant="5", brand_label="S1",
                                   variant_label="S1-5").alias("norm_source"))


def q_reject_test_names(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.functions.predicates import reject_affix
    return V.table(spark, d, "part").filter(reject_affix("p_name", "red")).select("p_partkey", "p_name")


def q_trailing_year(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.functions.dates import month_label, trailing_months
    v = V.visits(spark, d).filter(trailing_months("visit_date", V.SNAP))
    return v.groupBy(F.trunc("visit_date", "month").alias("month_start"),
                     month_label("visit_date").alias("opd_month")) \
        .agg(F.count(F.lit(1)).alias("visits"))


def feed_pages(spark: SparkSession, d: str, cut: bool = False) -> DataFrame:
    """Feed pages derived from orders: one page per order, shapes varied by key; with ``cut`` some break off."""
    o = V.table(spark, d, "orders")
    k = F.col("o_orderkey")
    ts = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    offset = (F.when(k % 4 == 0, F.lit("Z")).when(k % 4 == 1, F.lit("+05:30"))
               .when(k % 4 == 2, F.lit("-08:00")).otherwise(F.lit(".123Z")))
    created = F.when(k % 17 == 0, F.lit("not-a-date")).otherwise(F.concat(ts, offset))
    pkg = (F.when(k % 3 == 0, F.concat(F.lit('{"name": "'), F.col("o_orderstatus"), F.lit('-plan", "price": 10}')))
            .when(k % 3 == 1, F.concat(F.lit('[{"title": "T'), (k % 5).cast("string"), F.lit('"}, "extra", ""]')))
            .otherwise(F.concat(F.lit('"flat-'), F.col("o_orderstatus"), F.lit('"'))))
    asg = F.when(k % 2 == 0, F.concat(F.lit('[{"label": "L'), (F.col("o_custkey") % 9).cast("string"),
                                      F.lit('"}, {"other": 5}]'))).otherwise(F.lit("null"))
    rec = F.concat(F.lit('{"leadSource": "'), F.col("o_orderpriority"), F.lit('", "createdAt": "'), created,
                   F.lit('", "package": '), pkg, F.lit(', "assignments": '), asg,
                   F.lit(', "monthsWithUs": "'), (F.lit(1) + k % 12).cast("string"), F.lit('"}'))
    junk = F.when(k % 19 == 0, F.lit(', "junk"')).otherwise(F.lit(""))
    doc = F.concat(F.lit('{"data": ['), rec, junk, F.lit('], "meta": {"hasNextPage": false}}'))
    return o.select((F.when(k % 10 == 3, F.substring(doc, 1, 40)).otherwise(doc) if cut else doc).alias("doc"))


def q_feed_records(spark: SparkSession, d: str) -> DataFrame:
    from planpulse.plans.feed import feed_records
    return feed_records(feed_pages(spark, d), V.SNAP)


def q_feed_broken_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of every tenth order are cut short; they are reported, not lost."""
    from planpulse.sources.feed import broken_pages
    o = V.table(spark, d, "orders").select((F.col("o_orderkey") % 10).alias("k"), F.col("o_orderkey").cast("string").alias("id"))
    doc = F.concat(F.lit('{"data": [{"id": "'), F.col("id"), F.lit('"}], "meta": {"hasNextPage": false}}'))
    doc = F.when(F.col("k") == 0, F.substring(doc, 1, 12)).when(F.col("k") == 1, F.lit('{"meta": {}}')).otherwise(doc)
    return broken_pages(o.select(doc.alias("doc"))).groupBy("doc").agg(F.count(F.lit(1)).alias("pages"))


def q_feed_rejects(spark: SparkSession, d: str) -> DataFrame:
    """What the feed holds but the report cannot use, counted by reason beside the rows kept."""
    from planpulse.plans.feed import feed_sorted
    read = feed_sorted(feed_pages(spark, d, cut=True), V.SNAP)
    return read.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def q_nested_text(spark: SparkSession, d: str) -> DataFrame:
    """values in up to two nested lists, every 97th in fifty, with an element at every level."""
    from planpulse.functions.nested import variant_text
    o = V.table(spark, d, "orders")
    n = F.when(F.col("o_orderkey") % 97 == 0, F.lit(50)).otherwise((F.col("o_orderkey") % 3).cast("int"))
    doc = F.concat(F.repeat(F.lit('["a", '), n), F.lit('{"label": "k]'), F.col("o_orderkey"), F.lit('", "in": [["x"]]}'),
                   F.repeat(F.lit(', "", {"price": [], "code": "z"}]'), n))
    return o.select("o_orderkey", variant_text(F.parse_json(doc)).alias("text"))


def q_feed_chain(spark: SparkSession, d: str) -> DataFrame:
    """A thousand orders to a page, a chain per order status, pages landed as files.

    Every sixth page number is left out; status O says at page 11 that it ends, P at page 4, F never.
    """
    from planpulse.sources import chain_problems, load_feed
    o = V.table(spark, d, "orders")
    k = F.floor(F.col("o_orderkey") / 1000).cast("bigint")
    rows = o.select(F.col("o_orderstatus").alias("chain"), (k + 1 + F.floor(k / 5)).alias("page"),
                    F.concat(F.lit('{"leadSource": "'), F.col("o_orderpriority"), F.lit('"}')).alias("record"))
    ends = ((F.col("chain") == "O") & (F.col("page") == 11)) | ((F.col("chain") == "P") & (F.col("page") == 4))
    pages = rows.groupBy("chain", "page").agg(F.array_join(F.array_sort(F.collect_list("record")), ", ").alias("records"))
    doc = F.concat(F.lit('{"data": ['), F.col("records"), F.lit('], "meta": {"hasNextPage": '), (~ends).cast("string"), F.lit("}}"))
    path = _written(pages.select("chain", "page", doc.alias("value")), "feed", "text", ["chain", "page"])
    found = chain_problems(load_feed(spark, path, r"page=(\d+)/[^/]*$"))
    return found.withColumn("chain", F.regexp_extract("chain", r"chain=(\w+)/$", 1))


# ---------------------------------------------------------------- loaders over written files
def _written(df: DataFrame, name: str, fmt: str = "csv", partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as the hand-kept file a loader reads; returns its folder."""
    import uuid

    from planpulse.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/inputs-{uuid.uuid4().hex}/{name}"
    w = df.write.format(fmt)
    w = w.option("header", True) if fmt == "csv" else w
    (w.partitionBy(*partition_by) if partition_by else w).save(path)
    return path


def q_staff_map_csv(spark: SparkSession, d: str) -> DataFrame:
    """S3 over a file with padded ids, other column order and repeated rows."""
    from planpulse.sources import load_staff_map
    s = V.table(spark, d, "supplier")
    one = s.select(F.col("s_name").alias("therapist_name"), F.concat(F.lit(" "), "s_suppkey", F.lit(" ")).alias("User_ID"))
    return load_staff_map(spark, _written(one.union(one), "staff"))


def q_targets_csv(spark: SparkSession, d: str) -> DataFrame:
    """S4 over a file with padded keys and targets that are no numbers."""
    from planpulse.sources import load_targets
    p = V.table(spark, d, "part")
    target = F.when(F.col("p_size") % 5 == 0, F.lit("n/a")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".7")))
    rows = p.select(F.concat(F.lit("c"), "p_partkey").alias("category"), target.alias("target"),
                    F.concat(F.lit("  "), "p_brand").alias("branch"))
    return load_targets(spark, _written(rows, "targets"))


def q_assessments_csv(spark: SparkSession, d: str) -> DataFrame:
    """S5 over a file with six date spellings, unreadable dates, counts and costs."""
    from planpulse.sources import load_assessments
    e = V.table(spark, d, "events")
    k, day = F.col("event_id") % 7, F.col("ts").cast("date")
    text = F.lit("soon")
    for i, f in enumerate(("yyyy-MM-dd", "yyyy/MM/dd", "M/d/yyyy", "d-MMM-yyyy", "MMM d, yyyy", "yyyy-MM-dd 10:30")):
        text = F.when(k == i, F.date_format(day, f)).otherwise(text)
    rows = e.select(F.col("event_id").cast("string").alias(" Center "), text.alias("Date"),
                    F.when(k == 1, F.lit("x")).otherwise((k + 1).cast("string")).alias("assesment's no."),
                    F.lit("12.5").alias("Cost"))
    out = load_assessments(spark, _written(rows, "assessments"), {"7": "Seven"})
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("day"), "center", "assess_no", "cost")


def q_report_rows(spark: SparkSession, d: str) -> DataFrame:
    """Write a result, and compare its counted rows with what is read back."""
    from planpulse.sources.sinks import write_report
    df = V.plans(spark, d).select("plan_id", "status", _money())
    path = _written(df.limit(0), "report", "parquet")
    n = write_report(df, path, order_by=[F.asc("plan_id")])
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("read_back")) \
                .withColumn("rows_written", F.lit(n).cast("bigint"))


def q_report_current(spark: SparkSession, d: str) -> DataFrame:
    """Publish a report twice; the current version, numbered in its stored order."""
    from planpulse.plans.daily import stored_order
    from planpulse.sources import publish_report, read_report
    plans = V.plans(spark, d).select(F.col("start_date").alias("active_date"), "entity_id", "plan_id", "status")
    path = _written(plans.limit(0), "published", "parquet")
    order = [*stored_order("active", plans), F.asc("plan_id")]
    publish_report(plans.filter("status = 'F'"), path, order_by=order)
    publish_report(plans, path, order_by=order)
    # A file's rows keep their order and its name tells its place among the files.
    read = read_report(spark, path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_i"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = read.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")) \
                .select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return read.join(files, "_file").select("active_date", "entity_id", "plan_id", (F.col("_base") + F.col("_i")).alias("position"))


# ---------------------------------------------------------------- display form
def _positions(df: DataFrame) -> DataFrame:
    """Number the rows of an ordered report in its own order.

    A sorted frame's parts ascend: a row's number is its place in its part (the low 33 bits
    of the id) after the rows of the parts before, so only a row per part goes to one task.
    """
    from planpulse.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    kept = kept.withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")) \
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.col("_base") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.join(F.broadcast(base), "_part").withColumn("position", place).drop("_id", "_part", "_base")


def q_source_mix_display(spark: SparkSession, d: str) -> DataFrame:
    """Rows by total visits, Total last, under the report's headings."""
    from planpulse import constants as K
    from planpulse.plans.display import with_headings
    from planpulse.plans.mixes import order_source_mix
    shown = with_headings(order_source_mix(q_source_mix(spark, d)), K.SOURCE_HEADINGS)
    return _positions(shown).withColumnsRenamed({h: c for c, h in K.SOURCE_HEADINGS})


def q_staff_display(spark: SparkSession, d: str) -> DataFrame:
    """The staff card by name, under the report's headings."""
    from planpulse.plans.display import display_reports
    shown = display_reports({"staff_mtd": _staff_scorecard(spark, d)}, V.SCORE)["staff_mtd"]
    return _positions(shown).select("Therapist", F.col("NEW OPD").alias("new_visits"), "position")


def q_label_forms(spark: SparkSession, d: str) -> DataFrame:
    """thousands, day and range labels of every order."""
    from planpulse.functions.dates import day_month_label, month_label, range_label
    from planpulse.functions.numbers import default_zero, thousands_label
    o = V.table(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    amount = F.when(F.col("o_orderkey") % 11 != 0, F.floor("o_totalprice").cast("bigint"))
    return o.select("o_orderkey", thousands_label(amount).alias("amount_label"), default_zero(amount).alias("amount"),
                    day_month_label(day).alias("day_label"), range_label(F.trunc(day, "month"), day).alias("range_label"),
                    month_label(day).alias("month_label"))


def q_staff_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Visits per staff and entity once, names by lookup with a default, sums per name."""
    from planpulse.operators.grouping import drop_dup, group_sum
    from planpulse.operators.joins import lookup
    pairs = drop_dup(V.visits(spark, d).select("staff_id", "entity_id"), ["staff_id", "entity_id"])
    names = V.staff_names(spark, d).withColumn("staff_name", F.when(F.col("staff_id") % 5 != 0, F.col("staff_name")))
    named = lookup(pairs, names, "staff_id", "staff_id", ["staff_name"], default="none")
    return group_sum(named.withColumn("one", F.lit(1).cast("bigint")), ["staff_name"], "one", "entities")


QUERIES = {
    "source_mix_display": q_source_mix_display,
    "staff_display": q_staff_display,
    "label_forms": q_label_forms,
    "staff_lookup": q_staff_lookup,
    "feed_broken_pages": q_feed_broken_pages,
    "staff_map_csv": q_staff_map_csv,
    "targets_csv": q_targets_csv,
    "assessments_csv": q_assessments_csv,
    "report_rows": q_report_rows,
    "report_current": q_report_current,
    "feed_rejects": q_feed_rejects,
    "feed_chain": q_feed_chain,
    "nested_text": q_nested_text,
    "duration_table": q_duration_table,
    "active_snapshots": q_active_snapshots,
    "live_flag": q_live_flag,
    "exclude_terms": q_exclude_terms,
    "exclude_entity": q_exclude_entity,
    "latest_per_key": q_latest_per_key,
    "lapsed_entities": q_lapsed_entities,
    "plan_sequence": q_plan_sequence,
    "plan_cycle": q_plan_cycle,
    "plan_cycle_simple": q_plan_cycle_simple,
    "contact_day_dedup": q_contact_day_dedup,
    "role_pivot": q_role_pivot,
    "visits_first_repeat": q_visits_first_repeat,
    "suggest_flag": q_suggest_flag,
    "sessions_by_staff": q_sessions_by_staff,
    "conversions": q_conversions,
    "staff_scorecard": q_staff_scorecard,
    "owner_counts": q_owner_counts,
    "extreme_flags": q_extreme_flags,
    "period_metrics": q_period_metrics,
    "period_metrics_refreshed": q_period_metrics_refreshed,
    "scorecard_change": q_scorecard_change,
    "working_days": q_working_days,
    "best_period": q_best_period,
    "target_vs_achieved": q_target_vs_achieved,
    "duration_mix": q_duration_mix,
    "source_mix": q_source_mix,
    "branch_metric_table": q_branch_metric_table,
    "json_list_join": q_json_list_join,
    "name_canonical": q_name_canonical,
    "source_normalise": q_source_normalise,
    "reject_test_names": q_reject_test_names,
    "trailing_year": q_trailing_year,
    "feed_records": q_feed_records,
}
