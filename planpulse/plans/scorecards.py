"""Staff scorecard, period metrics, scorecard with change and targets."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planpulse import constants as K
from planpulse.functions.dates import as_date, month_start
from planpulse.functions.numbers import (
    attainment, cents, change_pct, change_pp, default_amount, derived_target, from_cents, money,
    pending_pct, ratio_pct,
)
from planpulse.operators.grouping import scoped_agg
from planpulse.operators.joins import spine_join
from planpulse.operators.names import canonical_names
from planpulse.operators.reshape import unpivot_roles
from planpulse.plans.visits import conversions

SCORECARD_METRICS = ("new_visits", "followup_visits", "total_visits", "suggested",
                     "conversions", "sessions", "active", "inactive")


def staff_scorecard(visits: DataFrame, sessions: DataFrame, plans: DataFrame,
                    active: DataFrame, lapsed: DataFrame, staff_map: DataFrame,
                    alias: DataFrame | None, d1: dt.date | str, d2: dt.date | str,
                    role_cols: Sequence[str] = ("owner_a", "owner_b")) -> DataFrame:
    """Eight metrics per canonical staff name over ``[d1, d2]``.

    * visits (C5 rows, raw name in ``staff_raw``): new, follow-up, suggested,
      total = new + follow-up;
    * sessions (C6 rows): ``total_sessions`` summed, staff through
      ``staff_map`` (staff_id -> staff_raw);
    * conversions (C7) against the C3 plans;
    * active: C1 rows of the month of ``d2``, once per role column;
    * inactive: C2 rows with ``inactive_date`` from the 1st of ``d2``'s month
      to ``d2``, once per role column;
    * every name seen in any of the five, missing metrics 0.
    """
    lo, hi = as_date(d1), as_date(d2)
    m0 = month_start(d2)
    # Visits of the window, named once; both the visit counts and the
    # conversions read this one frame.
    v = canonical_names(visits.filter(F.col("visit_date").between(lo, hi)), "staff_raw", alias, "staff") \
        .filter(F.col("staff").isNotNull())
    new = F.count_if(F.col("opd_status") == "NEW OPD")
    old = F.count_if(F.col("opd_status") == "OLD OPD")
    visit_m = v.groupBy("staff").agg(new.alias("new_visits"), old.alias("followup_visits"),
                                     F.count_if(F.col("is_suggest") == "Yes").alias("suggested")) \
        .withColumn("total_visits", F.col("new_visits") + F.col("followup_visits"))
    smap = canonical_names(staff_map.select("staff_id", "staff_raw"), "staff_raw", alias, "staff") \
        .select(F.col("staff_id").alias("_sid"), "staff")
    s = sessions.filter(F.col("slot_date").between(lo, hi))
    sess_m = s.join(smap, s.staff_id == smap._sid, "inner").filter(F.col("staff").isNotNull()) \
        .groupBy("staff").agg(F.sum("total_sessions").alias("sessions"))
    conv_m = conversions(v, plans, d1, d2, staff="staff")
    act = active.filter(F.col("active_date") == m0).select(*role_cols)
    act_m = _role_count(act, role_cols, alias, "active")
    ina = lapsed.filter(F.col("inactive_date").between(m0, hi)).select(*role_cols)
    ina_m = _role_count(ina, role_cols, alias, "inactive")
    return spine_join([visit_m, conv_m, sess_m, act_m, ina_m], "staff", SCORECARD_METRICS)


def _role_count(df: DataFrame, role_cols, alias, out: str) -> DataFrame:
    long = unpivot_roles(df, role_cols, "_raw")
    named = canonical_names(long, "_raw", alias, "staff").filter(F.col("staff").isNotNull())
    return named.groupBy("staff").agg(F.count(F.lit(1)).alias(out))


# ------------------------------------------------------------------ C9
def report_periods(as_of: dt.date) -> dict[str, tuple[dt.date, dt.date, dt.date]]:
    """Yesterday, month-to-date and the same span of last month.

    Each maps to (first day, last day, month whose active snapshot counts).
    Last month's span ends on yesterday's day number, capped at that
    month's length.
    """
    y = as_of - dt.timedelta(days=1)
    m0 = y.replace(day=1)
    lm0 = (m0 - dt.timedelta(days=1)).replace(day=1)
    lm_last = (m0 - dt.timedelta(days=1)).day
    lm_end = lm0.replace(day=min(y.day, lm_last))
    return {"yesterday": (y, y, m0), "mtd": (m0, y, m0), "last_month": (lm0, lm_end, lm0)}


def metric_facts(visits: DataFrame, plans: DataFrame, active: DataFrame, lapsed: DataFrame,
                 assessments: DataFrame | None, branch_col: str = "branch") -> DataFrame:
    """All inputs as one narrow union of (branch, metric, day, month, n, amount_cents, listed).

    ``day`` is the event day (NULL for the Active snapshot, which is matched
    by ``month``); ``listed`` marks the four frames whose branches form the
    report's branch list (assessments do not).
    """
    vis_amt = cents(default_amount("amount"))
    v = visits.select(
        F.col(branch_col).alias("branch"), F.col("visit_date").alias("day"),
        F.explode(F.array_compact(F.array(
            F.struct(F.when(F.col("opd_status") == "NEW OPD", F.lit("New OPDs"))
                      .when(F.col("opd_status") == "OLD OPD", F.lit("F/U OPDs")).alias("metric"),
                     vis_amt.alias("amount_cents")),
            F.when(F.col("is_suggest") == "Yes",
                   F.struct(F.lit("Suggest RPP").alias("metric"),
                            F.lit(None).cast("bigint").alias("amount_cents")))))).alias("f")) \
        .select("branch", "day", F.col("f.metric").alias("metric"), F.col("f.amount_cents").alias("amount_cents"))
    p = plans.select(
        F.col(branch_col).alias("branch"), F.col("start_date").alias("day"),
        F.when(F.col("plan_type") == "New Plan", F.lit("New Plan"))
         .when(F.col("plan_type") == "Renewal", F.lit("Renewals"))
         .when(F.col("plan_type") == "Revival", F.lit("Revivals")).alias("metric"),
        cents(money("amount")).alias("amount_cents"))
    i = lapsed.select(F.col(branch_col).alias("branch"), F.col("inactive_date").alias("day"),
                      F.lit("Inactive").alias("metric"), F.lit(None).cast("bigint").alias("amount_cents"))
    parts = [x.withColumn("month", F.lit(None).cast("date")).withColumn("n", F.lit(1.0))
             for x in (v, p, i)]
    a = active.select(F.col(branch_col).alias("branch"), F.lit(None).cast("date").alias("day"),
                      F.lit("Active").alias("metric"), F.lit(None).cast("bigint").alias("amount_cents"),
                      F.col("active_date").alias("month"), F.lit(1.0).alias("n"))
    facts = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(a) \
        .withColumn("listed", F.lit(True))
    if assessments is not None:
        s = assessments.select(F.col("center").alias("branch"), F.col("date").alias("day"),
                               F.lit("Assessments").alias("metric"),
                               cents(money("cost")).alias("amount_cents"),
                               F.lit(None).cast("date").alias("month"),
                               F.col("assess_no").cast("double").alias("n"),
                               F.lit(False).alias("listed"))
        facts = facts.unionByName(s)
    return facts.filter(F.col("metric").isNotNull())


def daily_facts(facts: DataFrame) -> DataFrame:
    """Pre-aggregate facts to one row per (branch, metric, day, month, listed).

    Every report metric is a count or a sum over days, so this partial
    aggregate loses nothing; its size is bounded by branches x metrics x
    calendar days, not by the data volume.  Reports that share it should
    checkpoint it once (``session.materialize``) and read it several times.
    """
    return facts.groupBy("branch", "metric", "day", "month", "listed") \
        .agg(F.sum("n").alias("n"), F.sum("amount_cents").alias("amount_cents"))


def _count_metrics():
    return [m for m in K.CATEGORIES if m not in K.RATIO_CATEGORIES]


SEEN = "_seen"


def tagged_metrics(facts: DataFrame, tags: Column, periods: Column,
                   unknown: str = K.UNKNOWN_LABEL) -> DataFrame:
    """Aggregate facts into a complete long (scope, period, metric, value, amount) table.

    ``tags`` is an array<string> expression naming the periods a fact falls
    in (a narrow ``explode``, no join).  A further pseudo-period marks facts
    of the listed frames, so the branch list (A17: minus blank and Unknown)
    comes out of the same grouping-sets aggregate.  That aggregate has one row
    per (scope, period) with a conditional sum per metric; a scope's rows are
    then gathered into a map by period (calendar-bounded), from which the
    complete grid scopes x periods x metrics, the ratio and the revenue are
    read without a join.  ``periods`` is an array<string> of all period labels.
    """
    seen = F.when(F.col("listed"), F.lit(SEEN))
    tagged = facts.withColumn("period", F.explode(F.array_compact(F.array_union(tags, F.array(seen)))))
    names = _count_metrics()
    paid = [m for m in names if m in K.AMOUNT_CATEGORIES]
    value = {m: f"v{i}" for i, m in enumerate(names)}
    amount = {m: f"a{i}" for i, m in enumerate(paid)}
    sums = [F.sum(F.when(F.col("metric") == m, F.col("n"))).alias(c) for m, c in value.items()]
    sums += [F.sum(F.when(F.col("metric") == m, F.col("amount_cents"))).alias(c) for m, c in amount.items()]
    wide = scoped_agg(tagged, "branch", ["period"], sums).withColumnRenamed("branch", "scope")
    row = F.struct("period", F.struct(*value.values(), *amount.values()))
    by_scope = wide.groupBy("scope").agg(F.map_from_entries(F.collect_list(row)).alias("_by")) \
        .filter(F.map_contains_key("_by", F.lit(SEEN)) & F.col("scope").isNotNull()
                & (F.col("scope") != "") & (F.col("scope") != unknown))
    cell = by_scope.withColumn("period", F.explode(periods)).withColumn("_v", F.try_element_at("_by", F.col("period")))
    v = {m: F.coalesce(F.col(f"_v.{c}"), F.lit(0.0)) for m, c in value.items()}
    a = {m: F.coalesce(F.col(f"_v.{c}"), F.lit(0)) for m, c in amount.items()}
    none = F.lit(None).cast("double")
    revenue = from_cents(functools.reduce(lambda x, y: x + y, a.values()))

    def entry(metric: str, val: Column, amt: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), val.alias("value"), amt.alias("amount"))

    entries = [entry(m, v[m], from_cents(a[m]) if m in a else none) for m in names]
    entries += [entry("NO2P %", ratio_pct(v["New Plan"], v["New OPDs"]), none), entry(K.REVENUE_LABEL, revenue, revenue)]
    return cell.select("scope", "period", F.explode(F.array(*entries)).alias("e")).select("scope", "period", "e.*")


def period_metrics(visits: DataFrame, plans: DataFrame, active: DataFrame, lapsed: DataFrame,
                   assessments: DataFrame | None, as_of: dt.date,
                   branch_col: str = "branch") -> DataFrame:
    """Long table (scope, period, metric, value, amount) for yesterday, MTD, last month.

    One pass: every fact is tagged with the periods it falls in, then one
    grouping-sets aggregate gives each branch and the overall scope (which
    also counts rows of unknown branch, trap T18).  NO2P % = New Plan / New
    OPDs; Revenue = the sum of the six amounts.  Every (scope, period,
    metric) is present, zero when empty.
    """
    facts = daily_facts(metric_facts(visits, plans, active, lapsed, assessments, branch_col))
    return period_metrics_from_facts(facts, as_of)


def period_metrics_from_facts(facts: DataFrame, as_of: dt.date) -> DataFrame:
    """``period_metrics`` over prepared (daily) facts."""
    periods = report_periods(as_of)
    tags = []
    for name, (d1, d2, month) in periods.items():
        hit = F.when(F.col("metric") == "Active", F.col("month") == as_date(month)) \
               .otherwise(F.col("day").between(as_date(d1), as_date(d2)))
        tags.append(F.when(hit, F.lit(name)))
    return tagged_metrics(facts, F.array(*tags), F.array(*[F.lit(p) for p in periods]))


# ------------------------------------------------------------------ C10
def scorecard(metrics: DataFrame, targets: DataFrame | None) -> DataFrame:
    """Per scope and category: the three periods, change, amount, target, attainment.

    ``targets``: (scope, category, target); Renewals' target is always
    round-half-even(0.75 x last month's Active).  A category without a target
    has NULL target/attained/pending/met; a zero target gives 0 %, met.  For
    Revenue a zero target counts as none.  Ratio metrics change in points.
    """
    wide = metrics.groupBy("scope", "metric").agg(
        *[F.max(F.when(F.col("period") == p, F.col("value"))).alias(p)
          for p in ("yesterday", "mtd", "last_month")],
        F.max(F.when(F.col("period") == "mtd", F.col("amount"))).alias("amount"))
    # Last month's Active of the scope, for the derived target: a window over a scope's dozen rows.
    lm_active = F.max(F.when(F.col("metric") == "Active", F.col("last_month"))).over(Window.partitionBy("scope"))
    out = wide.withColumn("_lm_active", lm_active)
    if targets is not None:
        t = targets.select(F.col("scope").alias("_ts"), F.col("category").alias("_tc"),
                           F.col("target").cast("bigint").alias("_t"))
        out = out.join(t, (out.scope == t._ts) & (out.metric == t._tc), "left").drop("_ts", "_tc")
    else:
        out = out.withColumn("_t", F.lit(None).cast("bigint"))
    is_ratio = F.col("metric").isin(list(K.RATIO_CATEGORIES))
    is_rev = F.col("metric") == K.REVENUE_LABEL
    target = (F.when(F.col("metric") == "Renewals", derived_target(F.coalesce(F.col("_lm_active"), F.lit(0.0))))
               .when(is_rev & (F.col("_t") == 0), F.lit(None).cast("bigint"))
               .otherwise(F.col("_t")))
    change = F.when(is_ratio, change_pp("mtd", "last_month")) \
        .otherwise(change_pct("mtd", "last_month", F.col("metric").isin(list(K.REVERSED_CATEGORIES))))
    out = out.withColumn("target", target).withColumn("_chg", change)
    att = attainment("mtd", "target")
    return out.select(
        "scope", "metric", "yesterday", "mtd", "last_month",
        F.col("_chg.pct").alias("change_pct"), F.col("_chg.direction").alias("direction"),
        F.col("_chg.signal").alias("signal"),
        F.when(F.col("metric").isin(list(K.AMOUNT_CATEGORIES)) | is_rev, F.col("amount")).alias("amount"),
        "target", att.alias("attained"),
        F.when(F.col("target").isNotNull(), pending_pct(att)).alias("pending"),
        F.when(F.col("target").isNotNull(), F.col("mtd") >= F.col("target")).alias("met"))
