"""Property checks on the stand-in tables."""

import datetime as dt

from pyspark.sql import functions as F

from planpulse.bindings import queries as Q
from planpulse.bindings import views as V
from planpulse.operators.history import plan_history
from planpulse.plans.cycle import cycle_status, simple_type

SF = "/root/testdata/sf0.01"


def test_renewal_split_agrees(spark):
    """C3's RENEWAL + LATE RENEWAL = C4's Renewal, before dedup and filters, where no due date is NULL."""
    p = V.plans(spark, SF)
    assert p.filter(F.col("due_date").isNull()).count() > 0
    p = p.filter(F.col("due_date").isNotNull())
    h = plan_history(p, "entity_id", "start_date", "due_date", "plan_id") \
        .select(cycle_status().alias("c3"), simple_type().alias("c4"))
    got = {(r.c3, r.c4): r["count"] for r in h.groupBy("c3", "c4").count().collect()}
    c3 = {k: sum(v for (a, _), v in got.items() if a == k) for k in ("RENEWAL", "LATE RENEWAL")}
    c4 = sum(v for (_, b), v in got.items() if b == "Renewal")
    assert c3["RENEWAL"] + c3["LATE RENEWAL"] == c4 > 0
    assert set(got) <= {("NEW PLAN", "New Plan"), ("RENEWAL", "Renewal"), ("LATE RENEWAL", "Renewal"),
                        ("REVIVAL", "Revival")}


def test_branches_plus_unknown_equal_overall(spark):
    """Overall counts the rows of unknown branches, too; no branch scope does."""
    from planpulse.plans.scorecards import report_periods
    m = Q.q_period_metrics(spark, SF).filter(~F.col("metric").isin("NO2P %", "Revenue", "Assessments"))   # centers are no branches
    overall = {(r.period, r.metric): r.value for r in m.filter("scope = 'Overall'").collect()}
    branches = m.filter("scope <> 'Overall'").groupBy("period", "metric").agg(F.sum("value").alias("v"))
    unknown = Q._facts(spark, SF, V.SCORE).filter("branch IS NULL OR branch = 'Unknown' OR branch = ''")
    missing = {}
    for name, (d1, d2, month) in report_periods(V.SCORE).items():
        hit = F.when(F.col("metric") == "Active", F.col("month") == F.lit(month)).otherwise(F.col("day").between(F.lit(d1), F.lit(d2)))
        for r in unknown.filter(hit).groupBy("metric").agg(F.sum("n").alias("n")).collect():
            missing[(name, r.metric)] = r.n
    assert missing
    for r in branches.collect():
        assert overall[(r.period, r.metric)] == r.v + missing.get((r.period, r.metric), 0), r


def test_scorecard_totals_equal_ungrouped_counts(spark):
    card = Q.q_staff_scorecard(spark, SF)
    r = Q.report_inputs(spark, SF, V.SCORE)
    y = V.SCORE - dt.timedelta(days=1)
    v = r["visits"].filter(F.col("visit_date").between(F.lit(y.replace(day=1)), F.lit(y)))
    from planpulse.operators.names import canonical_names
    v = canonical_names(v, "staff_raw", V.alias_map(spark, SF), "staff").filter("staff IS NOT NULL")
    tot = card.agg(F.sum("new_visits").alias("n"), F.sum("followup_visits").alias("f"),
                   F.sum("total_visits").alias("t")).first()
    assert tot.n == v.filter("opd_status = 'NEW OPD'").count()
    assert tot.f == v.filter("opd_status = 'OLD OPD'").count()
    assert tot.t == tot.n + tot.f
