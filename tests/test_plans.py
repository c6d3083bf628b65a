import datetime as dt

from pyspark.sql import functions as F

from helpers_planpulse import rows
from planpulse.plans import (
    active_snapshots, conversions, lapsed_entities, plan_cycle, plan_cycle_simple,
    sessions_by_staff, visits_classified,
)
from planpulse.plans.feed import feed_records
from planpulse.plans.mixes import duration_mix, source_mix
from planpulse.plans.scorecards import period_metrics, report_periods, scorecard, staff_scorecard

D = dt.date
PLANS = ("plan_id long, plan_ref string, entity_id long, start_date date, due_date date, "
         "amount decimal(18,2), source string, branch string, owner_a string, owner_b string")
ENT = "entity_id long, name string, branch string, source string, contact long, csr_id string"


def _plans(spark, data):
    full = [(p, f"r{p}", e, s, d, None if a is None else __import__("decimal").Decimal(a), src, "B1", "a", "b")
            for (p, e, s, d, a, src) in data]
    return spark.createDataFrame(full, PLANS)


def _entities(spark, ids, source="Web", csr=None, names=None):
    return spark.createDataFrame(
        [(i, (names or {}).get(i, f"Person {i}"), "B1", source, i, csr) for i in ids], ENT)


def test_active_snapshots_current_month_needs_live(spark):
    plans = _plans(spark, [(1, 1, D(2025, 1, 15), D(2025, 4, 1), "10", "Web"),
                           (2, 2, D(2025, 1, 15), D(2025, 4, 1), "10", "Web"),
                           (3, 3, D(2025, 1, 15), D(2025, 4, 1), "10", "NVF"),      # excluded source
                           (4, 4, D(2025, 1, 15), D(2025, 4, 1), "10", "Web")])     # has exclusion term
    assign = spark.createDataFrame([(1, "Active"), (1, "Expired"), (2, "Expired"), (2, None)],
                                   "plan_id long, status string")
    terms = spark.createDataFrame([("r4",)], "plan_ref string")
    snap = active_snapshots(plans, assign, _entities(spark, [1, 2, 3, 4]), terms, D(2025, 1, 1), D(2025, 3, 1))
    assert rows(snap, "active_date", "plan_id", "first_status") == [
        (D(2025, 1, 1), 1, "Active"), (D(2025, 1, 1), 2, "Expired"),
        (D(2025, 2, 1), 1, "Active"), (D(2025, 2, 1), 2, "Expired"),
        (D(2025, 3, 1), 1, "Active")]          # current month: only the plan with a live assignment
    # as-of on the 1st: ref date = as-of, start < ref required
    snap1 = active_snapshots(plans, assign, _entities(spark, [1, 2]), None, D(2025, 3, 1), D(2025, 3, 1))
    assert rows(snap1, "plan_id") == [(1,)]


def test_lapsed_entities(spark):
    asof = D(2025, 5, 10)
    plans = _plans(spark, [(1, 1, D(2025, 1, 1), D(2025, 5, 9), "1", "Web"),     # due = as_of - 1: in
                           (2, 2, D(2025, 1, 1), D(2025, 5, 10), "1", "Web"),    # due = as_of: out
                           (3, 3, D(2024, 1, 1), D(2024, 6, 1), "1", "Web"),
                           (4, 3, D(2025, 2, 1), None, "1", "Web"),              # NULL due wins: never lapses
                           (5, 5, D(2024, 1, 1), D(2024, 2, 1), "1", "Web"),
                           (6, 5, D(2024, 1, 1), D(2024, 3, 1), "1", "Web")])
    got = lapsed_entities(plans, _entities(spark, [1, 2, 3, 5]), None, asof)
    assert rows(got, "entity_id", "plan_id", "inactive_date", "months_with_us") == [
        (1, 1, D(2025, 5, 10), 1), (5, 6, D(2024, 3, 2), 2)]


def test_plan_cycle_four_way_and_simple(spark):
    asof = D(2025, 12, 31)
    data = [(1, 1, D(2025, 1, 1), D(2025, 2, 1), "1", "Web"),    # NEW
            (2, 1, D(2025, 2, 1), D(2025, 3, 1), "1", "Web"),    # start = previous due: RENEWAL
            (3, 1, D(2025, 4, 15), D(2025, 5, 1), "1", "Web"),   # +45 days: LATE RENEWAL
            (4, 1, D(2025, 6, 16), D(2025, 7, 1), "1", "Web"),   # +46 days: REVIVAL
            (5, 2, D(2025, 1, 1), None, "1", "Web"),             # first plan, NULL due
            (6, 2, D(2025, 3, 1), D(2025, 4, 1), "1", "Web")]    # previous due NULL (T8)
    plans = _plans(spark, data)
    ents = spark.createDataFrame([(1, "Ann", "B1", "Web", 100, None), (2, "Bo", "B1", "Web", 200, "regular")], ENT)
    visits = spark.createDataFrame([(2, "S")], "entity_id long, slot string")
    c3 = plan_cycle(plans, ents, visits, asof)
    assert rows(c3, "plan_id", "plan_status", "direct_after_opd", "months_with_us") == [
        (1, "NEW PLAN", "Direct Plan", 1), (2, "RENEWAL", None, 2), (3, "LATE RENEWAL", None, 3),
        (4, "REVIVAL", None, 4), (5, "NEW PLAN", "After OPD", 1), (6, "REVIVAL", None, 2)]
    vis = spark.createDataFrame([], "visit_id string, entity_id long")
    c4 = plan_cycle_simple(plans, ents, vis, None, asof)
    assert rows(c4, "plan_id", "plan_type", "plan_months", "total_service_months") == [
        (1, "New Plan", 1, 2), (2, "Renewal", 1, 2), (3, "Renewal", 0, 2), (4, "Revival", 0, 2),
        (5, "New Plan", None, 1), (6, "New Plan", 1, 1)]


def test_plan_cycle_contact_dedup_and_test_names(spark):
    data = [(1, 1, D(2025, 3, 1), D(2025, 4, 1), "1", "Web"),
            (2, 2, D(2025, 3, 1), D(2025, 4, 1), "1", "Web"),    # same contact and day -> dropped
            (3, 3, D(2025, 3, 1), D(2025, 4, 1), "1", "Web"),    # test-named entity
            (4, 4, D(2025, 3, 1), D(2025, 4, 1), "1", "Web")]    # NULL contact (T4)
    ents = spark.createDataFrame([(1, "A", "B1", "Web", 7, None), (2, "B", "B1", "Web", 7, None),
                                  (3, "Test person", "B1", "Web", 8, None), (4, "C", "B1", "Web", None, None)], ENT)
    visits = spark.createDataFrame([], "entity_id long, slot string")
    got = plan_cycle(_plans(spark, data), ents, visits, D(2025, 12, 1))
    assert rows(got, "plan_id") == [(1,), (4,)]


def test_visits_classified(spark):
    asof = D(2025, 6, 30)
    vis = spark.createDataFrame([
        ("v1", 1, D(2025, 6, 1), "S", 1, "Dr A", "100"), ("v2", 1, D(2025, 6, 1), "S", 5, "Dr A", "0"),
        ("v3", 1, D(2025, 6, 9), "S", 1, "Dr B", "100"),
        ("v4", 2, D(2025, 5, 1), "S", 9, "Dr A", "1"),             # unlisted status, still makes v5 OLD
        ("v5", 2, D(2025, 6, 2), "S", 1, "Dr A", "1"),
        ("v6", 3, D(2025, 6, 3), "", 1, "Dr A", "1"),              # empty slot: dropped
        ("v7", 3, D(2025, 6, 4), "S", 1, "Dr A", "1"),
        ("v8", 4, D(2025, 6, 5), "S", 1, "Dr A", "1")],            # entity source excluded
        "visit_id string, entity_id long, visit_date date, slot string, status int, staff_raw string, amount string")
    ents = spark.createDataFrame([(1, "a", "B1", "Web", 1, None), (2, "b", "B1", "Web", 2, None),
                                  (3, "c", "B1", "Web", 3, None), (4, "d", "B1", "CSR", 4, None)], ENT)
    rx = spark.createDataFrame([(1, True), (1, False), (2, None), (3, False)], "entity_id long, suggested boolean")
    terms = spark.createDataFrame([("v3",)], "visit_id string")
    got = visits_classified(vis, ents, rx, terms, asof)
    assert rows(got, "visit_id", "opd_status", "is_suggest") == [
        ("v1", "NEW OPD", "Yes"), ("v2", "NEW OPD", "Yes"), ("v5", "OLD OPD", None), ("v7", "NEW OPD", "No")]


def test_conversions(spark):
    vis = spark.createDataFrame([
        (1, "A", D(2025, 6, 5), "NEW OPD"), (1, "B", D(2025, 6, 6), "NEW OPD"),   # two staff, one entity
        (2, "A", D(2025, 6, 5), "NEW OPD"), (None, "A", D(2025, 6, 5), "NEW OPD"),
        (3, "A", D(2025, 6, 5), "OLD OPD")],
        "entity_id long, staff string, visit_date date, opd_status string")
    plans = spark.createDataFrame([(1, D(2025, 6, 1), "NEW PLAN"),   # plan before the visit: counts
                                   (2, D(2025, 5, 31), "NEW PLAN"), (None, D(2025, 6, 2), "NEW PLAN"),
                                   (3, D(2025, 6, 2), "NEW PLAN")],
                                  "entity_id long, start_date date, plan_status string")
    got = conversions(vis, plans, D(2025, 6, 1), D(2025, 6, 15))
    assert rows(got) == [("A", 1), ("B", 1)]


def test_sessions_by_staff(spark):
    roster = spark.createDataFrame([
        ("r1", "u1", D(2026, 1, 2), "therapy", 1, 1), ("r2", "u1", D(2026, 1, 2), "therapy", 1, 1),
        ("r3", "u1", D(2026, 1, 2), "therapy", 0, 1), ("r4", "u2", D(2025, 12, 31), "therapy", 1, 1),
        ("r5", "u2", D(2026, 1, 3), "therapy", 1, 1)],
        "roster_id string, staff_id string, slot_date date, task string, booked int, is_active int")
    rmap = spark.createDataFrame([("r1", 1), ("r1", 2), ("r2", 1), ("r5", 3)], "roster_id string, entity_id long")
    ents = spark.createDataFrame([(1, "a", "B1", "Kellton", 1, "c1"), (2, "b", "B1", "Web", 2, None),
                                  (3, "c", "B1", "Web", 3, "x")], ENT)
    got = sessions_by_staff(roster, rmap, ents, D(2026, 1, 1), D(2026, 1, 10), "therapy")
    assert rows(got, "staff_id", "entity_id", "entity_type", "total_sessions") == [
        ("u1", 1, "Corporate", 2), ("u2", 3, "NTPC", 1)]


def test_report_periods():
    p = report_periods(D(2025, 3, 31))
    assert p["yesterday"] == (D(2025, 3, 30), D(2025, 3, 30), D(2025, 3, 1))
    assert p["last_month"] == (D(2025, 2, 1), D(2025, 2, 28), D(2025, 2, 1))   # day capped
    assert report_periods(D(2025, 1, 1))["mtd"] == (D(2024, 12, 1), D(2024, 12, 31), D(2024, 12, 1))


def _report_frames(spark):
    visits = spark.createDataFrame([
        (D(2025, 6, 14), "NEW OPD", "Yes", "0", "B1", "Practo Call"),
        (D(2025, 6, 3), "OLD OPD", None, "200", "B2", "Website"),
        (D(2025, 5, 10), "NEW OPD", "No", "abc", "Unknown", None)],
        "visit_date date, opd_status string, is_suggest string, amount string, branch string, entity_source string")
    plans = spark.createDataFrame([
        (D(2025, 6, 14), "New Plan", "1000", "B1", 3, "Practo"),
        (D(2025, 5, 2), "Renewal", "bad", "B2", 12, "Website"),
        (D(2025, 6, 1), "Revival", "50", "B1", None, "GMB")],
        "start_date date, plan_type string, amount string, branch string, total_service_months long, entity_source string")
    active = spark.createDataFrame([(D(2025, 6, 1), "B1"), (D(2025, 5, 1), "B1"), (D(2025, 5, 1), "B2")],
                                   "active_date date, branch string")
    lapsed = spark.createDataFrame([(D(2025, 6, 10), "B2")], "inactive_date date, branch string")
    assess = spark.createDataFrame([(D(2025, 6, 2), "B1", 3.0, "70.5")], "date date, center string, assess_no double, cost string")
    return visits, plans, active, lapsed, assess


def test_period_metrics_and_scorecard(spark):
    visits, plans, active, lapsed, assess = _report_frames(spark)
    m = period_metrics(visits, plans, active, lapsed, assess, D(2025, 6, 15))
    got = {(r.scope, r.period, r.metric): (r.value, r.amount) for r in m.collect()}
    assert got[("Overall", "mtd", "New OPDs")] == (1.0, 1500.0)          # amount 0 -> 1500
    assert got[("Overall", "last_month", "New OPDs")] == (1.0, 1500.0)   # bad amount -> 0 -> 1500
    assert got[("B2", "last_month", "Renewals")] == (1.0, 0.0)            # bad plan amount -> 0
    assert got[("Overall", "mtd", "NO2P %")] == (100.0, None)
    assert got[("Overall", "mtd", "Revenue")] == (2820.5, 2820.5)
    assert got[("Overall", "yesterday", "Active")] == (1.0, None)
    assert got[("B2", "last_month", "Active")] == (1.0, None)
    assert got[("B1", "mtd", "Assessments")] == (3.0, 70.5)
    assert {s for s, _, _ in got} == {"Overall", "B1", "B2"}              # Unknown is not a scope
    assert len(got) == 3 * 3 * 11
    targets = spark.createDataFrame([("Overall", "New OPDs", 4), ("Overall", "Revenue", 0)],
                                    "scope string, category string, target long")
    sc = {(r.scope, r.metric): r for r in scorecard(m, targets).collect()}
    r = sc[("Overall", "New OPDs")]
    assert (r.mtd, r.last_month, r.direction, r.target, r.attained, r.pending, r.met) == (1.0, 1.0, "flat", 4, 25.0, 75.0, False)
    assert sc[("Overall", "Renewals")].target == 2          # round_half_even(2 * 0.75 = 1.5) = 2
    assert sc[("Overall", "Revenue")].target is None        # zero revenue target counts as none
    assert sc[("Overall", "Inactive")].signal == "bad"      # 0 -> 1 is "new", reversed metric


def test_duration_and_source_mix(spark):
    visits, plans, *_ = _report_frames(spark)
    dm = duration_mix(plans.withColumn("plan_type", F.lit("New Plan")), D(2025, 6, 15), ["B1", "B2"])
    got = {(r.duration_label, r.period, r.scope): (r.plan_count, r.amount, r.label_rank) for r in dm.collect()}
    assert got[("3 Month", "mtd", "B1")] == (1, 1000, 3)
    assert got[("1 Month", "mtd", "Total")] == (1, 50, 1)         # NULL months -> 1
    assert got[("1 Year", "mtd", "B2")] == (0, 0, 6)              # bucket from all data, zero in period
    sm = source_mix(visits, plans, D(2025, 6, 1), D(2025, 6, 14))
    got = {r.source: r for r in sm.collect()}
    assert got["Practo"].new_visits == 1 and got["Practo"].new_plans == 1 and got["Practo"].conversion_pct == 100.0
    assert got["Website"].old_visits == 1 and got["GMB"].revivals == 1
    assert got["Team Referral"].total_visits == 0 and got["Total"].is_total
    assert got["Total"].total_visits == 2 and got["Total"].conversion_pct == 100.0
    assert len(got) == 19 + 1


def test_staff_scorecard(spark):
    alias = spark.createDataFrame([("Dr A", "Dr Alpha"), ("Ghost", "")], "tech_name string, final_name string")
    visits = spark.createDataFrame([
        (1, " Dr  A ", D(2025, 6, 14), "NEW OPD", "Yes"), (2, "Dr B", D(2025, 6, 2), "OLD OPD", None),
        (3, "Ghost", D(2025, 6, 2), "NEW OPD", None), (4, None, D(2025, 6, 2), "NEW OPD", None)],
        "entity_id long, staff_raw string, visit_date date, opd_status string, is_suggest string")
    sessions = spark.createDataFrame([("u1", D(2025, 6, 3), 4), ("u9", D(2025, 6, 3), 2)],
                                     "staff_id string, slot_date date, total_sessions long")
    smap = spark.createDataFrame([("u1", "Dr B")], "staff_id string, staff_raw string")
    plans = spark.createDataFrame([(1, D(2025, 6, 10), "NEW PLAN")], "entity_id long, start_date date, plan_status string")
    active = spark.createDataFrame([(D(2025, 6, 1), "Dr A", "Dr A"), (D(2025, 6, 1), "Dr B", None)],
                                   "active_date date, owner_a string, owner_b string")
    lapsed = spark.createDataFrame([(D(2025, 6, 5), None, "Dr B")], "inactive_date date, owner_a string, owner_b string")
    got = staff_scorecard(visits, sessions, plans, active, lapsed, smap, alias, D(2025, 6, 1), D(2025, 6, 14))
    assert rows(got) == [("Dr Alpha", 1, 0, 1, 1, 1, 0, 2, 0), ("Dr B", 0, 1, 1, 0, 0, 4, 1, 1)]


def test_feed_records(spark):
    pages = spark.createDataFrame([
        ('{"data": [{"leadSource": "Web", "createdAt": "2025-06-01T23:30:00-05:00", '
         '"package": {"name": "Gold"}, "assignments": [{"label": "A"}, {"title": "B"}], "monthsWithUs": "3"}, '
         '"junk", {"createdAt": "2025-05-31T23:59:59Z", "leadSource": "Old"}, '
         '{"createdAt": "bad", "leadSource": "Bad"}, {"createdAt": "2024-06-01T00:00:00Z"}], '
         '"meta": {"hasNextPage": false}}',)], "doc string")
    got = feed_records(pages, D(2025, 6, 20))
    assert rows(got) == [("", "2024-06-01", "", "", ""), ("Old", "2025-05-31", "", "", ""),
                         ("Web", "2025-06-01", "Gold", "A, B", "3")]


def _bench_facts(spark):
    """Daily facts for best-month tests: New OPDs in Jan/Feb/Mar 2025, Active snapshots."""
    from planpulse.plans.scorecards import daily_facts
    rows_ = []
    def add(branch, metric, day=None, month=None, n=1.0, amount=None, listed=True):
        rows_.append((branch, day, month, metric, n, None if amount is None else int(amount * 100), listed))
    # Jan: 2 New OPDs (one after the same-period span), Feb: 2 within span, Mar: 1
    add("B1", "New OPDs", D(2025, 1, 2), amount=__import__("decimal").Decimal("10"))
    add("B1", "New OPDs", D(2025, 1, 30), amount=__import__("decimal").Decimal("10"))
    add("B1", "New OPDs", D(2025, 2, 3), amount=__import__("decimal").Decimal("10"))
    add("B2", "New OPDs", D(2025, 2, 4), amount=__import__("decimal").Decimal("10"))
    add("B1", "New OPDs", D(2025, 3, 3), amount=__import__("decimal").Decimal("10"))
    add("B1", "Active", month=D(2025, 1, 1)); add("B1", "Active", month=D(2025, 2, 1))
    add("B1", "Active", month=D(2025, 4, 1)); add("B1", "Active", month=D(2025, 4, 1))
    add("B1", "New OPDs", D(2025, 4, 2), amount=__import__("decimal").Decimal("10"))
    df = spark.createDataFrame(rows_, "branch string, day date, month date, metric string, n double, "
                                      "amount_cents bigint, listed boolean")
    return daily_facts(df)


def test_best_period_and_targets(spark):
    from planpulse.plans.benchmarks import best_period, target_vs_achieved
    from planpulse.plans.mixes import branch_metric_table
    from planpulse.plans.scorecards import period_metrics_from_facts
    asof = D(2025, 4, 4)      # yesterday Apr 3: 3 working days so far (Apr 1-3), 26 in April
    facts = _bench_facts(spark)
    best = {(r.scope, r.metric, r.span): (r.best_value, r.best_label)
            for r in best_period(facts, asof, D(2025, 1, 1)).collect()}
    # same-period span = first 3 working days: Jan 2 counts (Jan 30 does not); Feb 3 and 4 count
    assert best[("Overall", "New OPDs", "same")] == (2.0, "Feb-25")
    assert best[("Overall", "New OPDs", "full")] == (2.0, "Jan-25")     # tie Jan/Feb: earliest wins
    assert best[("B2", "New OPDs", "full")] == (1.0, "Feb-25")
    assert best[("B2", "Active", "same")] == (0.0, "")                  # all zero: no label
    assert best[("Overall", "Active", "same")] == (1.0, "Jan-25")
    assert best[("Overall", "NO2P %", "full")] == (0.0, "")
    assert ("Overall", "Revenue", "full") not in best
    metrics = period_metrics_from_facts(facts, asof)
    targets = spark.createDataFrame([("Overall", "New OPDs", 26), ("B1", "Active", 0)],
                                    "scope string, category string, target long")
    tva = {(r.scope, r.metric): r for r in target_vs_achieved(metrics, best_period(facts, asof, D(2025, 1, 1)),
                                                              targets, asof).collect()}
    r = tva[("Overall", "New OPDs")]
    assert (r.target, r.prorated_target, r.best_value, r.achieved, r.met) == (26, 3, 2.0, 1.0, False)
    assert tva[("B1", "Active")].met is True                            # target 0 is met
    assert tva[("Overall", "Revivals")].target is None
    assert tva[("Overall", "Renewals")].target == 0                     # 0.75 x last month's Active (0)
    bmt = {(r.scope, r.metric): r for r in branch_metric_table(metrics, best_period(facts, asof, D(2025, 1, 1)))
           .filter("span = 'same'").collect()}
    assert bmt[("Overall", "New OPDs")].attainment_pct == 50
    assert bmt[("Total", "Active")].achieved == 2.0


def test_working_calendar(spark):
    from planpulse.plans.calendar import month_progress, working_calendar, working_days_py
    months = spark.createDataFrame([(D(2025, 6, 17),), (D(2026, 2, 3),), (D(2025, 6, 1),)], "d date")
    got = rows(working_calendar(months, "d", nth=(0, 5, 40)))
    assert got == [(D(2025, 6, 1), 30, 25, D(2025, 6, 1), D(2025, 6, 6), D(2025, 6, 30)),
                   (D(2026, 2, 1), 28, 24, D(2026, 2, 1), D(2026, 2, 6), D(2026, 2, 28))]
    assert working_days_py(D(2025, 6, 1), D(2025, 6, 30)) == 25
    assert month_progress(D(2025, 6, 16)) == (12, 25)   # Sundays Jun 1, 8, 15


def test_month_refs_and_periods(spark):
    from planpulse.plans.calendar import month_refs, periods
    got = rows(month_refs(spark, D(2025, 11, 1), D(2026, 1, 20)))
    assert got == [(D(2025, 11, 1), D(2025, 11, 30), False), (D(2025, 12, 1), D(2025, 12, 31), False),
                   (D(2026, 1, 1), D(2026, 1, 20), True)]
    p = {r.period: (r.d1, r.d2, r.active_month) for r in periods(spark, D(2026, 3, 31)).collect()}
    assert p["last_month"] == (D(2026, 2, 1), D(2026, 2, 28), D(2026, 2, 1))


def test_entity_type_rules(spark):
    from planpulse.plans.cycle import entity_type
    from planpulse.plans.visits import session_entity_type
    data = [("Corporate", 5, "x"), ("NTPC", 5, None), ("CSR", 0, None), ("CSR", 5, None),
            ("Existing Client", 0, "regular"), ("Web", 5, None), ("Web", 5, "regular"), ("Web", 0, "c9")]
    df = spark.createDataFrame(data, "source string, amount int, csr_id string")
    got = [r[0] for r in df.select(entity_type("source", "amount", "csr_id")).collect()]
    assert got == ["Corporate", "CSR", "CSR", "Regular", "CSR", "Regular", "Regular", "CSR"]
    s = spark.createDataFrame([(None, None), ("regular", "Primus"), ("c1", "TATA AIA"), ("c1", "Web")],
                              "csr_id string, source string")
    got = [r[0] for r in s.select(session_entity_type("csr_id", "source")).collect()]
    assert got == ["Regular", "Regular", "Corporate", "NTPC"]


def test_primary_diagnosis_in_snapshots(spark):
    import datetime as _dt
    plans = _plans(spark, [(1, 1, D(2025, 1, 1), D(2025, 6, 1), "1", "Web"),
                           (2, 2, D(2025, 1, 1), D(2025, 6, 1), "1", "Web"),
                           (3, 3, D(2025, 1, 1), D(2025, 6, 1), "1", "Web")])
    assign = spark.createDataFrame([(1, "Active"), (2, "Active"), (3, "Active")], "plan_id long, status string")
    T = _dt.datetime
    diag = spark.createDataFrame([
        (1, '["a ", "b"]', None, T(2025, 1, 1)), (1, None, "old", None),          # NULL updated sorts last
        (2, '["x"]', "Primary", T(2025, 2, 1)),
        (3, "[]", None, T(2025, 2, 1))],                                           # empty list -> NULL
        "entity_id long, diagnosis_list string, primary_diagnosis string, updated_at timestamp")
    snap = active_snapshots(plans, assign, _entities(spark, [1, 2, 3]), None, D(2025, 2, 1), D(2025, 2, 10),
                            diagnoses=diag, extras=())
    assert rows(snap, "plan_id", "primary_diagnosis") == [(1, "a, b"), (2, "Primary"), (3, None)]


def test_exclusions_in_snapshots(spark):
    plans = _plans(spark, [(1, 1, D(2025, 1, 1), D(2025, 6, 1), "1", None),          # NULL source: dropped
                           (2, 2, D(2025, 1, 1), D(2025, 6, 1), "1", "CSR"),
                           (3, 3, D(2025, 1, 1), D(2025, 6, 1), "1", "Existing Client"),
                           (4, 4, D(2025, 1, 1), D(2025, 6, 1), "1", "Offline-Webinar"),
                           (5, 5, D(2025, 1, 1), D(2025, 6, 1), "1", "NVF"),
                           (6, 6, D(2025, 1, 1), D(2025, 6, 1), "1", "Web"),
                           (7, 99, D(2025, 1, 1), D(2025, 6, 1), "1", "Web")])       # no such entity
    assign = spark.createDataFrame([(i, "Active") for i in range(1, 8)], "plan_id long, status string")
    snap = active_snapshots(plans, assign, _entities(spark, [1, 2, 3, 4, 5, 6]), None, D(2025, 2, 1),
                            D(2025, 2, 10), extras=())
    assert rows(snap, "plan_id") == [(6,)]


def test_plan_cycle_ignores_future_plans(spark):
    base = [(1, 1, D(2025, 1, 1), D(2025, 2, 1), "1", "Web"), (2, 1, D(2025, 2, 10), D(2025, 3, 1), "1", "Web"),
            (3, 2, D(2025, 3, 1), D(2025, 4, 1), "1", "Web")]
    future = [(4, 1, D(2025, 8, 1), D(2025, 9, 1), "1", "Web"), (5, 2, D(2025, 3, 2), D(2025, 5, 1), "1", "Web")]
    ents = _entities(spark, [1, 2])
    visits = spark.createDataFrame([], "entity_id long, slot string")
    asof = D(2025, 3, 1)
    a = plan_cycle(_plans(spark, base), ents, visits, asof)
    b = plan_cycle(_plans(spark, base + future), ents, visits, asof)
    cols = ("plan_id", "plan_status", "months_with_us")
    assert rows(a, *cols) == rows(b, *cols) == [(1, "NEW PLAN", 1), (2, "LATE RENEWAL", 2), (3, "NEW PLAN", 1)]


def test_entity_cols_pass_through(spark):
    ents = spark.createDataFrame([(1, "a", "B1", "Web", 1, None, 34)], ENT + ", age int")
    vis = spark.createDataFrame([("v1", 1, D(2025, 6, 1), "S", 1, "Dr", "1")],
                                "visit_id string, entity_id long, visit_date date, slot string, status int, "
                                "staff_raw string, amount string")
    rx = spark.createDataFrame([], "entity_id long, suggested boolean")
    got = visits_classified(vis, ents, rx, None, D(2025, 6, 30), entity_cols=["age"])
    assert rows(got, "visit_id", "age") == [("v1", 34)]
    plans = _plans(spark, [(1, 1, D(2025, 6, 1), D(2025, 7, 1), "1", "Web")])
    assert rows(plan_cycle(plans, ents, vis, D(2025, 6, 30), entity_cols=["age"]), "age") == [(34,)]
    assert rows(plan_cycle_simple(plans, ents, vis, None, D(2025, 6, 30), entity_cols=["age"]), "age") == [(34,)]


def test_prebooked_renewal_is_not_lapsed(spark):
    """A plan that starts after the as-of date keeps its entity, its renewal row and its tenure."""
    import datetime as dt

    from planpulse.plans.cycle import plan_cycle_simple
    from planpulse.plans.snapshots import lapsed_entities
    d = dt.date
    plans = spark.createDataFrame(
        [("p1", "p1", "e1", d(2026, 3, 1 + 9), d(2026, 4, 10), "s"), ("p2", "p2", "e1", d(2026, 4, 20), d(2026, 10, 20), "s"),
         ("p3", "p3", "e2", d(2026, 1, 1), d(2026, 2, 1), "s")],
        "plan_id string, plan_ref string, entity_id string, start_date date, due_date date, source string")
    entities = spark.createDataFrame([("e1", "A", "s", "b"), ("e2", "B", "s", "b")],
                                     "entity_id string, name string, source string, branch string")
    visits = spark.createDataFrame([], "visit_id string, entity_id string")
    as_of = d(2026, 4, 15)
    status = spark.createDataFrame([("p3", "Open"), ("p3", "Expired")], "plan_id string, status string")
    diag = spark.createDataFrame([("e2", '[" x ", "y"]', None, None)],
                                 "entity_id string, diagnosis_list string, primary_diagnosis string, updated_at timestamp")
    gone = lapsed_entities(plans, entities, None, as_of, assignments=status, diagnoses=diag, entity_kind="Regular").collect()
    assert [(r.entity_id, r.first_status, r.primary_diagnosis, r.entity_kind) for r in gone] == [("e2", "Expired", "x, y", "Regular")]
    types = {r.plan_id: r for r in plan_cycle_simple(plans, entities, visits, None, as_of).collect()}
    assert types["p2"].plan_type == "Renewal" and types["p2"].total_service_months == 7


def test_lapsed_joins_the_last_plan_only(spark):
    """The entity is joined to its last plan, not to all (no salted frame); one listed twice gives one row, an unknown one none."""
    import datetime as dt
    d = dt.date
    plans = spark.createDataFrame([(1, 1, "e1", d(2026, 1, 1), d(2026, 2, 1), "s"), (2, 2, "e1", d(2026, 2, 1), d(2026, 3, 1), "s"),
                                   (3, 3, "gone", d(2026, 1, 1), d(2026, 2, 1), "s"), (4, 4, None, d(2026, 1, 1), d(2026, 2, 1), "s"),
                                   (5, 5, "e2", d(2026, 1, 1), None, "s"), (6, 6, "e2", d(2026, 1, 1), d(2026, 2, 1), "s")],
                                  "plan_id int, plan_ref int, entity_id string, start_date date, due_date date, source string")
    entities = spark.createDataFrame([("e1", "A"), ("e1", "A"), ("e2", "B"), (None, "C")], "entity_id string, branch string")
    for cols in ((), ("branch",)):
        out = lapsed_entities(plans, entities, None, d(2026, 4, 15), entity_cols=cols, extras=())
        assert [(r.entity_id, r.plan_id, r.inactive_date) for r in out.collect()] == [("e1", 2, d(2026, 3, 2))]
        assert "_salt" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_active_snapshots_join_only_plans_that_can_be_in_force(spark):
    """Plans over before the first month or begun after the as-of day are left out before the joins."""
    import datetime as dt
    d = dt.date
    plans = spark.createDataFrame([(i, i, "e1", s, e, "s") for i, (s, e) in enumerate([
        (d(2025, 1, 1), d(2025, 2, 1)), (d(2025, 12, 1), d(2026, 1, 31)), (d(2025, 12, 1), d(2026, 2, 1)), (d(2026, 1, 31), d(2026, 5, 1)),
        (d(2026, 2, 9), d(2026, 5, 1)), (d(2026, 2, 10), d(2026, 5, 1)), (d(2026, 2, 1), None), (None, d(2026, 5, 1))])],
        "plan_id int, plan_ref int, entity_id string, start_date date, due_date date, source string")
    live = plans.select("plan_id", F.lit("Open").alias("status"))
    entities = spark.createDataFrame([("e1", "A")], "entity_id string, branch string")
    snap = active_snapshots(plans, live, entities, None, d(2026, 1, 1), d(2026, 2, 10), entity_cols=("branch",), extras=())
    assert sorted((r.active_date, r.plan_id) for r in snap.collect()) == [
        (d(2026, 1, 1), 2), (d(2026, 2, 1), 3), (d(2026, 2, 1), 4)]
    plan = snap._jdf.queryExecution().optimizedPlan().toString()
    assert "(start_date#" in plan and "> 2026-01-01)" in plan
