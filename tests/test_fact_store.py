import datetime as dt
import re
from decimal import Decimal

import pytest

from helpers_planpulse import rows
from planpulse import schemas as S
from planpulse.plans.daily import ReportConfig, daily_reports, entity_slice, report_facts, shared_results
from planpulse.plans.fact_store import BRANCHES, FactStore, difference, fact_rows
from planpulse.plans.scorecards import daily_facts, period_metrics_from_facts, report_periods
from test_daily import _tables

D = dt.date
FACTS = "branch string, metric string, day date, month date, listed boolean, n double, amount_cents bigint"
AS_OF = D(2026, 4, 15)


def _facts(spark, *more):
    return spark.createDataFrame([
        ("A", "New OPDs", D(2026, 4, 1), None, True, 1.0, 500), ("A", "New OPDs", D(2026, 4, 1), None, True, 1.0, None),
        ("B", "New OPDs", D(2026, 3, 2), None, True, 1.0, 700), (None, "Renewals", None, None, True, 1.0, 0),
        ("B", "Active", None, D(2026, 4, 1), True, 1.0, None), ("C", "Assessments", D(2026, 4, 2), None, False, 0.0, None),
        *more], FACTS)


def _same(store, facts):
    """The store equals a rebuild: no difference, and its rows are those of the plain aggregate."""
    assert difference(fact_rows(facts), store.read_all()).count() == 0
    assert rows(store.read_all().drop("rows", "paid")) == rows(daily_facts(facts))


def _days(df):
    return sorted({re.search("fact_day=([^/]+)/", f)[1] for f in df.inputFiles()})


def test_only_touched_days_are_read_and_written(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "facts"))
    first = _facts(spark)
    assert store.sync(fact_rows(first), "b1") == ["2026-03-02", "2026-04-01", "2026-04-02", BRANCHES, "none"]
    _same(store, first)
    late = spark.createDataFrame([("D", "New OPDs", D(2026, 4, 2), None, True, 1.0, 5)], FACTS)
    none = fact_rows(late.limit(0))
    assert store.apply(none, fact_rows(late), "b2") == ["2026-04-02", BRANCHES]
    _same(store, first.union(late))
    versions = {r.fact_day: r.version for r in store.current().collect()}
    assert versions["2026-03-02"] == versions["2026-04-01"] < versions["2026-04-02"]
    assert store.apply(none, fact_rows(late), "b2") == []          # the same batch again
    _same(store, first.union(late))
    april = store.read(D(2026, 4, 1), D(2026, 4, 30))
    assert _days(april) == ["2026-04-01", "2026-04-02", BRANCHES]  # no file of March is opened
    assert store.sync(fact_rows(first.union(late)), "b3") == []


def test_days_that_become_empty_and_wrong_batches(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "facts"))
    assert store.read_all().count() == 0 and store.read(D(2026, 1, 1), AS_OF).count() == 0
    first = _facts(spark)
    store.sync(fact_rows(first), "b1")
    gone = first.filter("branch = 'B' AND metric = 'New OPDs'")
    store.apply(fact_rows(gone), fact_rows(gone.limit(0)), "b2")
    _same(store, first.exceptAll(gone))
    assert store.current().filter("fact_day = '2026-03-02'").first().rows == 0
    with pytest.raises(ValueError):
        store.apply(fact_rows(gone), fact_rows(gone.limit(0)), "b3")
    _same(store, first.exceptAll(gone))
    store.sync(fact_rows(first.limit(0)), "b4")                    # everything goes
    assert store.read_all().count() == 0
    store.sync(fact_rows(first), "b5")
    _same(store, first)


def test_a_refresh_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch):
    store = FactStore(spark, str(tmp_path / "facts"))
    first = _facts(spark)
    store.sync(fact_rows(first), "b1")
    more = _facts(spark, ("E", "Renewals", D(2026, 4, 9), None, True, 1.0, 9))
    from pyspark.sql import DataFrameWriter
    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "json", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.sync(fact_rows(more), "b2")
    _same(store, first)
    assert store.sync(fact_rows(more), "b2") == ["2026-04-09", BRANCHES]
    _same(store, more)


def test_reports_of_a_few_days_keep_the_branch_list(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "facts"))
    facts = _facts(spark, ("Old", "New OPDs", D(2024, 1, 5), None, True, 1.0, 100))
    store.sync(fact_rows(facts), "b1")
    first = min(d for d, _, _ in report_periods(AS_OF).values())
    got = period_metrics_from_facts(store.read(first, AS_OF), AS_OF)
    assert rows(got) == rows(period_metrics_from_facts(daily_facts(facts), AS_OF))
    assert {r.scope for r in got.collect()} == {"Overall", "A", "B", "Old"}


def test_a_slice_of_changed_entities_is_enough(spark, tmp_path):
    """Late rows of two entities: their slices before and after give the whole refresh."""
    cfg = ReportConfig(session_task="therapy")

    def facts(tables):
        return report_facts(shared_results(tables, AS_OF, cfg, checkpoint=False), cfg)

    old = _tables(spark)
    store = FactStore(spark, str(tmp_path / "facts"))
    store.sync(fact_rows(facts(old)), "day1")
    new = dict(old)
    new["visits"] = old["visits"].union(spark.createDataFrame(
        [("v6", "p3", "e2", D(2026, 1, 20), "10:00", 1, "Dr C", "300")], S.VISITS))   # v1 is no first visit any more
    new["plans"] = old["plans"].union(spark.createDataFrame(
        [("p6", "p6", "e3", D(2026, 4, 12), D(2026, 6, 1), Decimal("70"), "Web", "Annex", "Dr C", None)], S.PLANS))
    changed = spark.createDataFrame([("e2",), ("e3",), (None,)], "entity_id string")
    days = store.apply(fact_rows(facts(entity_slice(old, changed))), fact_rows(facts(entity_slice(new, changed))), "day2")
    _same(store, facts(new))
    assert "2026-01-20" in days and "2026-03-02" in days and "2026-04-13" not in days


def test_daily_job_with_kept_facts(spark, tmp_path):
    tables, cfg = _tables(spark), ReportConfig(session_task="therapy")
    plain = daily_reports(tables, AS_OF, cfg)
    kept = daily_reports(tables, AS_OF, cfg, facts_path=str(tmp_path / "facts"))
    for name in ("period_metrics", "best_period", "scorecard"):
        assert rows(kept[name]) == rows(plain[name]), name


def test_both_days_of_the_refreshed_query_are_one_job(spark, monkeypatch):
    """The facts of both as-of days are computed together, so what they share is shuffled once."""
    from planpulse import session
    from planpulse.bindings import queries as Q
    seen, keep = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda df: seen.append(df.columns) or keep(df))
    out = Q.q_period_metrics_refreshed(spark, "/root/testdata/sf0.001")
    assert len(seen) == 1 and "as_of" in seen[0]
    assert rows(out) == rows(Q.q_period_metrics(spark, "/root/testdata/sf0.001"), *out.columns)
