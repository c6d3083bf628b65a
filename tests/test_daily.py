import datetime as dt
from decimal import Decimal

from planpulse import schemas as S
from planpulse.plans.daily import ReportConfig, daily_reports, write_daily_reports

D = dt.date
T = dt.datetime


def _tables(spark):
    plans = spark.createDataFrame([
        ("p1", "p1", "e1", D(2026, 1, 5), D(2026, 4, 5), Decimal("100"), "Web", "Main", "Dr A", "Dr B"),
        ("p2", "p2", "e1", D(2026, 4, 1), D(2026, 7, 1), Decimal("120"), "Web", "Main", "Dr A", None),
        ("p3", "p3", "e2", D(2026, 3, 14), D(2026, 4, 14), Decimal("50"), "Practo Call", "Annex", "Dr C", "Dr B"),
        ("p4", "p4", "e3", D(2025, 12, 1), D(2026, 3, 10), Decimal("80"), "Web", "Annex", "Dr C", None),
        ("p5", "p5", "e4", D(2026, 4, 14), D(2026, 5, 14), Decimal("0"), "CSR", "Main", "Dr A", None)], S.PLANS)
    entities = spark.createDataFrame([
        ("e1", "Asha", "Main", "Web", 91, None), ("e2", "Ravi", "Annex", "Practo Call", 92, "regular"),
        ("e3", "Mina", "Annex", "Web", 93, None), ("e4", "Test Lee", "Main", "CSR", 94, "c7")], S.ENTITIES)
    assignments = spark.createDataFrame([
        ("p1", "Active", "Psychologist", "Dr A", T(2026, 1, 5)), ("p2", "Active", "Psychologist", "Dr Z", T(2026, 4, 1)),
        ("p3", "Expired", "Psychiatrist", "Dr B", T(2026, 3, 14)), ("p3", "Active", "Counsellor", "Dr C", None)],
        S.ASSIGNMENTS)
    visits = spark.createDataFrame([
        ("v1", "p3", "e2", D(2026, 3, 2), "10:00", 1, "Dr C", "0"), ("v2", "p3", "e2", D(2026, 4, 13), "10:00", 5, "Dr C", "700"),
        ("v3", "p2", "e1", D(2026, 4, 14), "11:00", 1, " Dr  A", None), ("v4", "p4", "e3", D(2026, 4, 2), "", 1, "Dr C", "500"),
        ("v5", "p4", "e3", D(2026, 4, 10), "09:00", 1, "Dr C", "500")], S.VISITS)
    prescriptions = spark.createDataFrame([("e2", True), ("e1", False)], S.PRESCRIPTIONS)
    roster = spark.createDataFrame([
        ("r1", "u1", D(2026, 4, 14), "therapy", 1, 1), ("r2", "u1", D(2026, 4, 3), "therapy", 1, 1),
        ("r3", "u2", D(2026, 4, 14), "therapy", 0, 1)], S.ROSTER)
    roster_map = spark.createDataFrame([("r1", "e1"), ("r2", "e2")], S.ROSTER_MAP)
    terms = spark.createDataFrame([("zz", "vz")], S.TERMS)
    return {"plans": plans, "entities": entities, "assignments": assignments, "visits": visits,
            "prescriptions": prescriptions, "roster": roster, "roster_map": roster_map, "terms": terms}


def test_daily_reports_end_to_end(spark, tmp_path):
    tables = _tables(spark)
    staff_map = spark.createDataFrame([("u1", "Dr A")], "staff_id string, staff_raw string")
    alias = spark.createDataFrame([("Dr Z", "Dr A")], "tech_name string, final_name string")
    reports = daily_reports(tables, D(2026, 4, 15), ReportConfig(session_task="therapy"),
                            alias=alias, staff_map=staff_map)
    assert {"active", "lapsed", "plan_cycle", "plan_types", "visits", "sessions", "staff_yesterday",
            "staff_mtd", "staff_mtd_flags", "period_metrics", "scorecard", "best_period",
            "target_vs_achieved", "branch_table", "duration_mix", "source_mix"} <= set(reports)
    mtd = {r.staff: r for r in reports["staff_mtd"].collect()}
    assert mtd["Dr A"].sessions == 2 and mtd["Dr A"].new_visits == 1
    assert mtd["Dr C"].followup_visits == 1 and mtd["Dr C"].new_visits == 1
    cyc = {r.plan_id: r.plan_status for r in reports["plan_cycle"].collect()}
    assert cyc == {"p1": "NEW PLAN", "p2": "RENEWAL", "p3": "NEW PLAN", "p4": "NEW PLAN"}   # test name out
    roles = {r.plan_id: (r.psychologist_name, r.counsellor_name) for r in reports["plan_cycle"].collect()}
    assert roles["p1"] == ("Dr Z", None) and roles["p3"] == (None, "Dr C")
    sc = {(r.scope, r.metric): r for r in reports["scorecard"].collect()}
    # p4 lapsed on 2026-03-11 (last month's span); p3 lapses on 04-15, after yesterday
    assert (sc[("Overall", "Inactive")].mtd, sc[("Overall", "Inactive")].last_month) == (0.0, 1.0)
    assert sc[("Overall", "Inactive")].signal == "good"      # fewer lapses is good
    counts = write_daily_reports(reports, str(tmp_path / "out"))
    assert counts["plan_cycle"] == 4 and counts["source_mix"] == 19 + 2


def test_daily_cli(spark, tmp_path, capsys):
    from planpulse.plans.daily import main
    src = tmp_path / "tables"
    for name, df in _tables(spark).items():
        df.write.parquet(str(src / name))
    tgt = tmp_path / "targets.csv"
    tgt.write_text("branch,category,target\nOverall,New OPDs,10\n")
    main(["--tables", str(src), "--as-of", "2026-04-15", "--task", "therapy", "--out", str(tmp_path / "out"),
          "--targets", str(tgt)])
    out = capsys.readouterr().out
    assert "scorecard: 33 rows" in out and "plan_cycle: 4 rows" in out
    from planpulse.sources import read_report
    sc = read_report(spark, str(tmp_path / "out" / "scorecard"))
    assert sc.filter("scope = 'Overall' AND metric = 'New OPDs'").first().target == 10


def test_display_form(spark, tmp_path):
    from planpulse.plans.display import display_reports, period_headings
    assert period_headings(D(2026, 3, 16)) == {"yesterday": "Yesterday (15-Mar)", "mtd": "MTD-1 (1-15 Mar)",
                                               "last_month": "Last Month (1-15 Feb)"}
    reports = daily_reports(_tables(spark), D(2026, 4, 15), ReportConfig(session_task="therapy"))
    shown = display_reports(reports, D(2026, 4, 15))
    assert shown["staff_mtd"].columns[:3] == ["Therapist", "NEW OPD", "F/U OPD"]
    sc = shown["scorecard"].filter("scope = 'Overall'").collect()
    assert [r.Category for r in sc][:2] == ["New OPDs", "F/U OPDs"] and sc[-1].Category == "Revenue"
    # visits 700 + 1500 (missing amount) + 500, renewal p2 120
    assert sc[-1]["MTD-1 (1-14 Apr)"] == "2,820"
    counts = write_daily_reports(reports, str(tmp_path / "csv"), "csv", display_as_of=D(2026, 4, 15))
    assert counts["scorecard"] == 33


def test_daily_rejects(spark, tmp_path):
    """Pages, records and assessments that no report can use are outputs with counts."""
    from planpulse.sources import load_feed, read_assessments
    (tmp_path / "feed").mkdir()
    ok = '{"leadSource": "Web", "createdAt": "2026-04-02T10:00:00Z", "package": [[["p"]]]}'
    (tmp_path / "feed" / "page1.json").write_text(
        '{"data": [' + ok + ', 7, {"createdAt": "soon"}, {"createdAt": "2020-01-01"}], "meta": {"hasNextPage": true}}')
    (tmp_path / "feed" / "page3.json").write_text('{"data": [')
    (tmp_path / "a.csv").write_text("date,center\n2026-04-02,X\nsoon,X\n,Z\n")
    reports = daily_reports(_tables(spark), D(2026, 4, 15), ReportConfig(session_task="therapy"),
                            assessments=read_assessments(spark, str(tmp_path / "a.csv")), feed=load_feed(spark, str(tmp_path / "feed")))
    assert [r.package for r in reports["feed"].collect()] == ["p"]
    assert sorted(tuple(r) for r in reports["feed_rejects"].collect()) == [
        ("broken page", '{"data": ['), ("no creation date", '{"createdAt":"soon"}'), ("no object", "7")]
    assert [(r.problem, r.page) for r in reports["feed_chain"].collect()] in (
        [("missing", 2), ("after the end", 3)], [("after the end", 3), ("missing", 2)], [("missing", 2)])
    some = {n: reports[n] for n in ("feed", "feed_rejects", "feed_chain", "assessment_rejects")}
    counts = write_daily_reports(some, str(tmp_path / "out"))
    assert (counts["feed"], counts["feed_rejects"], counts["assessment_rejects"]) == (1, 3, 1)
