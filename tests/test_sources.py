import datetime as dt

import pytest

from helpers_planpulse import rows
from pyspark.sql import functions as F

from planpulse.sources import (
    ResultRegistry, load_alias_map, load_assessments, load_feed, load_staff_map, load_targets,
    write_report,
)
from planpulse.plans.feed import feed_records


def test_alias_map_duplicates(spark, tmp_path):
    p = tmp_path / "alias.csv"
    p.write_text("tech_name,final_name\n Dr A ,Dr Alpha\nDr A,Dr Alpha\nGhost,\n")
    assert rows(load_alias_map(spark, str(p))) == [("Dr A", "Dr Alpha"), ("Ghost", "")]
    bad = tmp_path / "bad.csv"
    bad.write_text("tech_name,final_name\nDr A,X\nDr A,Y\n")
    with pytest.raises(ValueError):
        load_alias_map(spark, str(bad))


def test_staff_map(spark, tmp_path):
    p = tmp_path / "staff.csv"
    p.write_text("user_id,therapist_name\n 17 ,Dr B\n18,\n")
    assert rows(load_staff_map(spark, str(p))) == [("17", "Dr B"), ("18", None)]


def test_targets(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("branch,category,target\n Main ,New OPDs ,12\nMain,Revenue,abc\n")
    assert rows(load_targets(spark, str(p))) == [("Main", "New OPDs", 12), ("Main", "Revenue", 0)]
    missing = load_targets(spark, str(tmp_path / "nope.csv"))
    assert missing.count() == 0 and missing.columns == ["scope", "category", "target"]


def test_assessments_headers(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("Date, CENTER ,Assesments No.,Cost\n2025-06-01,main gk,3,100\nxx,Main,2,5\n"
                 "2025-06-02,Other,bad,\n")
    got = load_assessments(spark, str(p), center_map={"main gk": "GK", "main": "Main"})
    assert rows(got) == [(dt.date(2025, 6, 1), "GK", 3.0, 100.0), (dt.date(2025, 6, 2), "Other", 0.0, 0.0)]
    q = tmp_path / "b.csv"
    q.write_text("date,center\n2025-06-01,X\n")
    assert rows(load_assessments(spark, str(q))) == [(dt.date(2025, 6, 1), "X", 0.0, 0.0)]


def test_write_report_and_registry(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    out = str(tmp_path / "rep")
    assert write_report(df, out, "parquet") == 2
    assert write_report(df.filter("v = 2"), out, "parquet") == 1     # full replace
    assert rows(spark.read.parquet(out)) == [("b", 2)]
    write_report(df, str(tmp_path / "csv"), "csv", order_by=["k"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    reg = ResultRegistry(spark)
    reg.put("x", df)
    assert reg.get("x").count() == 2 and reg.names() == ["x"]
    with pytest.raises(KeyError):
        reg.get("y")


def test_load_tables(spark, tmp_path):
    from planpulse.schemas import PRESCRIPTIONS
    from planpulse.sources import load_tables
    spark.createDataFrame([("e1", True), ("e2", None)], PRESCRIPTIONS) \
        .write.parquet(str(tmp_path / "prescriptions"))
    t = load_tables(spark, str(tmp_path), ["prescriptions"])
    assert rows(t["prescriptions"]) == [("e1", True), ("e2", None)]


def test_load_feed_pages(spark, tmp_path):
    d = tmp_path / "pages"
    d.mkdir()
    (d / "p1.json").write_text('{"data": [{"leadSource": "Web", "createdAt": "2025-06-02T10:00:00Z",\n'
                               ' "package": ["a", {"name": "b"}], "monthsWithUs": 4}],\n "meta": {"hasNextPage": true}}')
    (d / "p2.json").write_text('{"data": [], "meta": {"hasNextPage": false}}')
    got = feed_records(load_feed(spark, str(d)), dt.date(2025, 6, 20))
    assert rows(got) == [("Web", "2025-06-02", "a, b", "", "4")]


def test_lookups_by_header_one_row_per_key(spark, tmp_path):
    import pytest

    from planpulse.sources import lookups as L
    p = tmp_path / "t.csv"
    p.write_text("target,Category , branch\n5,New, B \n5,New,B\nx,Old,B\n")
    assert rows(L.load_targets(spark, str(p)), "scope", "category", "target") == [("B", "New", 5), ("B", "Old", 0)]
    p2 = tmp_path / "t2.csv"
    p2.write_text("branch,category,target\nB,New,5\nB,New,6\n")
    with pytest.raises(ValueError):
        L.load_targets(spark, str(p2))
    p3 = tmp_path / "s.csv"
    p3.write_text("user_id,therapist_name\n1,A\n 1 ,A\n2,B\n")
    assert rows(L.load_staff_map(spark, str(p3)), "staff_id", "staff_raw") == [("1", "A"), ("2", "B")]
    p3.write_text("user_id,therapist_name\n1,A\n1,B\n")
    with pytest.raises(ValueError):
        L.load_staff_map(spark, str(p3))


def test_assessment_dates(spark, tmp_path):
    from planpulse.sources import lookups as L
    p = tmp_path / "a.csv"
    p.write_text("date,center\n03/04/2026,X\n2026/03/04,X\n\"Mar 4, 2026\",X\n2026-03-04 10:00,X\nsoon,X\nsoon,Y\n,Z\n")
    assert [r.date for r in L.load_assessments(spark, str(p)).collect()] == [dt.date(2026, 3, 4)] * 4
    assert L.load_assessments(spark, str(p), date_formats=L.DAY_FIRST).first().date == dt.date(2026, 4, 3)
    assert rows(L.unparsed_dates(spark, str(p)), "date_text", "rows") == [("soon", 2)]


def test_broken_pages_and_iso_dates(spark):
    from pyspark.sql import functions as F

    from planpulse.functions.nested import iso_local_date, variant_text
    from planpulse.sources.feed import broken_pages, feed_rows
    pages = spark.createDataFrame([('{"data": [{"a": 1}], "meta": {}}',), ('{"data": [{"a"',), ("{}",), ('{"data": []}',)], "doc string")
    assert sorted(r.doc for r in broken_pages(pages).collect()) == ['{"data": [{"a"', "{}"]
    assert feed_rows(pages).count() == 1
    text = ["2026-07-20T25:99:07Z", "2026-07-20T10:00:00.1234567Z", "20260720T100000+0530", "2026-02-30", "2026-07-20",
            "2026-07-20T10:00:00+29:00", "2026-07-20T10", "x"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(text)], "i int, t string").orderBy("i")
           .select(iso_local_date("t")).collect()]
    day = dt.date(2026, 7, 20)
    assert got == [None, day, day, None, day, None, day, None]
    docs = ['{"name":0,"title":"T"}', '{"name":false,"label":"L"}', '[[["deep"]]]', '{"name":"","other":"v"}', "1.0", '"s"']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string").orderBy("i")
    got = [r[0] for r in df.select(variant_text(F.parse_json("d"))).collect()]
    assert got[:4] == ["T", "L", "deep", "v"] and got[5] == "s"


def test_page_chain(spark, tmp_path):
    from planpulse.sources import chain_problems
    more, end = '{"data": [], "meta": {"hasNextPage": true}}', '{"data": [], "meta": {"hasNextPage": false}}'
    chains = {"whole": {1: more, 2: end}, "cut": {1: more, 2: more}, "gaps": {2: more, 5: more, 6: end},
              "over": {1: more, 2: end, 3: more, 4: end}, "broken": {1: '{"data"', 2: end}, "one": {1: "{}"}}
    for name, docs in chains.items():
        (tmp_path / name).mkdir()
        for n, doc in docs.items():
            (tmp_path / name / f"fetch-2026-p{n:03d}.json").write_text(doc)
    (tmp_path / "whole" / "copy_p2.json").write_text(end)
    (tmp_path / "whole" / "note.json").write_text(end)
    pages = load_feed(spark, str(tmp_path), r"p(\d+)\.json$")
    found = chain_problems(pages.withColumn("chain", F.element_at(F.split("chain", "/"), -2)))
    assert rows(found) == sorted([
        ("broken", "after the end", 2), ("cut", "endless", 2), ("gaps", "missing", 1), ("gaps", "missing", 3),
        ("over", "after the end", 3), ("over", "after the end", 4), ("whole", "repeated", 2), ("whole", "unnumbered", None)],
        key=lambda t: tuple((x is not None, x) for x in t))


def test_published_report_is_replaced_at_once(spark, tmp_path):
    import pytest

    from planpulse.sources import expire_versions, publish_report, read_report
    from planpulse.sources.sinks import report_versions
    path = str(tmp_path / "report")
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    with pytest.raises(Exception):
        read_report(spark, path)
    assert publish_report(df, path, order_by=["k"]) == 3
    old = read_report(spark, path)
    bad = df.withColumn("v", F.when(F.col("k") == "c", F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):      # dies while it writes: the old report stays whole
        publish_report(bad, path)
    assert rows(read_report(spark, path)) == [("a", 1), ("b", 2), ("c", 3)]
    assert publish_report(df.filter("v > 1"), path) == 2
    assert rows(read_report(spark, path)) == [("b", 2), ("c", 3)] and old.count() == 3
    first = report_versions(spark, path).agg(F.min("version")).first()[0]
    assert rows(read_report(spark, path, first)) == [("a", 1), ("b", 2), ("c", 3)]
    assert len(expire_versions(spark, path, keep=1)) == 2       # the first version and what the dead write left
    assert rows(read_report(spark, path)) == [("b", 2), ("c", 3)]
    assert publish_report(df, path, "csv") == 3 and rows(read_report(spark, path), "k") == [("a",), ("b",), ("c",)]
