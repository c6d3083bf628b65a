import datetime as dt

from helpers_planpulse import rows
from planpulse.streaming import start_feed_ingest


def _page(i, day):
    return ('{"data": [{"leadSource": "S%d", "createdAt": "%sT08:00:00+05:30", "package": {"title": "P%d"},'
            ' "assignments": [], "monthsWithUs": "%d"}], "meta": {"hasNextPage": true}}' % (i, day, i, i))


def test_feed_ingest_available_now(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "p1.json").write_text(_page(1, "2025-06-01"))
    (land / "p2.json").write_text(_page(2, "2024-01-01"))      # before the cutoff
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    q = start_feed_ingest(spark, str(land), out, dt.date(2025, 6, 20), checkpoint_location=ck)
    q.awaitTermination(120)
    assert rows(spark.read.parquet(out)) == [("S1", "2025-06-01", "P1", "", "1")]
    (land / "p3.json").write_text(_page(3, "2025-06-03"))      # a later run picks up only the new page
    q = start_feed_ingest(spark, str(land), out, dt.date(2025, 6, 20), checkpoint_location=ck)
    q.awaitTermination(120)
    assert rows(spark.read.parquet(out), "lead_source") == [("S1",), ("S3",)]
