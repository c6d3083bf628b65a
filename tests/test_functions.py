import datetime as dt

from pyspark.sql import functions as F

from helpers_planpulse import rows
from planpulse.functions import (
    attainment, change_pct, change_pp, clean_text, clamp_low, day_month_label, derived_target,
    duration_label, iso_local_date, json_list_text, month_label, nth_working_day, not_in,
    pending_pct, prorate, range_label, ratio_pct, recode, reject_affix, source_rule,
    thousands_label, to_whole, whole_months, working_days_between,
)
from planpulse.functions.nested import variant_text

D = dt.date


def one(spark, expr, data, schema):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_clean_text(spark):
    data = [("  Dr  A   B ",), ("",), ("  none ",), ("NaN",), ("x\ty",), (None,), ("\tA\n",)]
    assert one(spark, clean_text("s"), data, "s string") == ["Dr A B", None, None, None, "x y", None, "A"]


def test_json_list_text(spark):
    data = [('[" a","b\\n"]',), ("[]",), ("[null]",), (None,), ('["\\tx\\r", null, "y"]',)]
    assert one(spark, json_list_text("j"), data, "j string") == ["a, b", None, None, None, "x, y"]


def test_source_rule(spark):
    data = [("PRACTO",), ("Practo Book",), (" practo call ",), ("Practo-Insta",), ("",),
            ("nan",), (None,), (" Website ",), ("INSTA practo",)]
    assert one(spark, source_rule("s"), data, "s string") == [
        "Practo", "Practo", "Practo", "Practo-Insta", "Unknown", "Unknown", "Unknown", "Website",
        "Practo-Insta"]


def test_duration_label_and_clamp(spark):
    data = [(None,), (0,), (1,), (12,), (4,)]
    df = spark.createDataFrame(data, "m int")
    got = [r[0] for r in df.select(duration_label(clamp_low("m", 1))).collect()]
    assert got == ["1 Month", "1 Month", "1 Month", "1 Year", "4 Month"]


def test_recode(spark):
    data = [("Main",), (" Main ",), (None,), ("main",), ("Other",)]
    exact = one(spark, recode(F.col("b"), {"Main": "M"}, null_label="Unknown"), data, "b string")
    assert exact == ["M", "M", "Unknown", "main", "Other"]
    loose = one(spark, recode(F.col("b"), {"main": "M"}, ignore_case=True), data, "b string")
    assert loose == ["M", " Main ", None, "M", "Other"]


def test_ratio_pct_half_even(spark):
    data = [(0, 0), (5, 0), (1, 16), (3, 16), (1, 3)]
    # 1/16 = 6.25 -> 6.2 (half to even); 3/16 = 18.75 -> 18.8
    assert one(spark, ratio_pct("a", "b"), data, "a int, b int") == [0.0, 0.0, 6.2, 18.8, 33.3]


def test_change_pct(spark):
    data = [(0.0, 0.0, False), (5.0, 0.0, False), (5.0, 0.0, True), (100.04, 100.0, False),
            (120.0, 100.0, False), (80.0, 100.0, False), (120.0, 100.0, True)]
    got = one(spark, change_pct("c", "p", F.col("r")), data, "c double, p double, r boolean")
    assert [(g.pct, g.direction, g.signal) for g in got] == [
        (None, "none", "none"), (None, "new", "good"), (None, "new", "bad"), (0.0, "flat", "none"),
        (20.0, "up", "good"), (20.0, "down", "bad"), (20.0, "up", "bad")]


def test_change_pp(spark):
    data = [(0.0, 0.0), (10.0, 10.04), (12.5, 10.0), (8.0, 10.0)]
    got = one(spark, change_pp("c", "p"), data, "c double, p double")
    assert [(g.pct, g.direction, g.signal) for g in got] == [
        (None, "none", "none"), (0.0, "flat", "none"), (2.5, "up", "good"), (2.0, "down", "bad")]


def test_targets(spark):
    data = [(6, 3, None), (5, 0, 0), (10, 8, 8)]
    df = spark.createDataFrame(data, "active int, ach int, t int")
    r = df.select(derived_target("active").alias("d"), attainment("ach", "t").alias("a"),
                  pending_pct(attainment("ach", "t")).alias("p")).collect()
    assert [x.d for x in r] == [4, 4, 8]          # 4.5 -> 4, 3.75 -> 4, 7.5 -> 8
    assert [x.a for x in r] == [None, 0.0, 100.0]
    assert [x.p for x in r] == [None, 100.0, 0.0]
    assert one(spark, prorate("t", F.lit(0.5)), [(5,), (7,), (None,)], "t int") == [2, 4, None]


def test_whole_months(spark):
    data = [(D(2025, 1, 31), D(2025, 2, 28)), (D(2024, 1, 29), D(2024, 2, 29)),
            (D(2024, 2, 29), D(2025, 2, 28)), (D(2025, 3, 10), D(2025, 1, 10)), (D(2025, 1, 1), None)]
    assert one(spark, whole_months("s", "d"), data, "s date, d date") == [0, 1, 11, -2, None]


def test_working_days(spark):
    # Jun 2025 starts on a Sunday; Feb 2026 has 28 days (4 Sundays).
    data = [(D(2025, 6, 1), 0), (D(2025, 6, 1), 1), (D(2025, 6, 1), 6), (D(2025, 6, 1), 7),
            (D(2025, 6, 1), 40), (D(2026, 2, 1), 24), (D(2026, 2, 1), 25), (D(2025, 8, 1), -3)]
    got = one(spark, nth_working_day("m", F.col("n")), data, "m date, n int")
    assert got == [D(2025, 6, 1), D(2025, 6, 2), D(2025, 6, 7), D(2025, 6, 9), D(2025, 6, 30),
                   D(2026, 2, 28), D(2026, 2, 28), D(2025, 8, 1)]
    data2 = [(D(2025, 6, 1), D(2025, 6, 30)), (D(2026, 2, 1), D(2026, 2, 28)), (D(2025, 6, 5), D(2025, 6, 1)),
             (D(2025, 6, 1), D(2025, 6, 1))]
    assert one(spark, working_days_between("a", "b"), data2, "a date, b date") == [25, 24, 0, 0]


def test_working_days_brute_force(spark):
    import random
    rnd = random.Random(7)
    data = []
    for _ in range(300):
        m = D(rnd.randint(1995, 2030), rnd.randint(1, 12), 1)
        data.append((m, rnd.randint(-2, 30)))
    got = one(spark, nth_working_day("m", F.col("n")), data, "m date, n int")
    for (m, n), g in zip(data, got):
        days = [m + dt.timedelta(days=i) for i in range(31) if (m + dt.timedelta(days=i)).month == m.month]
        work = [x for x in days if x.weekday() != 6]
        want = m if n < 1 else (work[n - 1] if n <= len(work) else work[-1])
        assert g == want, (m, n)


def test_labels(spark):
    data = [(D(2026, 3, 15),)]
    assert one(spark, month_label("d"), data, "d date") == ["Mar-26"]
    assert one(spark, day_month_label("d"), data, "d date") == ["15-Mar"]
    assert one(spark, range_label(F.lit(D(2026, 3, 1)), F.col("d")), data, "d date") == ["1-15 Mar"]
    assert one(spark, thousands_label("v"), [(1234567.5,), (0.0,), (None,)], "v double") == ["1,234,568", "", ""]
    assert one(spark, to_whole("v"), [(2.5,), (3.5,)], "v double") == [2, 4]


def test_predicates(spark):
    data = [("Test x",), ("x TEST",), ("Contest y",), (None,), ("plain",)]
    df = spark.createDataFrame(data, "n string")
    assert rows(df.filter(reject_affix("n", "test")), "n") == [("Contest y",), ("plain",)]
    src = spark.createDataFrame([("CSR",), (None,), ("Web",), ("NVF",)], "s string")
    assert rows(src.filter(not_in("s", ["CSR", "Existing Client", "Offline-Webinar", "NVF"])), "s") == [("Web",)]


def test_iso_local_date(spark):
    data = [("2026-07-20T23:30:00-05:00",), ("2026-07-20T09:20:07.302Z",), ("2026-07-20",),
            ("garbage",), ("",), (None,), ("2026-02-30T00:00:00Z",), ("2026-07-20T01:00:00+05:30",)]
    got = one(spark, iso_local_date("s"), data, "s string")
    assert got == [D(2026, 7, 20), D(2026, 7, 20), D(2026, 7, 20), None, None, None, None, D(2026, 7, 20)]


def test_variant_text(spark):
    docs = ['{"v": {"name": "Gold", "price": 5}}', '{"v": {"a": "x", "b": "", "c": 3}}',
            '{"v": [{"title": "T1"}, "s", "", {"label": "L"}]}', '{"v": "plain"}', '{"v": null}',
            '{"v": []}', '{"v": 7}', '{"v": [[{"name": "deep"}]]}', '{}']
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    v = F.from_json("doc", "struct<v: variant>").getField("v")
    got = [r[0] for r in df.select(variant_text(v)).collect()]
    assert got == ["Gold", "x, 3", "T1, s, L", "plain", "", "", "7", "deep", ""]


def test_variant_text_of_any_depth(spark):
    deep = "[" * 50 + '{"x": [[1]], "name": "in ] [ { \\" \\\\"}' + "]" * 50
    mixed = '[1, [true, [null, {"a": {"b": [1, [2]]}, "c": ""}], "x, y"], [[], [[]]], -2.5, "", [{"name": ""}]]'
    flat = '[{"a": [1]}, "b,[c", {"label": 0, "title": "t"}]'
    df = spark.createDataFrame([(i, d) for i, d in enumerate((deep, mixed, flat, "[[]]"))], "i int, d string").orderBy("i")
    got = [r[0] for r in df.select(variant_text(F.parse_json("d"))).collect()]
    assert got == ['in ] [ { " \\', '1, true, {"b":[1,[2]]}, x, y, -2.5', "[1], b,[c, t", ""]
