import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers_planpulse import rows
from planpulse.operators import (
    arg_best, best_flag, exclude, extreme_flags, first_flag, in_force, latest_per_key,
    ordered_labels, pivot_roles, plan_history, scoped_agg, spine_join, unpivot_roles, with_flag,
)

D = dt.date


def test_latest_per_key_null_order_and_ties(spark):
    data = [(1, 10, D(2025, 1, 1)), (1, 11, None), (1, 12, D(2025, 3, 1)),   # NULL due wins DESC NULLS FIRST
            (2, 20, D(2025, 1, 1)), (2, 21, D(2025, 1, 1)),                   # exact tie -> larger id
            (3, 30, None), (3, 31, None)]                                     # all NULL
    df = spark.createDataFrame(data, "e int, id int, due date")
    got = latest_per_key(df, ["e"], [F.col("due").desc_nulls_first(), F.col("id").desc()])
    assert rows(got, "e", "id") == [(1, 11), (2, 21), (3, 31)]
    asc = latest_per_key(df, ["e"], [F.col("due").asc_nulls_last(), F.col("id").asc()])
    assert rows(asc, "e", "id") == [(1, 10), (2, 20), (3, 30)]


def test_latest_per_key_plans_partial_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    got = latest_per_key(df, ["k"], [F.col("id").desc()])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert rows(got, "k", "id") == [(0, 999), (1, 997), (2, 998)]


def test_plan_history_edge_rows(spark):
    data = [(1, 1, D(2025, 1, 1), D(2025, 2, 1)),
            (1, 2, D(2025, 2, 1), D(2025, 3, 1)),
            (1, 3, D(2025, 2, 1), None),            # same day as plan 2: shares running count
            (1, 4, D(2025, 5, 1), D(2025, 6, 1)),
            (1, 5, None, D(2025, 7, 1)),            # NULL start sorts last
            (2, 6, D(2025, 1, 1), D(2025, 1, 31))]
    df = spark.createDataFrame(data, "e int, id int, s date, d date")
    h = plan_history(df, "e", "s", "d", "id")
    got = rows(h, "id", "seq", "running_count", "prev_start", "prev_due")
    assert got == [
        (1, 1, 1, None, None),
        (2, 2, 3, D(2025, 1, 1), D(2025, 2, 1)),
        (3, 3, 3, D(2025, 2, 1), D(2025, 3, 1)),
        (4, 4, 4, D(2025, 2, 1), None),
        (5, 5, 5, D(2025, 5, 1), D(2025, 6, 1)),
        (6, 1, 1, None, None)]


def test_plan_history_matches_plain_windows(spark):
    rnd = random.Random(3)
    data = []
    for i in range(600):
        e = rnd.choice([1, 1, 1, 1, 2, 3, None])           # entity 1 is hot, NULL entity too
        s = None if rnd.random() < 0.05 else D(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        d = None if rnd.random() < 0.1 else D(2024, 3, 1) + dt.timedelta(days=rnd.randint(0, 90))
        data.append((e, i, s, d))
    df = spark.createDataFrame(data, "e int, id int, s date, d date")
    w = Window.partitionBy("e").orderBy(F.col("s").asc_nulls_last(), F.col("id"))
    wr = Window.partitionBy("e").orderBy(F.col("s").asc_nulls_last())
    plain = df.select("id", F.row_number().over(w).alias("seq"), F.count(F.lit(1)).over(wr).alias("rc"),
                      F.lag("s").over(w).alias("ps"), F.lag("d").over(w).alias("pd"))
    two_level = plan_history(df, "e", "s", "d", "id") \
        .select("id", "seq", F.col("running_count").alias("rc"), F.col("prev_start").alias("ps"),
                F.col("prev_due").alias("pd"))
    assert rows(two_level) == rows(plain)


def test_first_flag(spark):
    data = [(1, D(2025, 1, 1), "S"), (1, D(2025, 1, 1), "S"),   # two on the first day: both new
            (1, D(2025, 1, 5), "S"),                            # repeat
            (2, D(2025, 1, 1), ""), (2, D(2025, 1, 3), "S"),    # earlier visit has empty slot
            (3, D(2025, 1, 2), "S"), (3, D(2025, 1, 9), "")]
    df = spark.createDataFrame(data, "e int, d date, slot string")
    got = first_flag(df, "e", "d", F.col("slot") != "", out="rep")
    assert rows(got, "e", "d", "rep") == [
        (1, D(2025, 1, 1), False), (1, D(2025, 1, 1), False), (1, D(2025, 1, 5), True),
        (2, D(2025, 1, 1), False), (2, D(2025, 1, 3), False), (3, D(2025, 1, 2), False),
        (3, D(2025, 1, 9), True)]


def test_best_flag(spark):
    data = [(1, True), (1, False), (2, False), (2, None), (3, None)]
    df = spark.createDataFrame(data, "e int, f boolean")
    assert rows(best_flag(df, ["e"], "f", "b"), "e", "b") == [(1, True), (2, False), (3, None)]


def test_exclude_and_flag(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    terms = spark.createDataFrame([(2,), (None,)], "k int")
    assert rows(exclude(left, terms, "k"), "k") == [(None,), (1,)]
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(with_flag(left, keys, "k", "hit"), "k", "hit") == [(None, False), (1, True), (2, False)]


def test_in_force_edges(spark):
    asof = D(2025, 3, 10)
    data = [(1, D(2025, 1, 31), D(2025, 3, 1)),   # Jan-31: starts on ref -> not Jan; Feb yes
            (2, D(2025, 1, 1), D(2025, 1, 31)),   # ends on Jan ref -> out
            (3, D(2025, 2, 10), D(2025, 1, 1)),   # due before start
            (4, D(2025, 1, 1), None),             # NULL due
            (5, D(2024, 12, 1), D(2025, 6, 1)),   # Jan, Feb, Mar (ref = as_of)
            (6, D(2025, 3, 10), D(2025, 4, 1))]   # starts on as_of -> out
    df = spark.createDataFrame(data, "id int, s date, d date")
    got = in_force(df, "s", "d", D(2025, 1, 1), asof, month_col="m")
    assert rows(got, "id", "m", "ref_date", "is_current_month") == [
        (1, D(2025, 2, 1), D(2025, 2, 28), False),
        (5, D(2025, 1, 1), D(2025, 1, 31), False), (5, D(2025, 2, 1), D(2025, 2, 28), False),
        (5, D(2025, 3, 1), D(2025, 3, 10), True)]


def test_in_force_matches_theta_join(spark):
    rnd = random.Random(11)
    data = []
    for i in range(400):
        s = D(2024, 6, 1) + dt.timedelta(days=rnd.randint(0, 300))
        d = s + dt.timedelta(days=rnd.randint(-20, 200))
        data.append((i, s, d))
    df = spark.createDataFrame(data, "id int, s date, d date")
    asof = D(2025, 2, 14)
    months = spark.sql("SELECT explode(sequence(DATE'2024-09-01', DATE'2025-02-01', INTERVAL 1 MONTH)) AS m") \
        .withColumn("ref", F.least(F.last_day("m"), F.lit(asof)))
    theta = df.join(months, (df.s < months.ref) & (df.d > months.ref)).select("id", "m")
    got = in_force(df, "s", "d", D(2024, 9, 1), asof, month_col="m").select("id", "m")
    assert rows(got) == rows(theta)


def test_spine_join(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, m1 long")
    b = spark.createDataFrame([("y", 5), ("z", 7), (None, 9)], "k string, m2 long")
    assert rows(spine_join([a, b], "k", ["m1", "m2"])) == [("x", 1, 0), ("y", 2, 5), ("z", 0, 7)]


def test_unpivot_and_pivot_roles(spark):
    df = spark.createDataFrame([("A", "A"), ("B", None), (None, "C")], "r1 string, r2 string")
    got = unpivot_roles(df, ["r1", "r2"], "who").groupBy("who").count()
    assert rows(got) == [("A", 2), ("B", 1), ("C", 1)]
    roles = spark.createDataFrame([(1, "Psy", "p"), (1, "Doc", "d"), (2, "Psy", "q"), (2, "X", "x")],
                                  "e int, role string, name string")
    got = pivot_roles(roles, "e", "role", "name", ["Psy", "Doc", "Cou"], ["psy", "doc", "cou"])
    assert rows(got, "e", "psy", "doc", "cou") == [(1, "p", "d", None), (2, "q", None, None)]


def test_extreme_flags(spark):
    data = [("a", 0, 5, 3, 2), ("b", 0, 5, 1, 0), ("c", 0, 5, 7, 4)]
    df = spark.createDataFrame(data, "s string, z long, eq long, v long, inv long")
    got = extreme_flags(df, ["z", "eq", "v", "inv"], reverse=["inv"])
    assert rows(got, "s", "z_flag", "eq_flag", "v_flag", "inv_flag") == [
        ("a", None, "best", None, "best"), ("b", None, "best", "worst", None),
        ("c", None, "best", "best", "worst")]


def test_arg_best(spark):
    data = [("x", "Jan", 1, 5.0), ("x", "Feb", 2, 7.0), ("x", "Mar", 3, 7.0),
            ("y", "Jan", 1, 0.0), ("y", "Feb", 2, 0.0)]
    df = spark.createDataFrame(data, "k string, m string, o int, v double")
    assert rows(arg_best(df, ["k"], "v", "m", "o"), "k", "best_value", "best_period") == [
        ("x", 7.0, "Feb"), ("y", 0.0, None)]


def test_scoped_agg_overall_counts_unknown(spark):
    data = [("A", 1), ("B", 2), (None, 4), ("Unknown", 8)]
    df = spark.createDataFrame(data, "b string, v int")
    got = scoped_agg(df, "b", [], [F.sum("v").alias("s")])
    assert rows(got, "b", "s") == [(None, 4), ("A", 1), ("B", 2), ("Overall", 15), ("Unknown", 8)]


def test_ordered_labels(spark):
    df = spark.createDataFrame([("Zed",), ("GMB",), ("Practo",), ("Unknown",), ("Abc",)], "l string")
    got = ordered_labels(df, "l", ["Practo", "GMB"], last=["Unknown"], out="r")
    assert [r.l for r in got.orderBy("r", "l").collect()] == ["Practo", "GMB", "Abc", "Zed", "Unknown"]


def test_plan_history_window_sees_only_day_rows(spark):
    """The per-entity window must run over pre-aggregated (entity, day) rows, never raw plans."""
    df = spark.range(5000).select((F.col("id") % 3).alias("e"), F.col("id").alias("id"),
                                  F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("s"),
                                  F.lit(None).cast("date").alias("d"))
    h = plan_history(df, "e", "s", "d", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = h._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Every window partitioned by the entity alone sits above an aggregate of the day rows.
    blocks = plan.split("Window [")
    entity_windows = [b for b in blocks[1:] if "[e#" in b.split("\n")[0] and "_e#" not in b.split("\n")[0]]
    assert entity_windows, plan
    for b in entity_windows:
        below = b.split("\n", 1)[1]
        nxt = below.find("Window [")
        scope = below if nxt < 0 else below[:nxt]
        assert "HashAggregate" in scope, plan
    assert rows(h.groupBy("e").agg(F.max("seq").alias("m")), "e", "m") == [(0, 1667), (1, 1667), (2, 1666)]


def test_lookup(spark):
    from planpulse.operators.joins import lookup
    df = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("x", "X"), ("z", "Z")], "key string, label string")
    got = lookup(df, dim, "k", "key", ["label"], default="?")
    assert rows(got, "k", "label") == [(None, "?"), ("x", "X"), ("y", "?")]
    bounded = lookup(df, dim, "k", "key", ["label"], bounded=True)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastHashJoin" in bounded._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salted_join_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F

    from planpulse.operators import salted_join
    big = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    frame = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_join(big, frame, "k", ["id"], salts=8)
        assert rows(out.select("id", "v")) == rows(big.join(frame, "k").select("id", "v"))
        left = salted_join(big, frame, "k", ["id"], salts=4, how="left")
        assert left.count() == 4000
        tasks = out.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") >= 1 and tasks >= 1
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert out.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count() > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_visits_and_plans_join_the_entity_once(spark):
    """With broadcasts off, only one join has the visits (or plans) and the entity frame."""
    import datetime as dt

    from planpulse.bindings import queries as Q
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for fn in (Q.q_visits_first_repeat, Q.q_plan_cycle_simple, Q.q_plan_cycle):
            plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
            assert sum("_salt" in x and "Join" in x for x in plan.splitlines()) == 1, fn.__name__

    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("ids", ["bigint", "string"])
def test_history_of_a_hot_day_is_ranked_in_ranges(spark, ids):
    """A third of all plans on one (entity, day): equal to plain windows, spread over several tasks."""
    from planpulse.operators.history import plan_history
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("e"), F.col("id") % 40)).alias("e"),
        F.when(F.col("id") % 3 == 0, F.lit("2026-01-05")).when(F.col("id") % 7 > 0, F.concat(F.lit("2026-01-0"), F.col("id") % 7))
         .cast("date").alias("s"),
        F.when(F.col("id") % 11 > 0, F.date_add(F.lit("2026-02-01").cast("date"), (F.col("id") % 50).cast("int"))).alias("d"),
        (F.col("id") * 7919 % 3001).cast(ids).alias("p"))
    df = df.unionByName(spark.createDataFrame([("hot", d, None, None) for d in (D(2026, 1, 4), D(2026, 1, 6))], "e string, s date, d date, p string")
                        .withColumn("p", F.lit("5").cast(ids)))
    w = Window.partitionBy("e").orderBy(F.asc_nulls_last("s"), F.asc_nulls_last("p"))
    days = Window.partitionBy("e").orderBy(F.asc_nulls_last("s"))
    want = df.select("e", "s", "d", "p", F.row_number().over(w).alias("seq"), F.count(F.lit(1)).over(days).alias("running_count"),
                     F.lag("s").over(w).alias("prev_start"), F.lag("d").over(w).alias("prev_due"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = plan_history(df, "e", "s", "d", "p", split=100)
        assert rows(got, *want.columns) == rows(want)
        placed = got.filter("e = 'hot'").select("seq", "prev_due", F.spark_partition_id().alias("task"))
        tasks = placed.groupBy("task").agg(F.count("seq").alias("n"), F.max("seq"), F.max("prev_due")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(tasks) > 4 and max(r.n for r in tasks) < 500


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_history_of_ordinary_entities_needs_no_slots_or_ranges(spark):
    """Entities of few plans: bucket counts, day rows by entity and by day, plans by day; nothing of the carried ranks runs."""
    df = spark.range(2000).select((F.col("id") % 300).alias("e"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("s"),
                                  F.lit("2026-05-01").cast("date").alias("d"), F.col("id").alias("p"))
    got = plan_history(df, "e", "s", "d", "p")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _final_plan(got).count("Exchange hashpartitioning") <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(got) == rows(plan_history(df, "e", "s", "d", "p", split=3), *got.columns)


def test_salted_join_repeats_the_frame_for_hot_keys_only(spark, monkeypatch):
    """Keys of ``counted``'s hot buckets are salted, others are joined as they are; NULL keys stay in a left join."""
    from planpulse.operators import joins, skew
    monkeypatch.setattr(joins, "hot_buckets", lambda df, key: skew.hot_buckets(df, key, 500))
    big = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    frame = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for how in ("inner", "left"):
            out = joins.salted_join(big, frame, "k", ["id"], how=how, counted=big)
            assert rows(out.select("id", "v")) == rows(big.join(frame, "k", how).select("id", "v"))
        assert out.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count() > 2
        assert out.filter("k = 1").select(F.spark_partition_id().alias("p")).distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
