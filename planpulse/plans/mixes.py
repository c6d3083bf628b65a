"""Duration mix, source mix and the branch metric table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse import constants as K
from planpulse.functions.dates import as_date
from planpulse.functions.numbers import cents, clamp_low, from_cents, money, ratio_pct, to_whole
from planpulse.functions.text import duration_label, source_rule
from planpulse.operators.grouping import ordered_labels
from planpulse.plans.scorecards import report_periods


def duration_mix(plans: DataFrame, as_of: dt.date, branches: Sequence[str] | DataFrame,
                 preferred: Sequence[int] = K.PREFERRED_DURATIONS) -> DataFrame:
    """New plans by duration bucket, branch and period, with a Total column (C14).

    Duration = the entity's total service months, NULL or below 1 -> 1 (trap
    T12: whole history, as in the original).  Buckets are those present among
    *all* new plans; periods are yesterday and month-to-date; every (bucket,
    branch, period) is present, zero when empty.  ``branches`` is the report's
    branch list, or a frame whose first column has the branches: the grid then
    takes them as an array computed by Spark (a scalar subquery), the driver
    never sees them.  Total sums those branches only.
    ``label_rank`` orders the buckets: listed durations first, then the rest.
    """
    periods = {k: v for k, v in report_periods(as_of).items() if k in ("yesterday", "mtd")}
    if isinstance(branches, DataFrame):
        listed = branches.agg(F.coalesce(F.array_sort(F.collect_set(branches.columns[0])), F.array().cast("array<string>"))).scalar()
    else:
        listed = F.array(*[F.lit(b) for b in branches]).cast("array<string>")
    npd = plans.filter(F.col("plan_type") == "New Plan") \
        .withColumn("duration_months", clamp_low(F.col("total_service_months"), 1).cast("bigint"))
    # One pass over the new plans: each row is tagged with its periods plus an
    # "_all" marker, so the bucket list (all data) and the period counts come
    # out of the same partial aggregate.
    tags = F.array(*[F.when(F.col("start_date").between(as_date(d1), as_date(d2)), F.lit(p))
                     for p, (d1, d2, _) in periods.items()], F.lit("_all"))
    agg = npd.select("duration_months", "branch", F.explode(F.array_compact(tags)).alias("period"),
                     cents(money("amount")).alias("amount_cents")) \
        .groupBy("duration_months", "period", "branch") \
        .agg(F.count(F.lit(1)).alias("plan_count"), F.sum("amount_cents").alias("amount_cents"))
    buckets = agg.filter(F.col("period") == "_all").select("duration_months").distinct()
    by_branch = agg.filter((F.col("period") != "_all") & F.array_contains(listed, F.col("branch")))
    total = by_branch.groupBy("duration_months", "period") \
        .agg(F.sum("plan_count").alias("plan_count"), F.sum("amount_cents").alias("amount_cents")) \
        .withColumn("branch", F.lit(K.TOTAL_LABEL))
    counts = by_branch.unionByName(total).withColumnRenamed("branch", "scope")
    grid = buckets.withColumn("period", F.explode(F.array(*[F.lit(p) for p in periods]))) \
        .withColumn("scope", F.explode(F.concat(listed, F.array(F.lit(K.TOTAL_LABEL)))))
    out = grid.join(counts, ["duration_months", "period", "scope"], "left")
    out = ordered_labels(out, "duration_months", list(preferred), out="label_rank")
    return out.select("duration_months", duration_label("duration_months").alias("duration_label"),
                      "label_rank", "period", "scope",
                      F.coalesce(F.col("plan_count"), F.lit(0)).cast("bigint").alias("plan_count"),
                      to_whole(from_cents(F.coalesce(F.col("amount_cents"), F.lit(0)))).alias("amount"))


#: A table with more branches than this is no report; the long form has no bound.
MOST_COLUMNS = 500


def duration_table(mix: DataFrame, branches: DataFrame, period: str, most: int = MOST_COLUMNS) -> DataFrame:
    """The wide cross-tab of ``duration_mix``: a row per bucket, a column per branch, and Total.

    Column names are part of a plan, so the branch labels (first column of ``branches``,
    distinct) come to the driver, ``most`` at the most; more raise an error.  Columns
    stand in label order, rows keep ``label_rank`` and ``duration_months`` to sort by.
    """
    label = branches.columns[0]
    names = [r[0] for r in branches.select(label).distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} branches: use the long form")
    wide = mix.filter(F.col("period") == period).groupBy("label_rank", "duration_months", "duration_label") \
              .pivot("scope", [*sorted(names), K.TOTAL_LABEL]).agg(F.sum("plan_count"))
    return wide.fillna(0)


def source_mix(visits: DataFrame, plans: DataFrame, d1: dt.date, d2: dt.date,
               order: Sequence[str] = K.SOURCE_ORDER, source_col: str = "entity_source",
               rule=source_rule) -> DataFrame:
    """Per normalised lead source: visits, suggestions, plans and conversion %.

    Every listed source appears (zeros when absent), then other sources, then
    'Unknown' if present (``label_rank``); a Total row (``is_total``) sums the
    columns and recomputes the ratio.  Display order: not total first, then
    total visits descending, then the label.
    """
    lo, hi = as_date(d1), as_date(d2)
    v = visits.filter(F.col("visit_date").between(lo, hi)).select(
        rule(F.col(source_col)).alias("source"),
        (F.col("opd_status") == "NEW OPD").cast("int").alias("new_visits"),
        (F.col("opd_status") == "OLD OPD").cast("int").alias("old_visits"),
        F.coalesce((F.col("is_suggest") == "Yes").cast("int"), F.lit(0)).alias("suggested"),
        *[F.lit(0).alias(c) for c in ("new_plans", "renewals", "revivals")])
    p = plans.filter(F.col("start_date").between(lo, hi)).select(
        rule(F.col(source_col)).alias("source"),
        *[F.lit(0).alias(c) for c in ("new_visits", "old_visits", "suggested")],
        (F.col("plan_type") == "New Plan").cast("int").alias("new_plans"),
        (F.col("plan_type") == "Renewal").cast("int").alias("renewals"),
        (F.col("plan_type") == "Revival").cast("int").alias("revivals"))
    cols = ["new_visits", "old_visits", "suggested", "new_plans", "renewals", "revivals"]
    facts = v.unionByName(p)
    listed = facts.sparkSession.createDataFrame([(s,) for s in order], "source string")
    for c in cols:
        listed = listed.withColumn(c, F.lit(0))
    facts = facts.unionByName(listed)
    g = facts.groupingSets([["source"], []], "source") \
        .agg(*[F.sum(c).cast("bigint").alias(c) for c in cols], F.grouping("source").alias("_t"))
    g = g.withColumn("is_total", F.col("_t") == 1) \
         .withColumn("source", F.when(F.col("is_total"), F.lit(K.TOTAL_LABEL)).otherwise(F.col("source")))
    g = ordered_labels(g, "source", list(order), last=[K.UNKNOWN_LABEL], out="label_rank")
    g = g.withColumn("label_rank", F.when(F.col("is_total"), F.lit(len(order) + 3))
                     .otherwise(F.col("label_rank")))
    return g.select("source", *cols,
                    (F.col("new_visits") + F.col("old_visits")).alias("total_visits"),
                    ratio_pct("new_plans", "new_visits").alias("conversion_pct"),
                    "label_rank", "is_total")


def order_source_mix(mix: DataFrame) -> DataFrame:
    """Display order of the source mix (O3): rows by total visits descending, the label as
    tie-break (the original's sort was unstable), the Total row pinned last."""
    return mix.orderBy(F.col("is_total").asc(), F.col("total_visits").desc(), F.col("source").asc())


def branch_metric_table(metrics: DataFrame, best: DataFrame,
                        graph_metrics: Sequence[str] = K.GRAPH_METRICS) -> DataFrame:
    """Month-to-date value per scope, metric and span with the best month and attainment.

    Spans: ``same`` compares with the best month up to the same working day, ``full`` with
    the best whole month.  Scopes are the branches and Overall, plus Total = the sum over
    branches, of the values and of the branches' bests (which has no one month, so no label).
    Attainment = round-half-even(achieved / best x 100), 0 when best is 0.
    """
    m = metrics.filter((F.col("period") == "mtd") & F.col("metric").isin(list(graph_metrics))) \
        .select("scope", "metric", F.col("value").alias("achieved"))
    spans = F.array(*[F.lit(s) for s in ("same", "full")])
    out = m.withColumn("span", F.explode(spans)) \
        .join(best.select("scope", "metric", "span", "best_value", "best_label"), ["scope", "metric", "span"], "left") \
        .withColumn("best_value", F.coalesce("best_value", F.lit(0.0))).withColumn("best_label", F.coalesce("best_label", F.lit("")))
    total = out.filter(F.col("scope") != K.OVERALL_LABEL).groupBy("metric", "span") \
        .agg(F.sum("achieved").alias("achieved"), F.sum("best_value").alias("best_value")) \
        .withColumn("scope", F.lit(K.TOTAL_LABEL)).withColumn("best_label", F.lit(""))
    out = out.unionByName(total)
    att = F.when(F.col("best_value") > 0,
                 F.bround(F.col("achieved") / F.col("best_value") * 100.0, 0)).otherwise(F.lit(0.0))
    return out.withColumn("attainment_pct", att.cast("bigint"))
