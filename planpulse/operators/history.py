"""Per-entity plan history: sequence number, running count, previous plan.

A plain ``Window.partitionBy(entity)`` sends every plan of an entity to one
task, so one entity (or one entity and day) holding a third of all rows would
make one task sort a third of the data.  Entities whose hash bucket holds at most ``split``
plans (``operators.skew``) are not hot: their plans are collapsed to day rows, the window per
entity runs over these, and plans join their day and are ranked in it.  The history of the
others is computed by carried ranks:

1. plans are collapsed to one row per (entity, start day, slot), the slot a hash
   of the tie-break, with a partial (map-side) aggregate: count, last plan, and
   one plan drawn at random (the one of greatest hash);
2. the slots of a day add up to its count and last plan; the window per entity
   runs over these day rows, whose number the calendar bounds;
3. a day of more than ``split`` plans is cut at the tie-breaks drawn from its
   slots into ranges of nearly equal size; counts and last plans of the ranges
   give each the rank it starts from and the plan before its first;
4. plans join their day on (entity, day, slot) -- a hot day is spread by its
   slots -- and a window over (entity, day, range) ranks the plans of a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from planpulse.operators.skew import HOT_ROWS, bucket, hot_buckets

SLOTS = 64


def plan_history(plans: DataFrame, entity: str, start: str, due: str, tiebreak: str,
                 prefix: str = "", split: int = HOT_ROWS) -> DataFrame:
    """Add ``seq``, ``running_count``, ``prev_start``, ``prev_due`` to each plan.

    Order within an entity: ``start`` ascending with NULLs last (PostgreSQL's
    default), then ``tiebreak`` ascending (NULLs last).

    * ``seq``: ``ROW_NUMBER()`` in that order (W2);
    * ``running_count``: ``COUNT(*) OVER (ORDER BY start)`` with the default
      RANGE frame, so plans on the same day share the value (W3);
    * ``prev_start`` / ``prev_due``: ``LAG`` of start and due (W4, W5).

    ``split`` only divides the work: entities in buckets of more plans go by slots and ranges,
    a day of more plans is ranked in ranges.  Plans that share a tie-break fall into one range.
    """
    hot = hot_buckets(plans.select(entity), entity, split)
    marked = plans.withColumn("_bucket", bucket(entity))
    cool = marked.join(hot, "_bucket", "left_anti").select(*plans.columns)
    rest = marked.join(hot, "_bucket", "left_semi").select(*plans.columns)
    return _by_days(cool, entity, start, due, tiebreak, prefix) \
        .unionByName(_by_ranges(rest, entity, start, due, tiebreak, prefix, split))


def _by_days(plans: DataFrame, entity: str, start: str, due: str, tiebreak: str, prefix: str) -> DataFrame:
    """The history where no entity is hot: day rows and plans meet without slots or ranges."""
    none = F.col(tiebreak).isNull()
    # Spread by entity, the day rows are aggregated and run through the window where they are.
    days = plans.select(entity, start, due, tiebreak).repartition(entity).groupBy(entity, start).agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(F.col(due), F.col(tiebreak)).alias("_due"), F.max(none).alias("_none"),
        F.max(F.when(none, F.col(due))).alias("_none_due"))
    days = days.withColumn("_last_due", F.when(F.col("_none"), F.col("_none_due")).otherwise(F.col("_due")))
    by_entity = Window.partitionBy(entity).orderBy(F.col(start).asc_nulls_last())
    before = by_entity.rowsBetween(Window.unboundedPreceding, -1)
    day = F.struct(entity, start)
    days = days.select(day.alias("_day"), "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                       F.lag(start).over(by_entity).alias("_prev_day"), F.lag("_last_due").over(by_entity).alias("_prev_day_due"))
    within = Window.partitionBy("_day").orderBy(F.col(tiebreak).asc_nulls_last())
    ranked = plans.withColumn("_day", day).join(days, "_day").withColumns(
        {"_k": F.row_number().over(within), "_prev_in_day": F.lag(due).over(within)})
    first = F.col("_k") == 1
    return ranked.select(
        *plans.columns, (F.col("_before") + F.col("_k")).cast("bigint").alias(prefix + "seq"),
        (F.col("_before") + F.col("_n")).cast("bigint").alias(prefix + "running_count"),
        F.when(first, F.col("_prev_day")).otherwise(F.col(start)).alias(prefix + "prev_start"),
        F.when(first, F.col("_prev_day_due")).otherwise(F.col("_prev_in_day")).alias(prefix + "prev_due"))


def _by_ranges(plans: DataFrame, entity: str, start: str, due: str, tiebreak: str, prefix: str, split: int) -> DataFrame:
    """The history by carried ranks."""
    drawn = F.xxhash64(F.col(tiebreak).cast("string"))
    slot = F.pmod(drawn, F.lit(SLOTS)).cast("int")
    none = F.col(tiebreak).isNull()     # missing tie-breaks come last, like in the window's order
    last = F.struct(none.alias("none"), F.col(tiebreak).alias("id"), F.col(due).alias("due"))
    slots = plans.groupBy(entity, start, slot.alias("_slot")).agg(
        F.count(F.lit(1)).alias("_n"), F.max(tiebreak).alias("_id"), F.max_by(F.col(due), F.col(tiebreak)).alias("_due"),
        F.max(none).alias("_none"), F.max(F.when(none, F.col(due))).alias("_none_due"),
        F.max_by(F.col(tiebreak), F.xxhash64(drawn)).alias("_drawn"))
    days = slots.groupBy(entity, start).agg(
        F.sum("_n").alias("_n"), F.max_by("_due", "_id").alias("_due"), F.max("_none").alias("_none"),
        F.max("_none_due").alias("_none_due"), F.array_sort(F.collect_list("_drawn")).alias("_cuts"))
    days = days.withColumn("_last_due", F.when(F.col("_none"), F.col("_none_due")).otherwise(F.col("_due")))
    by_entity = Window.partitionBy(entity).orderBy(F.col(start).asc_nulls_last())
    before = by_entity.rowsBetween(Window.unboundedPreceding, -1)
    # Keys are structs: equal also where a part is NULL, and hashed alike by joins and windows.
    day, e, s = F.struct(entity, start), F.col(entity), F.col(start)
    days = days.select(
        day.alias("_day"), "_n", F.when(F.col("_n") > split, F.col("_cuts")).alias("_cuts"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.lag(start).over(by_entity).alias("_prev_day"), F.lag("_last_due").over(by_entity).alias("_prev_day_due"))
    days = slots.select(day.alias("_day"), F.struct(e, s, F.col("_slot")).alias("_at")).join(days, "_day").drop("_day")
    of_range = F.when(F.col("_cuts").isNull(), F.lit(0)).when(F.col(tiebreak).isNull(), F.size("_cuts")) \
                .otherwise(F.size(F.filter("_cuts", lambda c: c <= F.col(tiebreak))))
    joined = plans.withColumn("_at", F.struct(e, s, slot.alias("_slot"))).join(days, "_at", "inner").drop("_at") \
                  .withColumn("_range", F.struct(e, s, of_range.alias("_range")))
    ranges = joined.filter("_cuts IS NOT NULL").groupBy("_range").agg(F.count(F.lit(1)).alias("_m"), F.max(last).alias("_l"))
    earlier = Window.partitionBy(*[F.col("_range")[F.lit(c)] for c in (entity, start)]).orderBy(F.col("_range")["_range"])
    ranges = ranges.select(
        "_range", F.coalesce(F.sum("_m").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_carried"),
        F.lag("_l.due").over(earlier).alias("_carried_due"))
    within = Window.partitionBy("_range").orderBy(F.col(tiebreak).asc_nulls_last())
    ranked = joined.join(ranges, "_range", "left").withColumns({
        "_k": F.row_number().over(within), "_prev_in_range": F.lag(due).over(within), "_carried": F.coalesce("_carried", F.lit(0))})
    first_of_range, first_of_day = F.col("_k") == 1, F.col("_k") + F.col("_carried") == 1
    out = ranked.withColumns({
        prefix + "seq": (F.col("_before") + F.col("_carried") + F.col("_k")).cast("bigint"),
        prefix + "running_count": (F.col("_before") + F.col("_n")).cast("bigint"),
        prefix + "prev_start": F.when(first_of_day, F.col("_prev_day")).otherwise(F.col(start)),
        prefix + "prev_due": F.when(first_of_day, F.col("_prev_day_due")).when(first_of_range, F.col("_carried_due"))
                              .otherwise(F.col("_prev_in_range")),
    })
    return out.select(*plans.columns, *[prefix + c for c in ("seq", "running_count", "prev_start", "prev_due")])
