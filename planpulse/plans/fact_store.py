"""Daily metric facts kept up to date (C9, C12): a folder per day, rewritten only where it changed.

The facts behind the reports are counts and sums per (branch, metric, day), so a change of
the inputs changes few days.  The store keeps them below ``path``::

    versions/<version>/fact_day=<day>/   rows of one day (Active: of one month's snapshot)
    commits/                             version, batch, fact_day, rows: one file per refresh

A day's rows are those of the newest version that names it.  A refresh writes the days it
touches to a fresh folder and then one commit file, so readers see all of it or none; a
refresh that dies leaves an unused folder, and one run again under its batch name does
nothing if it had been committed.  One writer at a time.

Days are listed on the driver: calendar days with facts, whatever the data's size.  Beside
the days there are ``none`` (facts without a date) and ``branches`` (a row per branch of a
listed frame, over all days), from which a reader of a few days still has the report's
whole branch list (A17).
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planpulse.session import materialize

KEYS = ("branch", "metric", "day", "month", "listed")
SUMS = ("n", "amount_cents", "rows", "paid")
ROWS = ("branch string, metric string, day date, month date, listed boolean, "
        "n double, amount_cents bigint, rows bigint, paid bigint")
COMMITS = "version string, batch string, fact_day string, rows bigint"
NO_DAY, BRANCHES = "none", "branches"


def fact_rows(facts: DataFrame) -> DataFrame:
    """``scorecards.metric_facts`` summed per (branch, metric, day, month, listed).

    ``rows`` and ``paid`` count the facts and their amounts, so that a day from which the
    last fact (or amount) is taken away can be told from one whose sum is zero.
    """
    return facts.groupBy(*KEYS).agg(
        F.sum("n").alias("n"), F.sum("amount_cents").cast("bigint").alias("amount_cents"),
        F.count(F.lit(1)).alias("rows"), F.count("amount_cents").alias("paid"))


def _fact_day() -> Column:
    return F.when(F.col("metric") == "", F.lit(BRANCHES)) \
            .otherwise(F.coalesce(F.coalesce("day", "month").cast("string"), F.lit(NO_DAY)))


def _summed(rows: DataFrame) -> DataFrame:
    out = rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    return out.withColumn("amount_cents", F.when(F.col("paid") != 0, F.col("amount_cents")))


def difference(after: DataFrame, before: DataFrame) -> DataFrame:
    """What to add to ``before`` (``fact_rows``) to get ``after``; rows that agree are left out."""
    minus = before.select(*KEYS, *[(-F.col(c)).alias(c) for c in SUMS])
    both = after.select(*KEYS, *SUMS).unionByName(minus).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    changed = [F.coalesce(F.col(c), F.lit(0)) != 0 for c in SUMS]
    return both.filter(changed[0] | changed[1] | changed[2] | changed[3])


def _with_branches(rows: DataFrame) -> DataFrame:
    """Days' rows and, for each branch of a listed frame, one row over all of them."""
    seen = rows.filter("listed").groupBy("branch").agg(F.sum("rows").alias("rows")).filter("rows <> 0")
    marks = seen.select("branch", F.lit("").alias("metric"), F.lit(None).cast("date").alias("day"),
                        F.lit(None).cast("date").alias("month"), F.lit(True).alias("listed"), F.lit(0.0).alias("n"),
                        F.lit(None).cast("bigint").alias("amount_cents"), "rows", F.lit(0).cast("bigint").alias("paid"))
    return rows.select(*KEYS, *SUMS).unionByName(marks)


class FactStore:
    """The daily facts below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------------ reading
    def commits(self) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).json(f"{self.path}/commits")

    def current(self) -> DataFrame:
        """``fact_day, version, rows``: where each day's rows are (0 rows: nowhere)."""
        return self.commits().groupBy("fact_day").agg(F.max(F.struct("version", "rows")).alias("_v")) \
                   .select("fact_day", "_v.version", "_v.rows")

    def _read(self, days: Column) -> DataFrame:
        found = self.current().filter(days & (F.col("rows") > 0)).collect()
        paths = [f"{self.path}/versions/{r.version}/fact_day={r.fact_day}" for r in found]
        if not paths:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*paths)

    def read_all(self) -> DataFrame:
        """All days' rows, without the branch marks."""
        return self._read(F.col("fact_day") != BRANCHES)

    def read(self, first: dt.date, last: dt.date) -> DataFrame:
        """Facts from ``first`` to ``last``, as ``scorecards.daily_facts`` gives them; opens no other day.

        The branch marks come with them: they only count for the list of branches.
        """
        day = F.col("fact_day")
        return self._read((day == BRANCHES) | day.between(first.isoformat(), last.isoformat())) \
                   .select(*KEYS, "n", "amount_cents")

    # ------------------------------------------------------------------ writing
    def apply(self, before: DataFrame, after: DataFrame, batch: str) -> list[str]:
        """Take ``before`` out and put ``after`` in (``fact_rows`` of what a batch changed).

        Both may be limited to the entities with new or late rows (``daily.entity_slice``):
        other entities' facts cancel out anyway.  Only days on which they differ are read and
        rewritten.  Returns these days; none if the batch is already in.
        """
        if self.commits().filter(F.col("batch") == batch).take(1):
            return []
        return self._add(difference(after, before), batch)

    def sync(self, rows: DataFrame, batch: str) -> list[str]:
        """Make the store equal ``rows`` (all facts), rewriting only the days that differ."""
        return self._add(difference(rows, self.read_all()), batch)

    def _add(self, delta: DataFrame, batch: str) -> list[str]:
        delta = materialize(_with_branches(delta).withColumn("fact_day", _fact_day()))
        days = sorted(r.fact_day for r in delta.select("fact_day").distinct().collect())
        if not days:
            return []
        old = self._read(F.col("fact_day").isin(days))
        new = materialize(_summed(old.unionByName(delta.drop("fact_day"))).filter("rows <> 0")
                          .withColumn("fact_day", _fact_day()))
        if new.filter("rows < 0").take(1):
            raise ValueError("more facts are taken out than the store holds: 'before' is not what it was built from")
        version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        new.repartition("fact_day").write.partitionBy("fact_day").parquet(f"{self.path}/versions/{version}")
        counts = new.groupBy("fact_day").agg(F.count(F.lit(1)).alias("rows"))
        touched = delta.select("fact_day").distinct().join(counts, "fact_day", "left")
        touched.select(F.lit(version).alias("version"), F.lit(batch).alias("batch"), "fact_day",
                       F.coalesce("rows", F.lit(0)).alias("rows")) \
               .coalesce(1).write.mode("append").json(f"{self.path}/commits")
        return days
