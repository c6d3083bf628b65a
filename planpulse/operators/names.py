"""Canonical staff names through an alias table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planpulse.functions.text import clean_text, strip_ws


def canonical_names(df: DataFrame, col: str | Column, alias: DataFrame | None, out: str) -> DataFrame:
    """Add ``out``: the cleaned name (F9) mapped through ``alias`` (tech_name -> final_name).

    The match is case-sensitive and not chained; a mapped empty final name
    gives NULL; an unmapped name maps to itself.  ``alias`` must hold one
    row per tech name (``sources.lookups.load_alias_map`` guarantees it).
    The alias table is a hand-kept lookup: Spark's size estimate and AQE pick
    the broadcast, with a sort-merge join beyond the threshold.
    """
    src = F.col(col) if isinstance(col, str) else col
    df = df.withColumn("_clean", clean_text(src))
    if alias is None:
        return df.withColumnRenamed("_clean", out)
    a = alias.select(F.col("tech_name").alias("_tech"), F.col("final_name").alias("_final"))
    j = df.join(a, F.col("_clean") == F.col("_tech"), "left")
    final = strip_ws(F.col("_final"))
    name = F.when(F.col("_tech").isNotNull(),
                  F.when(final == "", F.lit(None).cast("string")).otherwise(final)) \
            .otherwise(F.col("_clean"))
    return j.withColumn(out, name).drop("_clean", "_tech", "_final")
