"""Hand-kept CSV lookups: alias map, staff map, targets, assessments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from planpulse import constants as K
from planpulse import schemas as S
from planpulse.functions.text import recode, strip_ws


def _csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All-text CSV with a header; with ``schema``, its columns found by header (trimmed, any
    case, any order), NULL if the file has no such column."""
    # Empty fields stay '' (no NA inference), as the original read all text as is.
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE") \
               .option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    if schema is None:
        return raw
    have = {c.strip().lower(): c for c in raw.columns}
    return raw.select(*[_pick(have, [f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema])


def _one_per_key(df: DataFrame, keys: list[str], value: str, what: str) -> DataFrame:
    """One row per key.  Repeats that agree are merged; a conflicting repeat raises (trap T10)."""
    out = df.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("_most"),
                                F.count(F.when(F.col(value).isNull(), 1)).alias("_none"))
    clash = (F.col(value) != F.col("_most")) | (F.col(value).isNotNull() & (F.col("_none") > 0))
    conflicts = out.filter(clash).select(*keys).limit(5).collect()   # for the message only
    if conflicts:
        raise ValueError(f"{what} has conflicting rows for: {[tuple(r) if len(keys) > 1 else r[0] for r in conflicts]}")
    return out.drop("_most", "_none")


def load_alias_map(spark: SparkSession, path: str) -> DataFrame:
    """alias CSV (tech_name, final_name), both trimmed; one row per tech name.

    Repeated tech names are allowed only when they agree (trap T10); the
    table is checked when it is loaded and a conflicting repeat raises.
    """
    df = _csv(spark, path, S.ALIAS_MAP).select(
        strip_ws(F.coalesce(F.col("tech_name"), F.lit(""))).alias("tech_name"),
        strip_ws(F.coalesce(F.col("final_name"), F.lit(""))).alias("final_name"))
    return _one_per_key(df, ["tech_name"], "final_name", "alias map")


def load_staff_map(spark: SparkSession, path: str) -> DataFrame:
    """staff CSV (user_id, therapist_name) -> (staff_id trimmed text, staff_raw), one row per id (S3).

    The name is canonicalised later, with the same alias map as the others.  Repeats must agree.
    """
    df = _csv(spark, path, S.STAFF_MAP).select(strip_ws(F.col("user_id")).alias("staff_id"),
                                               F.col("therapist_name").alias("staff_raw"))
    return _one_per_key(df, ["staff_id"], "staff_raw", "staff map")


def load_targets(spark: SparkSession, path: str) -> DataFrame:
    """targets CSV (branch, category, target) -> (scope, category, target BIGINT), one row per key.

    Keys trimmed; an unparsable target is 0; repeats must agree; a missing file gives an
    empty frame with the same schema (the report then uses only derived targets).
    """
    try:
        df = _csv(spark, path, S.TARGETS)
    except AnalysisException:
        return spark.createDataFrame([], S.TARGETS_OUT)
    df = df.select(strip_ws(F.col("branch")).alias("scope"), strip_ws(F.col("category")).alias("category"),
                   F.coalesce(F.col("target").try_cast("double"), F.lit(0.0)).cast("bigint").alias("target"))
    return _one_per_key(df, ["scope", "category"], "target", "targets")


def _pick(cols_lower: dict[str, str], candidates) -> F.Column:
    for c in candidates:
        if c in cols_lower:
            return F.col(f"`{cols_lower[c]}`")
    return F.lit(None).cast("string")


#: Date spellings tried in this order; of 03/04/2026 the first that fits decides.
MONTH_FIRST = ("yyyy-MM-dd", "yyyy/MM/dd", "M/d/yyyy", "M-d-yyyy", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyyMMdd")
DAY_FIRST = ("yyyy-MM-dd", "yyyy/MM/dd", "d/M/yyyy", "d-M-yyyy", *MONTH_FIRST[4:])


def read_assessments(spark: SparkSession, path: str, center_map: dict[str, str] | None = None,
                     date_formats=MONTH_FIRST) -> DataFrame:
    """Hand-kept assessments table with every row: (date, center, assess_no, cost, date_text).

    Headers are matched lower-cased and trimmed; for each field the first
    listed spelling present wins, else the field is NULL.  Date, count and
    cost are coerced (bad -> NULL date / 0); the center is trimmed and
    recoded case-insensitively through ``center_map`` (unmatched kept).
    ``date_formats`` are tried in order (month first, as the original read
    them; ``DAY_FIRST`` for the other habit); a time after the date is ignored.
    """
    raw = _csv(spark, path)
    cols = {c.strip().lower(): c for c in raw.columns}
    date_txt = strip_ws(_pick(cols, K.ASSESSMENT_DATE_HEADERS))
    bare = F.regexp_replace(date_txt, r"[T ]\d{1,2}:\d{2}.*$", "")
    day = F.coalesce(*[F.try_to_date(bare, f) for f in date_formats])
    center = strip_ws(_pick(cols, K.ASSESSMENT_CENTER_HEADERS).cast("string"))
    if center_map:
        center = recode(center, center_map, ignore_case=True)
    return raw.select(
        day.alias("date"), center.alias("center"),
        F.coalesce(_pick(cols, K.ASSESSMENT_COUNT_HEADERS).try_cast("double"), F.lit(0.0)).alias("assess_no"),
        F.coalesce(_pick(cols, K.ASSESSMENT_COST_HEADERS).try_cast("double"), F.lit(0.0)).alias("cost"),
        date_txt.alias("date_text"))


def load_assessments(spark: SparkSession, path: str, center_map: dict[str, str] | None = None,
                     date_formats=MONTH_FIRST) -> DataFrame:
    """``read_assessments`` less the rows without a date (see ``unparsed_dates`` for those)."""
    return read_assessments(spark, path, center_map, date_formats).dropna(subset=["date"]).drop("date_text")


def unparsed_dates(spark: SparkSession, path: str, date_formats=MONTH_FIRST) -> DataFrame:
    """(date_text, rows): texts in the date column that no format reads, with their counts."""
    bad = read_assessments(spark, path, None, date_formats).filter(F.col("date").isNull() & (F.col("date_text") != ""))
    return bad.groupBy("date_text").agg(F.count(F.lit(1)).alias("rows"))
