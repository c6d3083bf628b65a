"""Feed records since the first day of this month last year (C17)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse.functions.dates import as_date
from planpulse.functions.nested import iso_local_date, variant_text
from planpulse.sources.feed import feed_rows, parse_pages


def feed_cutoff(as_of: dt.date) -> dt.date:
    return dt.date(as_of.year - 1, as_of.month, 1)


def _flat(record: str) -> list:
    """The report's columns of a record."""
    return [F.coalesce(F.try_variant_get(record, "$.leadSource", "string"), F.lit("")).alias("lead_source"),
            F.date_format("_created", "yyyy-MM-dd").alias("created_at"),
            variant_text(F.try_variant_get(record, "$.package", "variant")).alias("package"),
            variant_text(F.try_variant_get(record, "$.assignments", "variant")).alias("assignments"),
            F.coalesce(F.try_variant_get(record, "$.monthsWithUs", "string"), F.lit("")).alias("months_with_us")]


def _created(record: str):
    # An element that is no object has no field.
    return iso_local_date(F.try_variant_get(record, "$.createdAt", "string"))


def feed_records(pages: DataFrame, as_of: dt.date, doc_col: str = "doc") -> DataFrame:
    """Flatten feed pages into report rows (C17).

    Non-object elements and records with a missing or unparsable creation
    time are skipped; records created before the cutoff are dropped (the
    original stopped paging there, which equals this filter only for
    newest-first input).  Nested fields become text (F21); missing fields
    become ''.
    """
    r = feed_rows(pages, doc_col).withColumn("_created", _created("record"))
    return r.filter(F.col("_created") >= as_date(feed_cutoff(as_of))).select(*_flat("record"))


#: Why a page or record is not in the report.
BROKEN_PAGE, NO_OBJECT, NO_DATE = "broken page", "no object", "no creation date"


def feed_sorted(pages: DataFrame, as_of: dt.date, doc_col: str = "doc") -> DataFrame:
    """The rows of ``feed_records`` with a null ``reason``, and what could not be read, with one.

    One reading of the pages for both: write it, then split it by ``reason`` (``daily``
    does).  ``raw`` is the page or the element as it came; a broken page is one row, so no
    bad page or record stops a job or is lost unseen.  Records before the cutoff are no
    rejects; they are in neither part.
    """
    data = F.col("_page.data")
    r = parse_pages(pages, doc_col).select(
        doc_col, data.isNull().alias("_broken"), F.explode(F.when(data.isNull(), F.array(F.lit(None).cast("variant"))).otherwise(data)).alias("record"))
    r = r.withColumn("_created", _created("record"))
    is_object = F.coalesce(F.schema_of_variant("record"), F.lit("")).startswith("OBJECT")
    reason = F.when(F.col("_broken"), F.lit(BROKEN_PAGE)).when(F.col("_created").isNotNull(), F.lit(None).cast("string")) \
              .when(is_object, F.lit(NO_DATE)).otherwise(F.lit(NO_OBJECT))
    raw = F.when(F.col("_broken"), F.col(doc_col)).when(F.col("_created").isNull(), F.coalesce(F.to_json("record"), F.lit("null")))
    kept = F.col("_created").isNull() | (F.col("_created") >= as_date(feed_cutoff(as_of)))
    return r.filter(kept).select(*_flat("record"), reason.alias("reason"), raw.alias("raw"))
