"""Landed JSON feed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planpulse.schemas import FEED_PAGE


#: Where a landed page's file path says which page it is: the last number of the file's name.
PAGE_NUMBER = r"(\d+)[^/\d]*$"


def load_feed(spark: SparkSession, path: str, page_number: str = PAGE_NUMBER) -> DataFrame:
    """One row per landed page document: ``doc`` (text), ``chain``, ``page``.

    Pages are the API's responses saved as files (one JSON document per
    file); the original fetched them in a paging loop on one machine.
    ``page`` is what ``page_number`` finds in the file's path (NULL: nothing),
    ``chain`` the path before that match: one fetch of the feed.
    """
    read = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    file = F.input_file_name()
    return read.select(F.col("value").alias("doc"), F.regexp_replace(file, page_number + "|[^/]*$", "").alias("chain"),
                       F.regexp_extract(file, page_number, 1).try_cast("bigint").alias("page"))


def parse_pages(pages: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Add ``_page``: the parsed document, NULL in all fields if the text is no page."""
    return pages.withColumn("_page", F.from_json(F.col(doc_col), FEED_PAGE))


def feed_rows(pages: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Explode page documents into one VARIANT ``record`` per data element."""
    return parse_pages(pages, doc_col).select(F.explode(F.col("_page.data")).alias("record"))


def broken_pages(pages: DataFrame, doc_col: str = "doc") -> DataFrame:
    """The pages that give no rows because their text is truncated or has no data list.

    ``feed_rows`` cannot show them; a job counts or keeps these beside its result.
    """
    return parse_pages(pages, doc_col).filter(F.col("_page.data").isNull()).select(doc_col)


def chain_problems(pages: DataFrame, first: int = 1) -> DataFrame:
    """``chain, problem, page``: where the landed pages of a chain are not one whole fetch.

    A chain runs from page ``first`` to the first page whose ``meta.hasNextPage`` is not
    true (where the original stopped asking).  Problems: ``missing`` (the page is not there
    though the one before said there was one, or later ones are), ``endless`` (the last
    landed page promises another), ``after the end`` (a page beyond the end), ``repeated``
    (landed more than once; listed once) and ``unnumbered`` (no number in the file's path).
    A run of missing pages is listed by its first.  A broken page promises nothing, so what
    follows it is beyond the end.  Joins are on (chain, page); no task reads a whole chain.
    """
    more = F.coalesce(F.col("_page.meta.hasNextPage"), F.lit(False))
    p = parse_pages(pages).select("chain", F.col("page").cast("bigint").alias("page"), more.alias("more"))
    numbered = p.filter("page IS NOT NULL").groupBy("chain", "page").agg(F.max("more").alias("more"), F.count(F.lit(1)).alias("n"))
    ends = numbered.groupBy("chain").agg(F.max("page").alias("last"), F.min(F.when(~F.col("more"), F.col("page"))).alias("end"))
    starts = ends.select("chain", F.lit(first - 1).cast("bigint").alias("page"), F.lit(True).alias("more"))
    here = numbered.select("chain", F.col("page").alias("next"))
    nexts = numbered.select("chain", "page", "more").unionByName(starts).withColumn("next", F.col("page") + 1)
    open_ = nexts.join(here, ["chain", "next"], "left_anti").join(ends, "chain")
    broken_off = open_.filter((F.col("page") < F.col("last")) | F.col("more")) \
                      .select("chain", F.when(F.col("page") < F.col("last"), "missing").otherwise("endless").alias("problem"),
                              F.when(F.col("page") < F.col("last"), F.col("next")).otherwise(F.col("page")).alias("page"))
    after = numbered.join(ends, "chain").filter(F.col("page") > F.col("end"))
    return (broken_off
            .unionByName(after.select("chain", F.lit("after the end").alias("problem"), "page"))
            .unionByName(numbered.filter("n > 1").select("chain", F.lit("repeated").alias("problem"), "page"))
            .unionByName(p.filter("page IS NULL").groupBy("chain").agg(F.max("page").alias("page"))
                          .select("chain", F.lit("unnumbered").alias("problem"), "page")))
