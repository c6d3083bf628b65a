"""Which keys may be hot, told by counts per hash bucket.

Keys are hashed into ``BUCKETS`` buckets and the buckets counted: a map-side partial
aggregate of at most ``BUCKETS`` rows a task, where counting the keys themselves would
shuffle a row per key.  A key of more than ``limit`` rows is always in a bucket of more than
``limit`` rows; what else falls there only takes the careful way without needing it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
HOT_ROWS = 100_000


def bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def hot_buckets(rows: DataFrame, key: str, limit: int = HOT_ROWS) -> DataFrame:
    """``_bucket``: those that more than ``limit`` of ``rows`` fall in, to be joined by broadcast (at most ``BUCKETS`` rows)."""
    n = rows.groupBy(bucket(key).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    return F.broadcast(n.filter(F.col("_n") > limit).select("_bucket"))
