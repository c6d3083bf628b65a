"""Named result registry (S8): prepared results looked up by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class ResultRegistry:
    """Register DataFrames under names as temporary views; look them up by name.

    DataFrames are immutable, so a lookup needs no defensive copy; a missing
    name raises ``KeyError``.
    """

    def __init__(self, spark: SparkSession, prefix: str = "pp_"):
        self.spark = spark
        self.prefix = prefix
        self._names: set[str] = set()

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(self.prefix + name)
        self._names.add(name)
        return df

    def get(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(f"no result named {name!r}; have {sorted(self._names)}")
        return self.spark.table(self.prefix + name)

    def names(self) -> list[str]:
        return sorted(self._names)
