"""Base table scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from planpulse.schemas import TABLES


def load_tables(spark: SparkSession, path: str, names: Iterable[str] | None = None,
                fmt: str = "parquet", options: dict | None = None,
                skip_missing: bool = False) -> dict[str, DataFrame]:
    """Read the base tables with their declared schemas.

    ``path`` holds one folder (or file) per table, ``{path}/{name}``; for
    ``fmt="jdbc"`` pass connection ``options`` and the table name is used
    as ``dbtable``.  Nothing is read until an action: Catalyst prunes
    columns and pushes filters into each scan.  With ``skip_missing`` an
    absent table folder is left out instead of raising (optional inputs).
    """
    from pyspark.errors import AnalysisException
    names = list(names) if names is not None else list(TABLES)
    out = {}
    for n in names:
        reader = spark.read.options(**(options or {}))
        if fmt == "jdbc":
            out[n] = reader.format("jdbc").option("dbtable", n).load()
        else:
            try:
                out[n] = reader.schema(TABLES[n]).format(fmt).load(f"{path}/{n}")
            except AnalysisException:
                if not skip_missing:
                    raise
    return out
