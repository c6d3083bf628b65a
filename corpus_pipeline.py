"""The corpus pipeline: quality, language, near-duplicates, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``.  All but
the last return the columns of ``documents``.  Columns other than the ones below may be
added to ``documents``; they are kept up to the last stage.

Each stage gives every row a defined result: null or empty texts are scored like any text
by the first stage, and the second drops what has no letter.  An empty table passes
through; without usable labels the first stage keeps every row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from planpulse.llm import langid, packing, quality, simhash
from planpulse.llm.common import to_scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the quality classifier rejects (score under 0.3) go."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), 0.3)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents go that have no letter or no language told with 0.3 or more."""
    return langid.keep_known(docs, langid.train(docs), 0.3)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of near-duplicates the document with the least id stays."""
    return simhash.keep_first(docs, shingle=4, radius=4)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the rest is cut and packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [("quality_classifier", quality_stage), ("language_id", language_stage),
          ("simhash_near_dedup", duplicate_stage), ("best_fit_packing", packing_stage)]

#: No SQL: models are fitted and packing is a search; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = to_scratch(stage(spark, docs, sf_dir), name)
    return docs
