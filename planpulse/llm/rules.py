"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Base counts are computed for every text.  Further rules are ordered by how many documents
they reject per unit of cost, both measured on a sample, and become one CASE expression:
a document that a rule rejects is not looked at by later, dearer ones.  The order decides
the cost only; a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planpulse.llm.common import pick, to_scratch

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
SAMPLE = 2000   # documents, about, that costs and selectivities are estimated on


@dataclass(frozen=True)
class Rule:
    """``rejects`` builds a boolean column from the text and the base columns."""

    name: str
    rejects: Callable[[], Column]


def _count(pattern: str) -> Column:
    return F.regexp_count("text", F.lit(pattern))


#: Default rules.  Thresholds are per word or per line, so they hold for any length.
RULES = [
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
    Rule("symbols", lambda: 10 * F.col("n_symbols") > 2 * F.col("n_words")),
    Rule("duplicate_lines", lambda: 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
    Rule("shouting", lambda: 2 * _count(r"\p{Lu}{2,}") > F.col("n_words")),
    Rule("exclamations", lambda: 10 * _count("!") > 5 * F.col("n_words")),
    Rule("few_letters", lambda: 2 * _count(r"\p{L}+") < F.col("n_words")),
]


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` (null as empty) with ``n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words, base_failed``.

    ``n_repeat_words`` counts the words that lie in an 8-word window which the text has
    twice or more.  Windows are 64-bit hashes built by doubling; only texts whose windows
    are not distinct sort them, so equal ones become neighbours, and add up the union of
    their spans: n log n at worst, in the text's length.
    """
    df = pick(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    df = df.withColumn("_trim", F.regexp_replace("text", rf"^{SPACE}|{SPACE}$", ""))
    df = df.withColumn("_words", F.when(F.col("_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_trim", SPACE)))
    df = df.withColumn("_lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.select("doc_id", "text", F.size("_words").cast("bigint").alias("n_words"),
                   F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
                   _count(r"[#*$%&|<>]").cast("bigint").alias("n_symbols"),
                   F.size("_lines").cast("bigint").alias("n_lines"),
                   (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
                   F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    step = 1
    while step < WINDOW:
        df = df.withColumn("_h", F.zip_with("_h", F.slice("_h", step + 1, F.greatest(F.size("_h"), F.lit(1))),
                                            lambda a, b: F.xxhash64(a, b)))
        step *= 2
    df = df.withColumn("_h", F.slice("_h", 1, F.greatest(F.col("n_words").cast("int") - (WINDOW - 1), F.lit(0))))
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn("_s", F.when(twice, F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("_h")

    def found_twice(x: Column, k: Column) -> Column:
        before, after = F.get(F.col("_s"), k - 1)["h"], F.get(F.col("_s"), k + 1)["h"]
        return F.when((before == x["h"]) | (after == x["h"]), x["i"])

    df = df.withColumn("_at", F.sort_array(F.filter(F.transform("_s", found_twice), lambda i: i.isNotNull()))).drop("_s")
    spans = F.zip_with("_at", F.slice("_at", 2, F.greatest(F.size("_at"), F.lit(1))),
                       lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))).cast("bigint"))
    covered = F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x)
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_at")
    return df.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def order_rules(docs: DataFrame, rules: list[Rule], sample: int = SAMPLE, id_col: str = "doc_id",
                text_col: str = "text") -> list[Rule]:
    """Order ``rules`` by rejections per second on a sample of about ``sample`` documents.

    One aggregate gives every rule's selectivity among texts that pass the base; a rule's
    cost is the time of an aggregate with it less one without.
    """
    share = min(1.0, sample / max(docs.count(), 1))
    drawn = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    some = to_scratch(base_counts(drawn, id_col, text_col), "sample").filter(~F.col("base_failed"))
    rejected = some.agg(*[F.count_if(r.rejects()).alias(f"r{i}") for i, r in enumerate(rules)]).first()

    def seconds(c: Column) -> float:
        t = time.perf_counter()
        some.agg(F.count_if(c), F.sum(F.octet_length("text"))).first()
        return time.perf_counter() - t

    floor = min(seconds(F.lit(False)) for _ in range(2))
    cost = [max(1e-4, seconds(r.rejects()) - floor) for r in rules]
    rank = sorted(range(len(rules)), key=lambda i: -(rejected[i] or 0) / cost[i])
    return [rules[i] for i in rank]


def cascade(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``rejected_by``: ``base``, the first of ``rules`` that rejects the text, or null."""
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for r in rules:
        verdict = verdict.when(r.rejects(), F.lit(r.name))
    return counted.withColumn("rejected_by", verdict)


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Every document with its base counts and ``kept``; the cascade runs in measured order.

    Null, empty and blank texts have no words and so fail the base.  Null ids and repeated
    rows are judged like any other; further columns are ignored; an empty table is fine.
    """
    rules = RULES if rules is None else rules
    ordered = order_rules(docs, rules, id_col=id_col, text_col=text_col)
    return cascade(base_counts(docs, id_col, text_col), ordered).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("rejected_by").isNull().alias("kept"))
