"""Winnowed document fingerprints, in DataFrame functions only.

Tokens are runs without white space.  Of a run of more than 16 characters every character
is a token (``ROLLED``), so that hashes roll through unspaced text and an inserted character
changes only those around it; ``STRIDES`` cuts such runs every 16 characters from their
start instead, and nothing after an inserted character is shared.  Every ``K`` neighbouring
tokens have one hash, built by doubling (pairs, then pairs of pairs).  Of every ``W``
neighbouring hashes the least is chosen, the rightmost of equal ones; window minima are
found by doubling, too.  Two texts that share ``K + W - 1`` tokens in a row share a chosen
hash, and its positions say where.  Texts of fewer than K tokens have one hash of them all,
texts of fewer than W hashes one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planpulse.llm.common import in_order, pick, to_scratch

K, W = 4, 4   # powers of two
STRIDES = r"(\S{1,16})"
ROLLED = r"((?<!\S)\S{1,16}(?!\S)|\S)"
_LAST = 2**31 - 1


def _shift(a: str, by: int, f) -> Column:
    """f(x[i], x[i + by]); past the end the second is null."""
    return F.zip_with(a, F.slice(a, by + 1, F.greatest(F.size(a), F.lit(1))), f)


def with_fingerprint(df: DataFrame, text: str, out: str, tokens: str = STRIDES) -> DataFrame:
    """Add ``out``: an array of ``(pos, hash)`` in text order; null text counts as empty.

    A chosen entry is kept as 32 bits of hash above the mirrored position, so that the
    least entry is the least hash at its rightmost place.
    """
    n, h, v = f"_{out}_n", f"_{out}_h", f"_{out}_v"
    names = [c for c in df.columns if c != out]
    df = df.withColumn(h, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(tokens), 1))
    df = df.withColumn(n, F.size(h)).withColumn(
        h, F.when(F.col(n) >= K, F.transform(h, lambda w: F.xxhash64(w)))
            .when(F.col(n) > 0, F.array(F.xxhash64(F.array_join(h, " ")))).otherwise(F.array().cast("array<bigint>")))
    step = 1
    while step < K:
        df = df.withColumn(h, F.when(F.col(n) >= K, _shift(h, step, lambda a, b: F.xxhash64(a, b))).otherwise(F.col(h)))
        step *= 2
    df = df.withColumn(h, F.when(F.col(n) >= K, F.slice(h, 1, F.greatest(F.col(n) - (K - 1), F.lit(1)))).otherwise(F.col(h)))
    df = df.withColumn(v, F.transform(h, lambda x, i: F.shiftleft(x.bitwiseAND(F.lit(0xFFFFFFFF)), 31) + (F.lit(_LAST) - i)))
    step = 1
    while step < W:
        df = df.withColumn(v, _shift(v, step, lambda a, b: F.least(a, b)))
        step *= 2
    df = df.withColumn(v, F.array_distinct(F.slice(v, 1, F.greatest(F.size(v) - (W - 1), F.lit(1)))))

    def entry(x: Column) -> Column:
        pos = (F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST))).cast("int")
        return F.struct(pos.alias("pos"), F.get(F.col(h), pos).alias("hash"))

    return df.withColumn(out, F.transform(v, entry)).select(*names, out)


def as_string(fingerprint: str) -> Column:
    """``pos:hash`` of every entry, hashes as the low 32 bits in hex, in text order."""
    return F.array_join(F.transform(fingerprint, lambda e: F.concat(
        e["pos"].cast("string"), F.lit(":"), F.lower(F.hex(e["hash"].bitwiseAND(F.lit(0xFFFFFFFF)))))), " ")


def compared(fingerprint: str) -> Column:
    """The hashes of a fingerprint, 31 bits each, as they are compared within a pair of texts."""
    return F.transform(fingerprint, lambda e: e["hash"].bitwiseAND(F.lit(_LAST)).cast("int"))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two arrays; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def successors(ids: DataFrame) -> DataFrame:
    """Add ``next_id, next_hash`` to distinct rows ``doc_id, text_hash``: those of the next
    row in ascending order (null ids first), after the last those of the first.

    Rows are range partitioned and looked up inside their part; only the first row of each
    part is looked at across parts, so that table has a row per partition.
    """
    kept = in_order(ids, ["doc_id", "text_hash"], "ordered")
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_hash")]
    row = F.struct("doc_id", "text_hash")
    firsts = kept.groupBy("_part").agg(F.min(row).alias("first"))   # structs order nulls first, as the parts do
    across = Window.orderBy("_part")
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nexts = firsts.select("_part", F.coalesce(F.lead("first").over(across), F.first("first").over(whole)).alias("_after"))
    lead = F.lead(row).over(Window.partitionBy("_part").orderBy(*order))
    return kept.withColumn("_next", lead).join(F.broadcast(nexts), "_part") \
               .withColumn("_next", F.coalesce("_next", "_after")) \
               .withColumn("next_id", F.col("_next.doc_id")).withColumn("next_hash", F.col("_next.text_hash")) \
               .drop("_next", "_after", "_part")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: str = STRIDES) -> DataFrame:
    """``doc_id, fingerprint`` (array of ``pos, hash``) of every whole text."""
    return with_fingerprint(pick(docs, id_col, text_col), "text", "fingerprint", tokens).select("doc_id", "fingerprint")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: str = STRIDES) -> DataFrame:
    """Fingerprint every text and its edited text, whose last quarter comes from the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  Null text is empty.  Rows that share id and text are one document in the
    order, rows that share only the id follow one another by text hash; each row is
    returned.  An only document is its own next; an empty table gives an empty result.

    Texts are shuffled once, by id: that exchange serves both the heads that documents give
    to their predecessors (at most a quarter of the reader's length) and the documents that
    receive them.
    """
    base = pick(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("text_hash", F.xxhash64("text"))
    key = ["id", "none", "text_hash"]
    n_chars = F.char_length("text").cast("bigint").alias("n_chars")
    doc_id = F.when(~F.col("none"), F.col("id")).alias("doc_id")
    follow = successors(base.select(doc_id, "text_hash", n_chars).distinct())

    def keyed(i: str, h: str, out: str) -> list[Column]:
        return [F.coalesce(i, F.lit(0)).alias(f"{out}id"), F.col(i).isNull().alias(f"{out}none"), F.col(h).alias(f"{out}text_hash")]

    asks = to_scratch(follow.select(*keyed("doc_id", "text_hash", "for_"), *keyed("next_id", "next_hash", ""),
                                    F.floor(F.col("n_chars") / 4).cast("int").alias("take")), "asks")
    given = base.join(asks, key).select(*[f"for_{k}" for k in key], "text", "take")
    given = with_fingerprint(given, "text", "fp", tokens).select(
        *[F.col(f"for_{k}").alias(k) for k in key], F.expr("substring(text, 1, take)").alias("head"),
        compared("fp").alias("next_hashes"))
    # Repeated rows give the same head; the copies are next to each other after the shuffle that the join needs anyway.
    given = given.groupBy(*key).agg(F.any_value("head").alias("head"), F.any_value("next_hashes").alias("next_hashes"))
    got = base.join(given, key).withColumn("doc_id", doc_id)
    keep = F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 4) as int))")
    got = got.select("doc_id", "text", n_chars, "next_hashes", "head") \
             .select("doc_id", "text", "n_chars", "next_hashes", F.concat(keep, F.col("head")).alias("edited"))
    got = with_fingerprint(got, "text", "fp", tokens).drop("text")
    got = got.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    got = with_fingerprint(got, "edited", "edited_fp", tokens).drop("edited")
    got = got.withColumn("_own", compared("fp"))
    return got.select("doc_id", "n_chars", "edited_sha256", as_string("fp").alias("fingerprint"),
                      as_string("edited_fp").alias("edited_fingerprint"),
                      likeness(F.col("_own"), compared("edited_fp")).alias("near_edited"),
                      likeness(F.col("_own"), F.col("next_hashes")).alias("near_next"))
