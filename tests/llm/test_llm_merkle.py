"""The manifest against a plain tree over all rows, and the query against SQL."""

import hashlib
import zlib

import pytest
from llm_cases import awkward, empty
from planpulse.llm.merkle import manifest
from pyspark.sql import functions as F


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes):
    """All levels of the tree over ``nodes``."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def beside(tree, i):
    for nodes in tree[:-1]:
        a = i // 8 * 8
        yield nodes[a:i], nodes[i + 1:a + 8]
        i //= 8


def plain(rows):
    trees = {}
    for r in rows:
        doc_id, source, lang, n_chars, text = r
        leaf = h(*map(field, r))
        changed = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            changed = h(*map(field, (doc_id, source, lang, n_chars, text.encode().lower().decode())))
        trees.setdefault(b"" if lang is None else b"=" + lang.encode(), []).append(
            ((doc_id is not None, doc_id or 0), leaf, changed))
    langs = sorted(trees)
    inner = {k: climb([x[1] for x in sorted(trees[k])]) for k in langs}
    top = climb([inner[k][-1][0] for k in langs])
    out = []
    for j, k in enumerate(langs):
        for i, ((_, doc_id), leaf, node) in enumerate(sorted(trees[k])):
            steps = [*beside(inner[k], i), *beside(top, j)]
            for before, after in steps:
                node = h(*before, node, *after)
            proof = h(*(x for before, after in steps for x in (*before, *after)))
            out.append((doc_id, leaf, inner[k][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out)


COLS = ("doc_id", "source", "lang", "n_chars", "text")


def check(df, block):
    out = manifest(df, block=block)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((r.doc_id or 0, *r[1:]) for r in out.collect())
    assert got == plain([tuple(r) for r in df.select(*COLS).collect()])
    return got


@pytest.mark.parametrize("block", [8, 4096])
def test_awkward_rows(spark, block):
    check(awkward(spark), block)


def test_several_rounds_and_many_languages(spark):
    """Blocks of 8: four rounds in one language, 70 languages, runs of one node, ids beyond 2^53 beside null."""
    big = [(2 ** 60 + i if i else None, "s", "en", i, f"Text {i}") for i in range(4097)]
    small = [(i, None, None if i % 71 == 0 else f"l{i % 71}", None, f"T{i}") for i in range(800)]
    got = check(spark.createDataFrame(big + small, "doc_id bigint, source string, lang string, n_chars bigint, text string"), 8)
    assert len({x[2] for x in got}) == 72 and {x[-1] for x in got} == {True, False}


def test_few_rows(spark):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    for n in (1, 2, 9):
        check(spark.createDataFrame([(i, "s", "en", 1, "A") for i in range(n)], schema), 8)
    assert manifest(empty(spark)).collect() == []


def test_repeated_row_is_spread(spark):
    """A third of the rows repeat one row: its copies are counted, then dealt over blocks."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).cast("bigint").alias("n_chars"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("T"), "id")).alias("text"))
    check(df, 64)
