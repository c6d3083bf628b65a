"""Collocations against plain counting; the query itself is compared with SQL."""

import random
import re
from collections import Counter, defaultdict

import pytest
from llm_cases import awkward, empty
from planpulse.llm.phrases import collocations, least_cut


def plain(rows, least, longest, top, share):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    f[lang][words[i:i + k]] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cand.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        found = []
        for p, a in cand.items():
            if inside[p] and 100 * inside[p] >= share * a:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def check(df, **args):
    args = {"least": 2, "longest": 5, "top": 50, "share": 100} | args
    out = collocations(df, **args)
    assert out.columns == COLS
    want = plain([(r.text, r.lang) for r in df.select("text", "lang").collect()], **args)
    assert sorted(map(tuple, out.collect())) == want
    return want


def test_awkward_rows(spark):
    assert check(awkward(spark))
    assert collocations(empty(spark)).collect() == []


@pytest.mark.parametrize("share", [100, 60])
def test_streams_over_many_parts(spark, share):
    """A hot first word, a repeated word, few kinds of words: stretches cross the borders of tasks."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        words = rng.choices(["the", "The", "of", "a", "é", "\x01", "a\x01", "\x00b", "b", "c-d", "z."], [8, 4, 4, 2, 1, 1, 1, 1, 2, 1, 3], k=40)
        rows.append((" ".join(words), rng.choice(["en", "en", "en", "de", "und", None, ""])))
    rows += [("x x x x x x x x x x x", "en")] * 40
    df = spark.createDataFrame(rows, "text string, lang string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        want = check(df, share=share, top=200)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(want) > 200


def test_ties_and_ranks(spark):
    rows = [("p q. r s. t u. p q. r s. t u.", "en"), (None, "en"), ("", None)]
    want = check(spark.createDataFrame(rows, "text string, lang string"), top=2)
    assert [(x[1], x[2]) for x in want] == [(1, "p q"), (2, "r s")]


def test_products_beyond_64_bits(spark):
    a, n, ls, rs = 9_000_000_000_007, 10 ** 16 + 1, [9 * 10 ** 15, 9 * 10 ** 14], [10 ** 15 + 3, 9_000_000_000_011]
    got = spark.createDataFrame([(a, n, ls, rs)], "a bigint, total bigint, ls array<bigint>, rs array<bigint>") \
               .select(least_cut().alias("x")).first().x
    cuts = [(1000 * a * n // (ls[k - 1] * rs[2 - k]), k, ls[k - 1], rs[2 - k]) for k in (1, 2)]
    assert (got.score, got.k, got.l, got.r) == min(cuts)
