import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_cases import awkward, empty
from planpulse.llm import packing

WORD = public_tokenizers.path("word_bpe_49k.json")


def fewest(lengths, capacity):
    """Brute force: try every assignment, first fit over all orders of small inputs."""
    best = len(lengths)
    for order in set(itertools.permutations(lengths)):
        bins = []
        for n in order:
            for i, b in enumerate(bins):
                if b + n <= capacity:
                    bins[i] += n
                    break
            else:
                bins.append(n)
        best = min(best, len(bins))
    return best


def test_bound_never_exceeds_the_optimum():
    rng = np.random.default_rng(2)
    for _ in range(60):
        lengths = rng.integers(1, 21, rng.integers(1, 8))
        best = fewest(lengths.tolist(), 20)
        bins, offsets, fills = packing.best_fit_decreasing(lengths, 20)
        assert packing.lower_bound(lengths, 20) <= best <= len(fills)


def test_bound_sees_more_than_the_mass():
    assert packing.lower_bound(np.array([11] * 5), 20) == 5          # mass alone says 3
    assert packing.lower_bound(np.array([7] * 6), 20) == 3
    assert packing.lower_bound(np.array([], np.int64), 20) == 0


def test_best_fit_takes_the_fullest_bin():
    bins, offsets, fills = packing.best_fit_decreasing(np.array([12, 15, 5, 8]), 20)
    assert bins[2] == bins[1] and bins[3] == bins[0]
    assert sorted(fills.tolist()) == [20, 20]


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in by.values():
        at = 0
        for offset, n in sorted(members):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("part_items", [40, 300, 100_000])
def test_exchange_saves_bins(spark, part_items):
    rng = np.random.default_rng(4)
    lengths = np.concatenate([rng.integers(1, 2049, 900), np.full(100, 2048), rng.integers(600, 1100, 400)])
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id bigint, length bigint")
    rows = packing.pack(items, 2048, part_items=part_items).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == [(i, n) for i, n in enumerate(lengths.tolist())]
    bins = check(rows, 2048)
    one = packing.pack(items, 2048, part_items=part_items, rounds=1).collect()
    assert packing.lower_bound(lengths, 2048) <= bins <= check(one, 2048)
    if part_items > 1400:
        assert bins <= len(packing.best_fit_decreasing(lengths, 2048)[2])


def test_ties_and_a_hot_length(spark):
    items = spark.createDataFrame([(1, 700)] * 500 + [(None, 100)] * 3, "doc_id bigint, length bigint")
    rows = packing.pack(items, 2048, part_items=100).collect()
    assert len(rows) == 503 and check(rows, 2048) <= 252


def test_documents(spark):
    lib, df = Tokenizer.from_file(WORD), awkward(spark)
    rows = packing.pack_documents(df, WORD, 64).collect()
    check(rows, 64)
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [0]
        want += [(r.doc_id, k, at, len(ids[at:at + 64]), zlib.crc32(np.array(ids[at:at + 64], "<u4").tobytes()))
                 for k, at in enumerate(range(0, len(ids), 64))]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert packing.pack_documents(empty(spark), WORD, 2048).collect() == []
