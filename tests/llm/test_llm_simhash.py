import random
import re

import numpy as np
import pytest
import xxhash

from llm_cases import awkward, empty
from planpulse.llm import simhash
from planpulse.llm.components import components


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hs) > len(hs))


def brute_components(fps, ids, radius=4):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    out = []
    for i in range(len(fps)):
        members = [ids[j] for j in range(len(fps)) if find(j) == find(i) and ids[j] is not None]
        out.append(min(members, default=None))
    return out


def test_fingerprints_match_brute_force(monkeypatch):
    rng = random.Random(1)
    many = [" ".join(rng.choice(["The", "cat", "Ünd", "x\n", "É"]) for _ in range(rng.randint(0, 40))) for _ in range(100)]
    many += ["", " \n", "One", "one", "a b c", "a b c d", "A B C D E"]
    for chunk in (1 << 20, 7, 1):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        for t in many:
            assert simhash.fingerprint(t.encode()) == brute_fingerprint(t), (chunk, t)


def near(rng, fp, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        fp ^= 1 << b
    return fp


def planted(n, seed):
    """Random fingerprints, chains whose ends are far apart, and a dense ball."""
    rng = random.Random(seed)
    fps = [rng.getrandbits(64) for _ in range(n)]
    for i in range(0, n, 10):
        x = fps[i]
        for _ in range(6):
            x = near(rng, x, 5)
            fps.append(x)
    ball = rng.getrandbits(64)
    fps += [near(rng, ball, 3) for _ in range(n)]
    return sorted(set(fps))


@pytest.mark.parametrize("tile,block", [(1 << 15, 512), (16, 512), (1 << 15, 0.01), (1 << 15, 1e-6), (8, 1e-4)])
def test_links_find_every_pair(spark, monkeypatch, tile, block):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "HELD", 256)
    fps = planted(300, 5)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    star = {r.u: r.v for r in components(simhash.links(df)).collect()}
    got = {}
    for x in signed:
        got.setdefault(star.get(x, x), set()).add(x)
    want = {}
    for x, c in zip(signed, brute_components(fps, list(range(len(fps)))), strict=True):
        want.setdefault(c, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("radius", [0, 1, 3, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    fps[100:] = fps[:100] ^ (np.uint64(1) << rng.integers(0, 63, 100).astype(np.uint64)) ^ \
        (np.uint64(1) << rng.integers(0, 63, 100).astype(np.uint64))
    ends = np.full(200, 200)
    got = {(i, j) for a, b in simhash.near(fps, np.zeros(200, int), ends, list(range(64)), radius) for i, j in zip(a, b, strict=True)}
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
    assert got == want


def test_documents(spark):
    df = awkward(spark)
    rows = df.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    want = [(r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components(fps, [r.doc_id for r in rows]), strict=True)]
    assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_one_row_of_each_group_stays(spark):
    df = awkward(spark)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    fps = [brute_fingerprint(r.text) for r in df.collect()]
    groups = brute_components(fps, list(range(len(fps))))
    rows = kept.collect()
    assert len(rows) == len(set(groups))
    assert {g for r in rows for g, f in zip(groups, fps, strict=True) if f == brute_fingerprint(r.text)} == set(groups)
    assert simhash.keep_first(empty(spark)).collect() == []


def test_components_follow_long_chains(spark):
    edges = [(i + 1, i) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 50)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r.u: r.v for r in components(df).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 50)}
