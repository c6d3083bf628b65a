import zlib

from pyspark.sql import functions as F

from llm_cases import awkward, empty
from planpulse.llm import kdshard
from planpulse.llm.common import expanded, slots


def check(rows, docs, shards):
    """Sizes, checksums and slots against the input; returns bytes by shard."""
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == want
    by = {}
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by.setdefault(r.shard, []).append((r.slot, r.doc_id, r.size))
    for members in by.values():
        members.sort()
        assert [m[0] for m in members] == list(range(len(members)))
        ids = [m[1] for m in members]
        assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    return {k: sum(m[2] for m in v) for k, v in by.items()}


def test_shards_are_even_and_copies_stay_together(spark):
    rows = [(i, f"text {i % 3000} " * (1 + i % 37), "en" if i % 5 else None, "src0" if i % 3 else f"src{i % 20}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = kdshard.shard(df, 40).collect()
    sizes = check(got, df.collect(), 40)
    mean = sum(sizes.values()) / 40
    assert len(sizes) == 40 and min(sizes.values()) > 0.9 * mean and max(sizes.values()) < 1.1 * mean
    shards = {}
    for r, (_, t, _, _) in zip(sorted(got, key=lambda r: r.doc_id), rows, strict=True):
        shards.setdefault(t, set()).add(r.shard)
    assert max(map(len, shards.values())) == 1


def test_a_hot_text_is_sliced(spark):
    rows = [(i, "the very same text" if i % 3 == 0 else f"another text no {i:05d}", "en", "s") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    sizes = check(kdshard.shard(df, 12).collect(), df.collect(), 12)
    mean = sum(sizes.values()) / 12
    assert len(sizes) == 12 and max(sizes.values()) < 1.12 * mean and min(sizes.values()) > 0.88 * mean


def test_awkward_rows(spark):
    df = awkward(spark)
    check(kdshard.shard(df, 4).collect(), df.collect(), 4)
    check(kdshard.shard(df.select("doc_id", "text"), 40).collect(), df.collect(), 40)
    assert kdshard.shard(empty(spark), 40).collect() == []


def test_the_widest_dimension_is_cut(spark):
    """Two clusters far apart in id and alike in all else are separated by the first cut."""
    rows = [(i + (10**9 if i % 2 else 0), f"{i:06d}", "en", "s") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = kdshard.shard(df, 2).collect()
    assert {(r.shard, r.doc_id >= 10**9) for r in got} == {(0, False), (1, True)}


def test_a_hot_row_is_dealt_over_shards(spark):
    """A third of the rows repeat one row without an id, a tenth one with an id."""
    rows = [(None, "the very same text", "en", "s") if i % 3 == 0 else (7, "one more repeated text", "en", "s") if i % 10 == 1
            else (i, f"another text no {i:05d}", "en", "s") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    sizes = check(kdshard.shard(df, 12).collect(), df.collect(), 12)
    mean = sum(sizes.values()) / 12
    assert len(sizes) == 12 and max(sizes.values()) < 1.12 * mean and min(sizes.values()) > 0.88 * mean


def test_copies_are_numbered_over_tasks(spark):
    df = spark.createDataFrame([("a", 1, 4), ("a", 2, 2500), ("b", None, 1), ("b", 5, 1), ("b", 6, 3)], "g string, i bigint, n bigint")
    got = expanded(slots(df, "g", ["i"], "n", "copies"), "n", "slot", 3).withColumn("task", F.spark_partition_id()).collect()
    for g, want in (("a", [1] * 4 + [2] * 2500), ("b", [None, 5, 6, 6, 6])):
        assert [(r.slot, r.i) for r in sorted(got, key=lambda r: r.slot) if r.g == g] == list(enumerate(want))
    assert len({r.task for r in got if r.i == 2}) > 1
