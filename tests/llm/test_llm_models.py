import random
import zlib

import numpy as np
import pytest

from llm_cases import awkward, empty
from planpulse.llm import langid, quality
from planpulse.llm.convnet import CELL, Filters, cells

D = "/root/testdata/sf0.01"


def test_pooled_responses_match_brute_force():
    rng = np.random.default_rng(1)
    filters = Filters(rng.normal(size=(4, 256, 3)))
    many = [b"", b"abc", bytes(rng.integers(0, 256, 700, dtype=np.uint8)), b"z" * CELL]
    rows, firsts = cells(many, 4)
    pooled = filters.pooled(rows)
    assert firsts.tolist() == [0, 1, 2, 5] and len(pooled) == 6
    at = 0
    for x in many:
        n = max(1, -(-len(x) // CELL))
        padded = x.ljust(n * CELL, b"\0") + b"\0" * 4
        for c in range(n):
            want = np.max([sum(filters.tables[j, padded[c * CELL + t + j]] for j in range(4)) for t in range(CELL)], axis=0)
            assert np.allclose(pooled[at + c], want, atol=1e-5)
        at += n
    best, at = filters.pooled_at(rows)
    assert np.allclose(best, pooled, atol=1e-5)


def test_gradient_of_the_filters():
    rng = np.random.default_rng(2)
    filters = Filters(rng.normal(size=(4, 256, 2)))
    rows, _ = cells([bytes(rng.integers(97, 123, 300, dtype=np.uint8))], 4)
    weight = rng.normal(size=(2, 2)).astype(np.float32)
    best, at = filters.pooled_at(rows)
    grad = filters.back(rows, at, weight)
    j, b, f = np.argwhere(grad != 0)[3]
    moved = Filters(filters.tables.copy())
    moved.tables[j, b, f] += 1e-3
    change = ((moved.pooled(rows) - best) * weight).sum() / 1e-3
    assert change == pytest.approx(grad[j, b, f], rel=0.05)


def test_chunks_overlap_and_cover():
    (a, b), starts = quality.Model.chunks(6, np.array([0, 1, 4]))
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == [(0, 0), (1, 2), (2, 3), (4, 5)]
    assert starts.tolist() == [0, 1, 3]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{D}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{D}/labels.parquet")


@pytest.fixture(scope="module")
def good(docs, labels):
    return quality.train(docs, labels)


@pytest.fixture(scope="module")
def tongue(docs):
    return langid.train(docs)


def test_quality_on_held_out_rows(docs, labels, good):
    got = {r.doc_id: r for r in quality.score(docs, good).collect()}
    assert len(got) == docs.count()
    right = total = kept = clean = 0
    for r in labels.collect():
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert got[r.doc_id].predicted == (got[r.doc_id].score >= 0.3)
        if got[r.doc_id].held_out:
            total += 1
            right += got[r.doc_id].predicted == r.quality
            clean += r.quality
            kept += r.quality and got[r.doc_id].predicted
    assert right / total > 0.93 and kept / clean > 0.97


def test_language_on_held_out_rows(docs, tongue):
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.predict(docs, tongue).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and {r.lang_pred for r in got} <= set(truth.values()) | {"und"}


def test_scores_do_not_depend_on_the_batch(good, tongue):
    rng = random.Random(3)
    many = [bytes(rng.choices("abc é###\n".encode(), k=rng.randint(0, 3000))) for _ in range(30)]
    alone = np.concatenate([good.scores([x]) for x in many])
    assert np.allclose(good.scores(many), alone, atol=1e-5)
    assert np.allclose(tongue.probabilities(many), np.vstack([tongue.probabilities([x]) for x in many]), atol=1e-5)


def test_the_end_of_a_long_text_counts(good):
    """Whole texts: junk after 100,000 clean bytes still lowers the score."""
    clean = ("Thou hath the on and in. " * 4000).encode()
    assert good.scores([clean + b"A!! B!! C### D$$$ E&&& F%%% " * 1500])[0] < good.scores([clean])[0]


def test_awkward_rows(spark, good, tongue):
    df = awkward(spark)
    scored = quality.score(df, good).collect()
    assert len(scored) == df.count() and all(0 <= r.score <= 1 for r in scored)
    told = {(r.doc_id, r.lang_pred) for r in langid.predict(df, tongue).collect()}
    assert {(0, "und"), (1, "und"), (2, "und"), (6, "und")} <= told and (4, "und") not in told
    assert quality.keep_good(df, good).columns == df.columns and langid.keep_known(df, tongue).columns == df.columns
    kept = langid.keep_known(df, tongue).collect()
    assert all(r.text and any(c.isalpha() for c in r.text) for r in kept)


def test_nothing_to_learn_from(spark, docs, labels):
    none = empty(spark)
    assert quality.train(none, labels) is None and langid.train(none) is None
    assert quality.train(docs, labels.filter("quality = 1")) is None
    assert {r.score for r in quality.score(awkward(spark), None).collect()} == {0.5}
    assert {r.lang_pred for r in langid.predict(awkward(spark), None).collect()} == {"und"}
    assert quality.score(none, None).collect() == [] and langid.predict(none, None).collect() == []


def test_inputs_of_a_score(spark, docs, good, tongue):
    """lang, source and doc_id are no inputs: changing them changes no prediction."""
    other = docs.selectExpr("doc_id + 1000000 as doc_id", "text", "'xx' as lang", "'yy' as source")
    a = sorted((r.doc_id + 1000000, r.score) for r in quality.score(docs, good).collect())
    assert a == sorted((r.doc_id, r.score) for r in quality.score(other, good).collect())
    a = sorted((r.doc_id + 1000000, r.lang_pred) for r in langid.predict(docs, tongue).collect())
    assert a == sorted((r.doc_id, r.lang_pred) for r in langid.predict(other, tongue).collect())
