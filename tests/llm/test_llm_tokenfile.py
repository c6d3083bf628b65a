import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_cases import awkward, empty
from planpulse.llm import tokenfile
from planpulse.llm.common import scratch_path

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [0, 5, 5, 10**12], list(range(2000)), [3] * 1500 + [10**9]])
def test_elias_fano_round_trip(values):
    ef = tokenfile.EliasFano.of(np.array(values, np.int64))
    again, end = tokenfile.EliasFano.read(memoryview(ef.tobytes()), 0)
    assert end == len(ef.tobytes())
    assert again.values().tolist() == values
    assert [again.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        again.select(len(values))


def test_elias_fano_is_near_minimal():
    rng = np.random.default_rng(0)
    values = np.sort(rng.integers(0, 10**7, 20_000))
    bits = 8 * len(tokenfile.EliasFano.of(values).tobytes()) / len(values)
    assert bits < 2 + np.log2(10**7 / 20_000) + 1


def test_block_round_trip():
    block = tokenfile.Block(3, 100, 2)
    docs = [(None, [5]), (-4, [1, 2, 3]), (9, []), (2**62, [7, 7])]
    for doc_id, ids in docs:
        block.add(doc_id, np.array(ids, "<u2").tobytes())
    r = tokenfile.Reader(block.tobytes() + b"\n")
    assert (r.part, r.before, r.n_ids, r.n) == (3, 100, 6, 4)
    assert r.doc_ids() == [None, -4, 9, 2**62]
    assert [r[i].tolist() for i in range(4)] == [ids for _, ids in docs]


def test_pieces_match_library():
    known = tokenfile.Pieces(BYTE, 0)
    rng = random.Random(1)
    letters = "ab's 'll  \n\n1. é!\t中　<|endoftext|>\x00\x85"
    many = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(800)]
    many += ["x <|endoftext|>  y", "  ", "a" * 3000, "word " * 400_000]
    want = known.library.encode_batch(many, add_special_tokens=False)
    for s, w in zip(many, want, strict=True):
        assert np.frombuffer(known.encode(s), "<u2").tolist() == w.ids, s[:80]


def expected(df):
    lib = Tokenizer.from_file(BYTE)
    out, start = [], 0
    rows = [(r.doc_id, lib.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in df.select("doc_id", "text").collect()]
    for doc_id, ids in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_ids", [1, 700, 2_000_000])
def test_files_read_back_in_order(spark, block_ids):
    df = awkward(spark).dropDuplicates(["doc_id"]).repartition(5)
    path = scratch_path(spark, "tokens")
    got = tokenfile.token_files(df, BYTE, path=path, block_ids=block_ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got.collect()), key=lambda r: r[1]) == expected(df)


def test_repeated_ids_are_all_kept(spark):
    df = awkward(spark)
    got = tokenfile.token_files(df, BYTE).collect()
    assert len(got) == df.count()
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


def test_empty_table(spark):
    assert tokenfile.token_files(empty(spark), BYTE).collect() == []


def test_rows_are_read_through_select(monkeypatch):
    """Offsets of a block's documents come from the samples around them; nothing decodes all boundaries."""
    def refuse(self):
        raise AssertionError("all values decoded")
    rng = np.random.default_rng(5)
    n, every = 1700, tokenfile.EliasFano.EVERY
    block = tokenfile.Block(3, 40, 2)
    texts = [rng.integers(0, 50_000, k).astype("<u2") for k in rng.integers(0, 300, n)]
    ids = [None] * 600 + sorted(rng.integers(-10**12, 10**12, n - 600).tolist())
    for i, t in zip(ids, texts, strict=True):
        block.add(i, t.tobytes())
    r = tokenfile.Reader(block.tobytes())
    want = np.array(block.bounds)
    for a, b in ((0, 0), (0, 1), (511, 513), (512, 1024), (700, 1699), (n, n + 1), (0, n + 1), (n + 1, n + 1)):
        assert r.bounds.select_range(a, b).tolist() == want[a:b].tolist()
    with pytest.raises(IndexError):
        r.bounds.select_range(5, n + 2)
    monkeypatch.setattr(tokenfile.EliasFano, "values", refuse)
    got = list(r.rows())
    assert len(got) == -(-n // every) and all(len(c[0]) <= every for c in got)
    doc, at, count, crc = (np.concatenate([np.asarray(c[k], object) for c in got]).tolist() for k in range(4))
    assert doc == ids == r.doc_ids() and at == (want[:-1] + 40).tolist() and count == [len(t) for t in texts]
    assert crc == [zlib.crc32(t.astype("<u4")) for t in texts]
