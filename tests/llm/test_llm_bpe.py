import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_cases import TEXTS, awkward, empty
from planpulse.llm import bpe

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def random_texts(n, seed=3):
    rng = random.Random(seed)
    letters = "abcde'st!?.1234é ÀßİΣσς中文가́ 　\x1c\x85\n\tA\U0001F600"
    for _ in range(n):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        yield s[:9] + "<|endoftext|>" + s[9:] if rng.random() < 0.2 else s


def test_matches_library_on_random_texts(library):
    model = bpe.Bpe(WORD)
    many = list(random_texts(800))
    got = [b"".join(x) for x in model.encode_many([s.encode() for s in many])]
    for s, g in zip(many, got, strict=True):
        assert ids(g) == library.encode(s, add_special_tokens=False).ids
        assert model.encode(s.encode()) == g


def test_pieces_are_cut_like_the_library_does(library):
    """Every code point up to U+02FF, apostrophes, case, special tokens; many texts at once and one by one."""
    model, rng = bpe.Bpe(WORD), random.Random(11)
    many = [chr(c) + more + chr(c) for c in range(1, 0x300) for more in ("", "'s", "a'S1", "'")]
    pools = ["'stremvld ab12!", "'stremvld STREMVLD<|>x", "İiIȺȾÉéß'sǅǆ²½ªº«»\xad\xa0\x85\x7f ɐʀa", "中文é́x'll 12 "]
    many += ["".join(rng.choice(p) for _ in range(rng.randint(0, 60))) for p in pools for _ in range(300)]
    many += ["'", "'s", "s'", " 's", "'l", "'r", "'v e", "''s", "x'll'd", "1's", "A'LL<|b", "<|", "a<|endoftext|", "é" * 3000 + "'re"]
    got = [b"".join(x) for x in model.encode_many([s.encode() for s in many])]
    for s, g in zip(many, got, strict=True):
        assert ids(g) == library.encode(s, add_special_tokens=False).ids == ids(model.encode(s.encode())), s


def test_spellings_of_a_word_share_its_pieces(library):
    """The table holds pieces: case and marks around a word add no entries, and no word is split by itself."""
    model, rng = bpe.Bpe(WORD), random.Random(13)
    made = ["".join(rng.choice("aeinorstlhdué") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(f(w) + end for w in made) for f in (str, str.title, str.upper) for end in ("", ",", "!", "'s")]
    one_by_one = []
    model.word = one_by_one.append
    got = [b"".join(x) for x in model.encode_many([s.encode() for s in texts])]
    assert [ids(g) for g in got] == [library.encode(s, add_special_tokens=False).ids for s in texts]
    assert len(model.words) == len(set(made)) + 3 and not one_by_one


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 9000 + "'s", "!" * 9000 + "'s" + "x" * 9000, "中文" * 5000, "é" * 9000,
                                  "thetion" * 3000, "a1b2" * 4000, "<|endoftext|>" * 300])
def test_unbroken_texts_stream_through_the_window(library, text):
    assert ids(bpe.load(WORD).encode(text.encode())) == library.encode(text, add_special_tokens=False).ids


def test_window_state_stays_bounded():
    model = bpe.Bpe(WORD)
    seen = []
    merge = model.merge
    model.merge = lambda x: seen.append(len(x)) or merge(x)
    out = list(model.transduce([b"theinan" * 3000, b"q" * 20000]))
    assert max(seen) <= model.window + 1 and len(out) > 1000


def test_stable_tokens_do_not_depend_on_what_follows():
    model = bpe.load(WORD)
    rng = random.Random(5)
    for _ in range(30):
        head = [model.inner[ord(rng.choice("thaneris"))] for _ in range(model.lookahead + 60)]
        runs = []
        for _ in range(3):
            tail = [model.inner[ord(rng.choice("thaneris"))] for _ in range(40)]
            at, ends = 0, []
            for t in model.merge(head + tail):
                at += model._length(t)
                if at > 60:
                    break
                ends.append((at, t))
            runs.append(ends)
        assert runs[0] == runs[1] == runs[2]


def test_prose_leaves_the_window_by_the_lookahead(library, monkeypatch):
    """Every token comes out of the stream, all by distance but those in the last lookahead of a window."""
    monkeypatch.setattr(bpe, "WINDOW", 4096)
    model = bpe.Bpe(WORD)
    rng = random.Random(17)
    made = ["".join(rng.choice("aeinorstlhdu") for _ in range(rng.randint(2, 11))) for _ in range(9000)]
    held, inner = [], model.merge_window
    model.merge_window = lambda x, last: held.append(len(x)) or inner(x, last)
    text = " ".join(made)
    want = library.encode(text, add_special_tokens=False).ids
    assert ids(model.encode(text.encode())) == want
    assert max(held) == model.window == 4096 and len(held) > 10
    distinct = sum(len(library.encode(w, add_special_tokens=False).ids) for w in set(made))
    assert sum(model.emitted.values()) == distinct            # a word's tokens are emitted once, then remembered
    assert model.emitted["end of piece"] < 1.2 * model.lookahead / model.window * distinct


def test_one_stream_of_pieces_of_any_length(monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 4096)
    model = bpe.Bpe(WORD)
    rng = random.Random(23)
    pieces = ["".join(rng.choice("theinan") for _ in range(rng.choice([1, 2, 7, 300, 9000]))).encode() for _ in range(60)]
    want = [model.merge([model.inner[x] for x in p[:-1]] + [model.last[p[-1]]]) for p in pieces]
    assert [ids(x) for x in model.merge_all(pieces)] == want
    assert [list(model.transduce([p[:5], p[5:]])) for p in pieces] == want


def test_lookahead_of_small_merge_lists():
    assert bpe.sufficient_lookahead([("a", "b"), ("c", "d")]) == 1
    assert bpe.sufficient_lookahead([("a", "b"), ("c", "ab")]) == 2      # "ca": b decides what c becomes
    assert bpe.sufficient_lookahead([("a", "b"), ("c", "ab"), ("d", "cab")]) == 3
    assert bpe.sufficient_lookahead([("b", "c"), ("a", "b")]) == 2       # a waits for the b that c may take


def test_lookahead_needs_parts_before_rules():
    assert bpe.sufficient_lookahead([("ab", "c"), ("a", "b")]) is None


def test_merge_all_equals_merge():
    model = bpe.Bpe(WORD)
    rng = random.Random(9)
    pieces = ["".join(rng.choice("aathein") for _ in range(rng.randint(1, 30))).encode() for _ in range(500)]
    pieces += [b"a" * n for n in range(1, 40)]
    want = [model.merge([model.inner[x] for x in p[:-1]] + [model.last[p[-1]]]) for p in pieces]
    assert [ids(x) for x in model.merge_all(pieces)] == want
    assert model.merge_all([]) == []


def test_known_keeps_two_generations(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    made = []
    known = bpe.Known(lambda k: made.append(k) or k.upper())
    for k in ["a", "b", "c", "d", "a"]:
        assert known[k] == k.upper()
    assert made == ["a", "b", "c", "d"] and known.new(["a", "b", "zz"]) == ["zz"]


def test_decoder_joins_bytes_across_ids():
    model, lib = bpe.load(BYTE), Tokenizer.from_file(BYTE)
    for text in ["Grüße 中文 \U0001F600 <|endoftext|>", "", "é" * 50]:
        want = lib.encode(text, add_special_tokens=False).ids
        back = model.decoder()
        assert "".join([back.feed([i]) for i in want] + [back.feed([], True)]) == lib.decode(want, skip_special_tokens=False)
    part = lib.encode("\U0001F600", add_special_tokens=False).ids[:1]      # an unfinished character
    back = model.decoder()
    assert back.feed(part) + back.feed([], True) == lib.decode(part, skip_special_tokens=False)


def test_query_digests(spark, library):
    df = awkward(spark)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode(df, WORD).collect()),
                 key=repr)
    want = []
    for r in df.select("doc_id", "text").collect():
        x = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(x, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe.encode_decode(empty(spark), WORD).collect() == []


def test_ids_round_trip(spark, library):
    df = awkward(spark, [t for t in TEXTS if t is None or len(t) < 6000])
    encoded = bpe.encode_ids(df, WORD)
    by_text = {tuple(library.encode(t or "", add_special_tokens=False).ids) for t in TEXTS}
    assert {tuple(r.ids) for r in encoded.collect()} <= by_text | {tuple(library.encode("another text under an id that exists").ids)}
    for r in bpe.decode_ids(encoded, WORD, step=3).collect():
        assert isinstance(r.text, str)
    again = bpe.decode_ids(encoded, WORD, step=10_000)
    assert sorted(r.text for r in again.collect()) == sorted(r.text for r in bpe.decode_ids(encoded, WORD, step=1).collect())
