import hashlib
import random
import re
import struct

import xxhash

from llm_cases import awkward, empty
from planpulse.llm import queries, winnow
from planpulse.llm.winnow import K, W


def h(x, seed):
    data = x.encode() if isinstance(x, str) else struct.pack("<q", x)
    u = xxhash.xxh64_intdigest(data, seed & (1 << 64) - 1)
    return u - (1 << 64) if u >> 63 else u


def brute(text):
    """Every window looked at on its own: (pos, hash) of its rightmost least hash."""
    tokens = re.findall(r"[^ \t-\r]{1,16}", text or "")
    if not tokens:
        return []
    if len(tokens) < K:
        grams = [h(" ".join(tokens), 42)]
    else:
        pair = lambda a, b: h(b, h(a, 42))
        one = [h(t, 42) for t in tokens]
        grams = [pair(pair(*one[i:i + 2]), pair(*one[i + 2:i + 4])) for i in range(len(one) - 3)]
    out = []
    for a in range(max(1, len(grams) - W + 1)):
        window = [(g & 0xFFFFFFFF, -i, g) for i, g in enumerate(grams[a:a + W], a)]
        _, i, g = min(window)
        if (-i, g) not in out:
            out.append((-i, g))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(8)
    many = [" ".join(rng.choice(["aa", "b", "the", "Grüße", "x" * 40, "中文"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    many += [None, "", "  \n", "one", "same " * 50, "a" * 1000]
    df = spark.createDataFrame(list(enumerate(many)), "doc_id bigint, text string")
    for r in winnow.fingerprints(df).collect():
        assert [tuple(x) for x in r.fingerprint] == brute(many[r.doc_id]), many[r.doc_id]


def test_shared_passages_share_a_hash(spark):
    """The guarantee: K + W - 1 tokens in common are enough, wherever they stand."""
    rng = random.Random(9)
    words = lambda n: [rng.choice("abcdefghij") * rng.randint(1, 9) for _ in range(n)]
    rows = []
    for i in range(40):
        passage = words(K + W - 1)
        rows += [(2 * i, " ".join(words(i) + passage + words(30 - i // 2))), (2 * i + 1, " ".join(words(7) + passage + words(i)))]
    prints = {r.doc_id: {x["hash"] for x in r.fingerprint}
              for r in winnow.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(prints[2 * i] & prints[2 * i + 1] for i in range(40))


def test_edited_texts_and_likeness(spark):
    df = awkward(spark)
    got = winnow.edited_likeness(df).collect()
    assert len(got) == df.count()
    texts = {(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()}
    seed = {t: h(t, 42) for _, t in texts}
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, seed[x[1]]))
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    want = []
    for r in df.select("doc_id", "text").collect():
        t, other = r.text or "", after[(r.doc_id, r.text or "")][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + other[:q]
        a, e, n = ({x for _, x in brute(x)} if len(x) < 50_000 else None for x in (t, edited, other))
        like = lambda x, y: None if x is None or y is None else 1.0 if not x | y else len(x & y) / len(x | y)
        want.append((r.doc_id, len(t), hashlib.sha256(edited.encode()).hexdigest(), like(a, e), like(a, n)))
    key = lambda r: (repr(r[0]), r[1], r[2])
    rows = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got]
    for g, w in zip(sorted(rows, key=key), sorted(want, key=key), strict=True):
        assert g[:3] == w[:3]
        assert all(y is None or abs(x - y) < 1e-12 for x, y in zip(g[3:], w[3:], strict=True))
        assert 0 <= g[3] <= 1 and 0 <= g[4] <= 1
    prints = {}
    for r in got:
        prints.setdefault(r.fingerprint, set()).add(r.n_chars)


def test_equal_texts_have_equal_fingerprints(spark):
    df = spark.createDataFrame([(i, "some text that is the same in all of the rows here " * 3) for i in range(9)],
                               "doc_id bigint, text string")
    rows = winnow.edited_likeness(df).collect()
    assert len({r.fingerprint for r in rows}) == 1 and {r.near_next for r in rows} == {1.0}


def test_one_row_and_none(spark):
    one = winnow.edited_likeness(spark.createDataFrame([(4, "abcdefgh")], "doc_id bigint, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one[0].near_next == 1.0
    assert winnow.edited_likeness(empty(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    df = winnow.edited_likeness(awkward(spark))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_unspaced_text_rolls(spark, monkeypatch):
    """A character put in front of, dropped from or put into an unspaced text changes only the hashes around it."""
    rng = random.Random(10)
    rows, many = [], []
    for alphabet in ("的一是不了人我在有他这为之大来以个中上们", "abcdefghijklmnopqrstuvwxyz0123456789+/", "01", "😀😁😂🤣😃😄😅😆"):
        t = "".join(rng.choice(alphabet) for _ in range(2000))
        many.append([t, "我" + t, t[1:], t[:1000] + "z" + t[1000:], "two words " + t + " and more"])
        rows += many[-1]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    prints = {r.doc_id: {x["hash"] for x in r.fingerprint} for r in winnow.fingerprints(df, tokens=winnow.ROLLED).collect()}
    for i in range(0, len(rows), 5):
        for j in range(i + 1, i + 5):
            lost = prints[i] ^ prints[j]
            assert len(lost) <= 4 * (K + W) and len(prints[i] & prints[j]) > 0, (rows[i][:20], j, len(lost))
    # The registered query: the first text's next document is the same text, shifted.
    monkeypatch.setattr(queries, "documents", lambda spark, d: df)
    near = {r.doc_id: r.near_next for r in queries.op7_winnowing(spark, "").collect()}
    assert all(near[i] > 0.97 for i in (0, 5, 15))


def test_short_runs_stay_whole(spark):
    rows = [(0, "sixteen-letters! short words " + "y" * 17), (1, "a b c d")]
    got = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "doc_id", f"regexp_extract_all(text, r'{winnow.ROLLED}', 1) AS t").collect()
    assert {r.doc_id: r.t for r in got} == {0: ["sixteen-letters!", "short", "words", *"y" * 17], 1: list("abcd")}
