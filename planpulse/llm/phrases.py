"""Phrase collocation mining over sorted count streams.

Only one row per word position is shuffled: the window of the next words, up to the longest
phrase, cut at the end of its piece.  A phrase occurs where a window begins with it, so in
the stream of windows in prefix order the count of every shorter phrase is the sum of a
consecutive stretch.  The streams of frequent phrases are then read twice in order, once by
their words from the left (prefix order) and once from the right (suffix order): whatever
begins (ends) a phrase stands before it on a stack, and its extensions follow it, so one
pass per order gives all left (right) counts and the greatest extension.  The two streams
are merge-joined.  Nothing is looked up in a hash table of phrases.

Streams are range partitioned, so a frequent first word spreads over many tasks.  A stretch
that crosses the border of two tasks is put together from the few rows both give for it.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planpulse.llm.common import rows_batch, ship, slices, to_scratch

#: Texts of so many bytes are cut into windows together, so many words at a time.
TEXT_BYTES, WORDS = 4_000_000, 500_000
ROWS = 20_000
UNKNOWN = "und"
#: Where the stream is cut into parts is learnt from every SPACING-th stretch of SLICE bytes, every EACH-th window of it.
SLICE, SPACING, EACH = 4096, 32, 8

# Phrases are kept as bytes, words joined by a tab.  Control characters below it become bytes that
# UTF-8 has no use for, so the tab sorts before every byte of a word and a phrase before its extensions.
_LOW, _FREE = bytes(range(9)), bytes(range(0xF5, 0xFE))
_FOLD = np.frombuffer(bytes(range(256)).lower().translate(bytes.maketrans(_LOW, _FREE)), np.uint8)
_UNFOLD = bytes.maketrans(_FREE + b"\t", _LOW + b" ")
_KIND = np.zeros(256, np.uint8)          # 0: of a word, 1: between words, 2: between pieces
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_COUNT = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64())])
COUNT = "lang string, phrase binary, n bigint"


def _gather(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The slices of a buffer as one binary array."""
    size = end - start
    offsets = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    index = np.repeat((start - offsets[:-1]).astype(np.int32), size)
    index += np.arange(len(index), dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(flat[index])])


def _part_of(phrases: pa.Array, bounds: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the part each phrase lies in (the bounds that are not above it), and its first eight bytes."""
    offsets = np.frombuffer(phrases.buffers()[1], np.int32)[phrases.offset:phrases.offset + len(phrases) + 1]
    data = np.append(np.frombuffer(phrases.buffers()[2], np.uint8), np.zeros(8, np.uint8))
    head = data[offsets[:-1, None] + np.arange(8, dtype=np.int32)]
    head[np.arange(8) >= np.diff(offsets)[:, None]] = 0
    key = head.view(">u8").ravel().astype(np.uint64)
    cuts = np.array([int.from_bytes(b[:8].ljust(8, b"\0"), "big") for b in bounds], np.uint64)
    part = np.searchsorted(cuts, key, "right")
    for i in np.flatnonzero(np.isin(key, cuts)).tolist():          # the first bytes do not tell
        part[i] = bisect.bisect_right(bounds, phrases[i].as_py())
    return part, key


def windows(docs: list[bytes], lang_of: list[int], longest: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Windows of some texts, their languages and counts: equal ones of a stretch are counted.

    A window is a word and the next ones of its piece, at most ``longest``.
    """
    text = np.frombuffer(b"\n" + b"\n".join(docs), np.uint8)
    kind = _KIND[text]
    word = kind == 0
    start = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    if not len(start):
        return
    end = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    if word[-1]:
        end = np.append(end, len(text))
    piece = np.cumsum(kind == 2, dtype=np.int64)[start]
    first = np.cumsum([1] + [len(d) + 1 for d in docs[:-1]])
    lang = np.array(lang_of)[np.searchsorted(first, start, "right") - 1]
    word[start - 1] = True                   # words with a tab before each
    flat = _FOLD[text]
    flat[start - 1] = 9
    flat = flat[word]
    size = end - start
    start = np.cumsum(size + 1) - size
    end = start + size
    del text, kind, word, size
    for a, b in slices(len(start), WORDS):   # windows that begin here may reach into the next slice
        to = min(len(start), b + longest - 1)
        at, ends, own, of = start[a:to], end[a:to], piece[a:to], lang[a:to]
        last = np.append(np.flatnonzero(own[1:] != own[:-1]), len(own) - 1)
        last = np.repeat(last, np.diff(last, prepend=-1))[:b - a]
        found = _gather(flat, at[:b - a], ends[np.minimum(np.arange(b - a) + longest - 1, last)])
        table = pa.table([found, pa.array(of[:b - a])], ["phrase", "lang"]).group_by(["phrase", "lang"], use_threads=False)
        table = table.aggregate([([], "count_all")]).combine_chunks()
        yield table.column("phrase").chunk(0), table.column("lang").to_numpy(), table.column("count_all").to_numpy()


def parts_of(text: bytes) -> Iterator[bytes]:
    """A text in parts of at least TEXT_BYTES, cut between pieces."""
    at = 0
    while len(text) - at > 2 * TEXT_BYTES:
        cut = _END.search(text, at + TEXT_BYTES)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


_END = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[int], list[str]]]:
    """Texts of about TEXT_BYTES at a time, with the numbers of their languages and these."""
    docs: list[bytes] = []
    lang_of: list[int] = []
    langs: dict[str, int] = {}
    held = 0
    for batch in batches:
        column = batch.column("text").cast(pa.binary())
        for i, lang in enumerate(batch.column("lang").to_pylist()):
            for part in parts_of(column[i].as_py() or b""):
                docs.append(part)
                lang_of.append(langs.setdefault(lang, len(langs)))
                held += len(part)
                if held >= TEXT_BYTES:
                    yield docs, lang_of, list(langs)
                    docs, lang_of, langs, held = [], [], {}, 0
    if docs:
        yield docs, lang_of, list(langs)


def _some_windows(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("phrase", pa.binary())])
        for docs, _, _ in _groups(batches):
            text = b"\n".join(docs)
            some = b"\n".join(text[i:i + SLICE] for i in range(0, len(text), SLICE * SPACING))
            for found, _, _ in windows([some], [0], longest):
                yield rows_batch(schema, [found.take(pa.array(np.arange(0, len(found), EACH)))])
    return run


def _windows(longest: int, bounds: list[bytes]):
    schema = _COUNT.append(pa.field("part", pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, lang_of, langs in _groups(batches):
            for found, lang, counts in windows(docs, lang_of, longest):
                part, key = _part_of(found, bounds)
                order = np.argsort(key)          # neighbours that begin alike take less room in the shuffle
                for a, b in slices(len(order), ROWS):
                    i = order[a:b]
                    names = pa.DictionaryArray.from_arrays(pa.array(lang[i]), langs).cast(pa.string())
                    yield rows_batch(schema, [names, found.take(pa.array(i)), counts[i], part[i]])
    return run


class _Stretches:
    """Counts of the phrases of all lengths in a part of the windows' stream in prefix order."""

    def __init__(self, longest: int, least: int):
        self.longest, self.least = longest, least
        self.open: list[tuple[bytes, dict[str, int], bool] | None] = [None] * longest   # phrase, counts, at the border
        self.last: list[bytes] | None = None
        self.totals: Counter = Counter()
        self.out: list[tuple[str, bytes, int]] = []

    def _give(self, k: int, border: bool) -> None:
        if self.open[k] is not None:
            phrase, counts, first = self.open[k]
            self.out += [(lang, phrase, n) for lang, n in counts.items() if n >= self.least or border or first]
            self.open[k] = None

    def add(self, batch: pa.RecordBatch) -> None:
        n, longest = batch.num_rows, self.longest
        if not n:
            return
        phrase, counts = batch.column("phrase"), batch.column("n").to_numpy()
        langs = batch.column("lang").dictionary_encode()
        names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy().astype(np.int64)
        for name, total in zip(names, np.bincount(lang, counts, len(names)).astype(np.int64).tolist(), strict=True):
            self.totals[name] += total
        split = pc.split_pattern(phrase, b"\t")
        sizes = np.diff(split.offsets.to_numpy())
        codes = split.flatten().dictionary_encode().indices.to_numpy()
        words = np.full((n, longest), -1, np.int64)
        words[np.arange(longest) < sizes[:, None]] = codes
        new = np.ones((n, longest), bool)
        np.logical_or.accumulate(words[1:] != words[:-1], axis=1, out=new[1:])
        head = phrase[0].as_py().split(b"\t")
        begun = self.last is None
        for k in range(longest):
            same = self.last is not None and len(head) > k and self.last[:k + 1] == head[:k + 1]
            if not same:
                self._give(k, False)
            starts = np.flatnonzero(new[:, k])
            run = np.cumsum(new[:, k]) - 1
            full = words[:, k] >= 0
            key = run[full] * len(names) + lang[full]
            if not len(key):
                continue
            if len(starts) * len(names) <= 8 * n:
                sums = np.bincount(key, counts[full], len(starts) * len(names))
                keys = np.flatnonzero(sums)
                sums = sums[keys]
            else:
                keys, place = np.unique(key, return_inverse=True)
                sums = np.bincount(place, counts[full])
            runs, lang_of, sums = keys // len(names), keys % len(names), sums.astype(np.int64)
            last_run = len(starts) - 1
            for at in (0, last_run) if last_run else (0,):      # the first goes on from the batch before, the last is left open
                if words[starts[at], k] < 0:
                    continue
                mine = {names[a]: b for a, b in zip(lang_of[runs == at].tolist(), sums[runs == at].tolist(), strict=True)}
                if at == 0 and same:
                    text, counted, first = self.open[k]
                    for name, b in mine.items():
                        counted[name] = counted.get(name, 0) + b
                else:
                    self._give(k, False)
                    text = b"\t".join(phrase[int(starts[at])].as_py().split(b"\t")[:k + 1])
                    self.open[k] = (text, mine, begun and at == 0)
                if at == 0 and last_run:
                    self._give(k, False)
            for j in np.flatnonzero((sums >= self.least) & (runs > 0) & (runs < last_run)).tolist():
                text = b"\t".join(phrase[int(starts[runs[j]])].as_py().split(b"\t")[:k + 1])
                self.out.append((names[lang_of[j]], text, int(sums[j])))
            if words[starts[last_run], k] < 0:
                self._give(k, False)
        self.last = phrase[n - 1].as_py().split(b"\t")

    def end(self) -> None:
        for k in range(self.longest):
            self._give(k, True)
        self.out += [(lang, b"", n) for lang, n in self.totals.items()]


def _counts(longest: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stretches(longest, least)
        for batch in batches:
            stream.add(batch)
            if len(stream.out) >= ROWS:
                yield rows_batch(_COUNT, list(zip(*stream.out)))
                stream.out = []
        stream.end()
        if stream.out:
            yield rows_batch(_COUNT, list(zip(*stream.out)))
    return run


def _bounds(rows: DataFrame, longest: int) -> list[bytes]:
    """Where the parts of the windows' stream begin: a phrase for each shuffle partition but the first."""
    some = to_scratch(rows.mapInArrow(_some_windows(longest), "phrase binary"), "some")
    ranged = some.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "phrase")
    firsts = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min("phrase").alias("first")).toArrow()
    return sorted(firsts["first"].to_pylist())[1:]


def frequent(docs: DataFrame, longest: int, least: int, text_col: str, lang_col: str) -> DataFrame:
    """``lang, phrase, n`` of every phrase of up to ``longest`` words that occurs ``least`` times
    in its language, and of the empty phrase: the number of all its words."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    bounds = _bounds(rows, longest)
    stream = rows.mapInArrow(_windows(longest, bounds), f"{COUNT}, part int").repartitionById(len(bounds) + 1, "part")
    parts = stream.drop("part").sortWithinPartitions("phrase", "lang").mapInArrow(_counts(longest, least), COUNT)
    whole = parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))     # stretches across borders
    return to_scratch(whole.filter((F.col("n") >= least) | (F.col("phrase") == F.lit(b""))), "frequent")


def _turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turned = [b"\t".join(p.split(b"\t")[::-1]) for p in batch.column("phrase").to_pylist()]
        yield rows_batch(_COUNT, [batch.column("lang"), turned, batch.column("n")])


_PASSED = "kind string, part int, lang string, phrase binary, n bigint, cuts array<bigint>, extension bigint"
_PASSED_ARROW = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("lang", pa.string()), ("phrase", pa.binary()),
                           ("n", pa.int64()), ("cuts", pa.list_(pa.int64())), ("extension", pa.int64())])


def _pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read frequent phrases in order: of each, the counts of its beginnings and its greatest extension.

    A beginning before the part's first row is not seen here: its count is asked for (kind
    ``need``) and null, and the extensions it has in this part are given apart (``more``).
    """
    part = TaskContext.get().partitionId()
    stack: list[list] = []                       # words, the row, the extension; no row if it lies before the part
    here: str | None = None
    out: list[tuple] = []

    def pop(size: int) -> None:
        while len(stack) > size:
            words, row, longest = stack.pop()
            if row is not None:
                out.append(("row", part, *row, longest))
            elif longest:
                out.append(("more", part, here, b"\t".join(words), None, None, longest))

    first = True
    for batch in batches:
        for lang, phrase, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase", "n")), strict=True):
            words = phrase.split(b"\t")
            if lang != here:
                pop(0)
                here = lang
            while stack and words[:len(stack[-1][0])] != stack[-1][0]:
                pop(len(stack) - 1)
            if first:
                for k in range(1, len(words)):
                    stack.append([words[:k], None, 0])
                    out.append(("need", part, lang, b"\t".join(words[:k]), k, None, None))
                first = False
            cuts = [None if row is None else row[2] for _, row, _ in stack]
            if stack:
                stack[-1][2] = max(stack[-1][2], n)
            stack.append([words, (lang, phrase, n, cuts), 0])
            if len(out) >= ROWS:
                yield rows_batch(_PASSED_ARROW, list(zip(*out)))
                out.clear()
    pop(0)
    if out:
        yield rows_batch(_PASSED_ARROW, list(zip(*out)))


def _stream(phrases: DataFrame, name: str) -> DataFrame:
    """``lang, phrase, n, cuts, extension`` of a stream in the order of its phrases.

    ``cuts[k - 1]`` is the count of the first k words, ``extension`` the greatest count of
    the phrase and one more word.
    """
    ordered = phrases.repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    passed = to_scratch(ordered.mapInArrow(_pass, _PASSED), name)
    # A part asks for fewer beginnings than a phrase has words: at most a few rows a task.
    asked = passed.filter("kind = 'need'").select("part", "lang", "phrase", F.col("n").alias("k"))
    known = asked.join(phrases, ["lang", "phrase"]).groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("known"))
    more = passed.filter("kind = 'more'").groupBy("lang", "phrase").agg(F.max("extension").alias("more"))
    rows = passed.filter("kind = 'row'").join(F.broadcast(known), "part", "left").join(F.broadcast(more), ["lang", "phrase"], "left")
    cuts = F.transform("cuts", lambda x, i: F.coalesce(x, F.col("known")[(i + 1).cast("bigint")]))
    return rows.select("lang", "phrase", "n", cuts.alias("cuts"), F.greatest("extension", F.coalesce("more", F.lit(0))).alias("extension"))


_BACK = "lang string, phrase binary, rs array<bigint>, left bigint"


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffix stream's rows under the phrases in their own order."""
    for batch in batches:
        phrase = [b"\t".join(p.split(b"\t")[::-1]) for p in batch.column("phrase").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(phrase, pa.binary()), batch.column("cuts"),
                                          batch.column("extension")], ["lang", "phrase", "rs", "left"])


_MERGED = "lang string, phrase string, a bigint, ls array<bigint>, rs array<bigint>, longer bigint"


def _shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases as text, their words joined by a space."""
    for batch in batches:
        text = [p.translate(_UNFOLD) for p in batch.column("phrase").to_pylist()]
        at = batch.schema.get_field_index("phrase")
        yield batch.set_column(at, "phrase", pa.array(text, pa.string()))


def least_cut() -> Column:
    """Of columns ``a, total, ls, rs``: the cut of the least score, then of the fewest words, with its l and r."""
    return F.expr("""array_min(transform(sequence(1, size(ls)), k -> struct(
        (1000 * cast(a as decimal(19)) * cast(total as decimal(19)))
            div (cast(ls[k - 1] as decimal(19)) * cast(rs[size(ls) - k] as decimal(19))) as score,
        k as k, ls[k - 1] as l, rs[size(ls) - k] as r)))""")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, share: int = 100,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of each language.

    A phrase of 2 to ``longest`` words with ``a >= least`` occurrences is a candidate.  Cut
    after its first k words it scores ``floor(1000 * a * n / (l * r))``, with the counts of
    its parts and of all words; the least score (then the least k) is its own.  Candidates
    inside a longer candidate that occurs at least ``share`` per cent as often go.  Null
    texts are empty, a null language is ``und``; repeated rows count again; further columns
    are ignored; without candidates there are no rows.  Exact as long as 1000 * a * n has at
    most 38 digits.
    """
    counted = frequent(docs, longest, least, text_col, lang_col)
    word_count = F.col("phrase") == F.lit(b"")
    totals = counted.filter(word_count).select("lang", F.col("n").alias("total"))
    phrases = counted.filter(~word_count)
    turned = phrases.mapInArrow(_turned, COUNT)
    left = _stream(phrases, "prefixes").filter(F.size("cuts") > 0)
    right = _stream(turned, "suffixes").filter(F.size("cuts") > 0).mapInArrow(_back, _BACK)
    both = left.join(right.hint("merge"), ["lang", "phrase"]) \
               .select("lang", "phrase", F.col("n").alias("a"), F.col("cuts").alias("ls"), "rs", F.greatest("extension", "left").alias("longer")) \
               .filter(100 * F.col("longer") < share * F.col("a")).mapInArrow(_shown, _MERGED).join(totals, "lang")
    out = both.withColumn("best", least_cut()).select("lang", "phrase", "a", "best.l", "best.r", F.col("total").alias("n"), "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
