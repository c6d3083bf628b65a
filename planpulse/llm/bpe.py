"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

``load(path)`` parses a public ``tokenizers`` JSON file (byte-level BPE, with or without
a word-end suffix).  From its merge list it computes the *sufficient lookahead*: how many
symbols right of a token can still change it.  Symbols are pushed through a window; tokens
that end at least that far from the window's right edge are stable and are emitted, the
rest stays in the window.  So memory is constant in the length of a text, even of one
with no white space at all.

Why the bound holds.  Take two inputs that agree on their first p symbols.  While rules
are applied in rank order, both runs agree left of a frontier that starts at p.  A rule
(u, v) moves the frontier left by |u| only if u is the last token left of it and v stands
right of it in one run; after a rule (u, v) moved it, what stands right of it starts with
u, so a later rule (u2, v2) can move it again only if v2 starts with u.  The longest such
chain of rising ranks, weighted by |u|, is the lookahead.  It needs every rule to rank
after the rules that make its parts, which ``load`` checks (else whole pieces are kept).
A text right of a token boundary is encoded as if the text left of it were not there,
because no rule merged across that boundary.

Pieces repeat: what the transducer gave for a short one is remembered in bounded tables per
Python worker, and a text is the ids of its pieces.  Neighbouring texts are cut into pieces
together, as arrays of bytes (``Cutter``); only words with characters beyond its tables are
normalised and split one by one.  The new pieces of neighbouring texts are one stream of
symbols, in which no rule crosses the end of a piece: a token is stable, too, once that end
stands in the window.  Inside a window all short pieces are merged together in numpy.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from planpulse.llm.common import pick, rows_batch, slices, texts

CHUNK = 1 << 20      # bytes of text looked at together
LONG_WORD = 1024     # longer words (no ASCII white space) go through the open-ended path
CACHED_WORDS = 300_000
SHORT = 64           # longer words and pieces are not remembered
GROUP = 1 << 22      # bytes of text that are cut, and whose new pieces are encoded, together
WINDOW = 1 << 16     # symbols the transducer looks at together
MANY = 256           # symbols of a piece that is merged alone
FEW = 1024           # symbols of a window whose pieces are merged one by one
NONE = np.int32(2**31 - 1)
ALL = np.uint64(2**64 - 1)
SPACE = re.compile(rb"[\t-\r ]")
#: Words of these code points are normalised and split here; any other word by the library's own steps.
PLAIN = re.compile("[!-~%s-%s]*" % (chr(0xA1), chr(0x24F)))
#: The splitter that ``Cutter`` follows: endings after an apostrophe, letters, single digits, all else.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BLANK, LETTER, DIGIT, OTHER, FOREIGN = range(5)


def byte_symbols() -> dict[int, str]:
    """Byte -> printable character, by the byte-level rule: printable Latin-1 stands for
    itself, all others are numbered from 256 on."""
    out = {b: chr(b) for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    rest = [b for b in range(256) if b not in out]
    out.update({b: chr(256 + i) for i, b in enumerate(rest)})
    return out


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int | None:
    """Longest chain, in symbols, by which a change on the right can travel left.

    None if a rule's part is made by a later rule: then no bound is claimed.
    """
    made: dict[str, int] = {}
    for rank, (u, v) in enumerate(merges):
        made[u + v] = rank
    chain: dict[str, int] = {}
    longest = 0
    for rank, (u, v) in enumerate(merges):
        if max(made.get(u, -1), made.get(v, -1)) >= rank:
            return None
        here = len(u) + max((chain.get(v[:i], 0) for i in range(1, len(v) + 1)), default=0)
        if here > chain.get(u, 0):
            chain[u] = here
        longest = max(longest, here)
    return longest


class PairTable:
    """(left id, right id) -> rank and merged id, for arrays, by two levels of hashing."""

    BITS = 20

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        keys = np.array([a << 32 | b for a, b in pairs], np.uint64)
        values = np.array(list(pairs.values()), np.int64).reshape(-1, 2)
        self.new = np.zeros(len(keys) + 1, np.int64)
        self.new[values[:, 0]] = values[:, 1]
        self.levels = []
        rng = np.random.default_rng(1)
        while len(keys):   # what collides goes to the next level
            factor = np.uint64(int(rng.integers(1 << 62, 1 << 63)) | 1)
            at = self._slot(keys, factor)
            table, rank = np.full(1 << self.BITS, ALL, np.uint64), np.zeros(1 << self.BITS, np.int32)
            at, first = np.unique(at, return_index=True)
            table[at], rank[at] = keys[first], values[first, 0]
            self.levels.append((factor, table, rank))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]

    def _slot(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((keys ^ keys >> np.uint64(15)) * factor >> np.uint64(64 - self.BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE if no rule has it."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        out = np.full(len(keys), NONE, np.int32)
        for factor, table, rank in self.levels:
            at = self._slot(keys, factor)
            same = table[at] == keys
            out[same] = rank[at[same]]
        return out


class Known(dict):
    """A bounded table in two generations: when the young one is full, it becomes the old."""

    def __init__(self, make, size: int | None = None):
        super().__init__()
        self.make, self.size, self.old = make, size or CACHED_WORDS, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= SHORT:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def put_all(self, more: dict) -> None:
        if len(self) + len(more) > self.size:
            self.old = dict(self)
            self.clear()
        self.update(more)

    def new(self, keys: Iterable) -> list:
        """Those of ``keys`` that neither generation has."""
        return list(itertools.filterfalse(self.old.__contains__, itertools.filterfalse(self.__contains__, keys)))


class Cutter:
    """Cuts words into the pieces of ``SPLIT``, many texts at once, as arrays of bytes.

    It knows the ``PLAIN`` code points that have one of them, as long in UTF-8, as lower
    case.  A word with any other (FOREIGN) or with the beginning of a special token stays
    whole and as it is; no piece holds either, so the two cannot be mistaken.
    """

    def __init__(self, lower: bool):
        kind = np.full(0x280, FOREIGN, np.uint8)   # by code point; 0x27F is the last whose lead byte is 0xC9
        low = np.arange(0x280, dtype=np.uint16)
        for i in range(0x250):
            c = chr(i).lower() if lower else chr(i)
            if i < 128 and SPACE.fullmatch(bytes([i])):
                kind[i] = BLANK
            elif PLAIN.fullmatch(chr(i)) and len(c) == 1 and PLAIN.fullmatch(c) and (ord(c) < 128) == (i < 128):
                kind[i] = LETTER if regex.match(r"\p{L}", c) else DIGIT if regex.match(r"\p{N}", c) else OTHER
                low[i] = ord(c)
        self.kind, self.low = kind, low
        self.byte_kind = np.append(kind[:128], np.full(128, FOREIGN, np.uint8))
        self.byte_low = np.append(low[:128], np.arange(128, 256)).astype(np.uint8)
        known = "".join(re.escape(chr(i)) for i in range(0x250) if kind[i] in (LETTER, DIGIT, OTHER))
        self.foreign = re.compile(r"[^%s\n]|<\|" % known)

    def pieces(self, words: list[bytes]) -> list[bytes]:
        """Those of the results of ``cut`` that are pieces, not whole words."""
        lines = b"\n".join(words).decode()
        if not self.foreign.search(lines):
            return words
        return [w for w, s in zip(words, lines.split("\n"), strict=True) if not self.foreign.search(s)]

    def cut(self, many: list[bytes]) -> Iterator[list[bytes]]:
        """For each text, its pieces and the words that stay whole, in order."""
        data = np.frombuffer(b" ".join([*many, b""]), np.uint8)   # every text ends in a blank
        kind, low = self.byte_kind[data], self.byte_low[data]
        two = np.flatnonzero((data >= 0xC2) & (data <= 0xC9))
        two = two[data[two + 1] & 0xC0 == 0x80]
        code = (data[two] & 0x1F).astype(np.uint16) << 6 | data[two + 1] & 0x3F
        kind[two] = kind[two + 1] = self.kind[code]
        code = self.low[code]
        low[two], low[two + 1] = 0xC0 | code >> 6, 0x80 | code & 0x3F

        begins = np.zeros(len(data), bool)   # a piece, inside of a word
        before, here = kind[:-1], kind[1:]
        begins[1:] = ((before != here) | (here == DIGIT)) & (before != BLANK) & (here != BLANK)
        begins[two + 1] = False
        mark = np.flatnonzero(data == ord("'"))
        mark = mark[(kind[mark + 1] == LETTER) & (kind[mark - 1] != OTHER)]   # before the first byte stands the last: a blank
        first, second = low[mark + 1], low[np.minimum(mark + 2, len(data) - 1)]
        one = np.isin(first, list(b"stmd"))
        ends = one | np.isin(first, list(b"rv")) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        after = (mark + 3 - one)[ends]
        begins[mark[ends] + 1] = False
        begins[after] = kind[after] != BLANK

        whole = kind == FOREIGN
        whole[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        if whole.any():
            blanks = np.flatnonzero(kind == BLANK)
            word = np.unique(np.searchsorted(blanks, np.flatnonzero(whole)))
            turn = np.zeros(len(data), np.int8)
            turn[np.where(word > 0, blanks[word - 1] + 1, 0)] = 1
            turn[blanks[word]] = -1
            whole = np.cumsum(turn, dtype=np.int8).view(bool)
            begins &= ~whole
            low = np.where(whole, data, low)

        at = np.flatnonzero(begins)
        out, kept = np.full(len(data) + len(at), ord(" "), np.uint8), np.ones(len(data) + len(at), bool)
        kept[at + np.arange(len(at))] = False
        out[kept] = low
        stops = np.cumsum(np.fromiter(map(len, many), np.int64, len(many)) + 1)
        stops += np.searchsorted(at, stops)
        out = out.tobytes()
        start = 0
        for stop in stops.tolist():
            yield out[start:stop].split()
            start = stop


class Bpe:
    """A parsed merge list with its transducer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path}: not a byte-level BPE model")
        from tokenizers import Tokenizer  # its normaliser and splitter, for words that are not PLAIN
        self.library = Tokenizer.from_file(path)
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.suffix = suffix
        self.byte_level_decoder = bool(spec.get("decoder"))
        symbol = byte_symbols()
        self.symbol_byte = {c: b for b, c in symbol.items()}
        self.inner = [vocab[symbol[b]] for b in range(256)]
        self.last = [vocab[symbol[b] + suffix] for b in range(256)]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        self.pairs = {(vocab[u], vocab[v]): (rank, vocab[u + v]) for rank, (u, v) in enumerate(merges)}
        self.lookahead = sufficient_lookahead(merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile(("(%s)" % "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))).encode()) \
            if self.special else None
        self.lower = "Lowercase" in json.dumps(spec.get("normalizer"))
        pre = spec["pre_tokenizer"]
        splits = [p for p in pre.get("pretokenizers", [pre]) if p["type"] == "Split"]
        self.word_split = bool(splits)
        if splits:
            self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
        #: Other splitters, or special tokens that begin in another way: every word is split by itself.
        self.cutter = Cutter(self.lower) if splits and self.pattern.pattern == SPLIT \
            and all("<|" in t for t in self.special) else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        strings = [""] * size
        for token, i in vocab.items():
            strings[i] = token
        for token, i in self.special.items():
            strings[i] = token
        self.longest = max(map(len, strings))
        if self.byte_level_decoder:
            self.table = [bytes(self.symbol_byte[c] for c in s) if all(c in self.symbol_byte for c in s) else s.encode()
                          for s in strings]
        else:
            self.table = [s.encode() for s in strings]
        self.window = max(WINDOW, 4 * (self.lookahead or 0))
        self.lengths = np.array([len(t) - (len(suffix) if suffix and t.endswith(suffix) else 0) for t in strings])
        self.emitted = {"lookahead": 0, "end of piece": 0}   # by which rule tokens became stable
        self.table_of_pairs = PairTable(self.pairs)
        self.inner_ids, self.last_ids = np.array(self.inner), np.array(self.last)
        self.pieces = Known(self._piece, CACHED_WORDS // 2)
        self.words = Known(self._word)   # of whole words, and of the pieces that the cutter gives

    # ------------------------------------------------------------ one window
    def merge(self, ids: list[int]) -> list[int]:
        """Apply the rules in rank order, leftmost first, to a window of symbols."""
        pairs = self.pairs
        if len(ids) > 48:
            return self._merge_long(ids)
        while len(ids) > 1:
            best = None
            for p in zip(ids, ids[1:]):
                r = pairs.get(p)
                if r is not None and (best is None or r < best):
                    best, at = r, p
            if best is None:
                break
            a, b = at
            new, out, i, n = best[1], [], 0, len(ids)
            while i < n:
                if ids[i] == a and i + 1 < n and ids[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        pairs, n = self.pairs, len(ids)
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, ids[i], ids[i + 1], r[1]) for i in range(n - 1) if (r := pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if r := pairs.get((new, ids[k])):
                    heapq.heappush(heap, (r[0], i, new, ids[k], r[1]))
            if (h := before[i]) >= 0 and (r := pairs.get((ids[h], new))):
                heapq.heappush(heap, (r[0], h, ids[h], new, r[1]))
        return [x for x in ids if x >= 0]

    # -------------------------------------------------------- the transducer
    def stream(self, parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Push symbols through the window; yields tokens once they are stable.

        A part is (symbol ids, whether each ends its piece); pieces of any number and length
        follow one another.  Yields (tokens, whether each ends its piece).  At most a window
        of symbols is held beside the part just read.
        """
        held, ends = np.zeros(0, np.int64), np.zeros(0, bool)
        full = self.window
        for ids, last in parts:
            held, ends = (np.concatenate([held, ids]), np.concatenate([ends, last])) if len(held) else (ids, last)
            while len(held) >= full:
                tokens, closed, at = self.stable(held[:full], ends[:full])
                yield tokens, closed
                held, ends = held[at:], ends[at:]
                full = self.window if at else 2 * full   # grows only where no lookahead is known
        if len(held):
            tokens, closed, at = self.stable(held, ends)
            if at < len(held):
                raise ValueError("the last piece has no end")
            yield tokens, closed

    def stable(self, ids: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The tokens of a window that no symbol right of it can change, and their symbols' number.

        A token is stable if it ends the lookahead before the window's edge, or if the end
        of its piece stands in the window: no rule crosses that.
        """
        n = len(ids)
        closed = n - int(np.argmax(last[::-1])) if last.any() else 0
        ahead = n - self.lookahead if self.lookahead is not None else 0
        tokens, ends = self.merge_window(ids, last)
        at = np.cumsum(self.lengths[tokens])
        k = int(np.searchsorted(at, max(closed, ahead), "right"))
        by_ahead = int(np.searchsorted(at, ahead, "right"))
        self.emitted["lookahead"] += min(k, by_ahead)
        self.emitted["end of piece"] += k - min(k, by_ahead)
        return tokens[:k], ends[:k], int(at[k - 1]) if k else 0

    def merge_window(self, ids: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apply the rules to every piece of a window; (tokens, whether each ends its piece).

        Long pieces go one by one, all short ones together: in each round every piece's
        best pair is merged.
        """
        stops = np.flatnonzero(last) + 1
        if not len(stops) or stops[-1] < len(ids):
            stops = np.append(stops, len(ids))     # the piece that is still open
        lens = np.diff(stops, prepend=0)
        alone = lens > (MANY if len(ids) > FEW else 0)
        owners, tokens = [], []
        for i in np.flatnonzero(alone).tolist():
            got = self.merge(ids[stops[i] - lens[i]:stops[i]].tolist())
            tokens.append(np.array(got, np.int64))
            owners.append(np.full(len(got), i))
        if not alone.all():
            short = np.repeat(~alone, lens)
            edge = np.zeros(len(ids), bool)
            edge[stops - 1] = True
            for owner, got in self._merge_short(ids[short], edge[short], np.repeat(np.arange(len(lens)), lens)[short]):
                owners.append(owner)
                tokens.append(got)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        owner, out = owner[order], np.concatenate(tokens)[order]
        ends = np.append(owner[1:] != owner[:-1], last[-1])
        return out, ends

    def _merge_short(self, ids: np.ndarray, last: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        pairs = self.table_of_pairs
        rank = np.full(len(ids), NONE, np.int32)
        inside = np.flatnonzero(~last)
        rank[inside] = pairs.ranks(ids[inside], ids[inside + 1])
        while len(ids):
            ends = np.flatnonzero(last)
            starts = np.concatenate([[0], ends[:-1] + 1])
            best = np.minimum.reduceat(rank, starts)
            size = ends - starts + 1
            best_at = np.repeat(best, size)
            open_ = best_at != NONE
            if not open_.all():
                yield owner[~open_], ids[~open_]
                ids, owner, rank, last, best_at = (x[open_] for x in (ids, owner, rank, last, best_at))
                if not len(ids):
                    break
            at = np.flatnonzero(rank == best_at)
            if (np.diff(at) == 1).any():   # a run of the same token: leftmost pairs first
                run = np.cumsum(np.concatenate([[True], np.diff(at) != 1]))
                at = at[(np.arange(len(at)) - np.searchsorted(run, run, "left")) % 2 == 0]
            ids = ids.copy()
            ids[at] = pairs.new[rank[at]]
            last[at] = last[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))
            ids, owner, rank, last = ids[keep], owner[keep], rank[keep], last[keep]
            for p in (at[~last[at]], at[(at > 0) & ~last[at - 1]] - 1):
                rank[p] = pairs.ranks(ids[p], ids[p + 1])
            rank[at[last[at]]] = NONE

    def _length(self, token: int) -> int:
        return int(self.lengths[token])

    def transduce(self, parts: Iterable[bytes]) -> Iterator[int]:
        """Ids of one piece whose bytes arrive in parts; emits each token once it is stable."""
        for tokens, _ in self.stream(self._symbols(parts)):
            yield from tokens.tolist()

    def _symbols(self, parts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The symbols of one piece: its last byte, which may have a symbol of its own, waits for the end."""
        final = b""
        for part in parts:
            part = final + part
            final = part[-1:]
            if len(part) > 1:
                yield self.inner_ids[np.frombuffer(part, np.uint8)[:-1]], np.zeros(len(part) - 1, bool)
        if final:
            yield self.last_ids[np.frombuffer(final, np.uint8)], np.ones(1, bool)

    # ------------------------------------------------------- pieces and words
    def _piece(self, b: bytes) -> bytes:
        if len(b) > FEW:
            return self.merge_all([b])[0]
        ids = self.merge([self.inner[x] for x in b[:-1]] + [self.last[b[-1]]])   # its end stands in the window
        self.emitted["end of piece"] += len(ids)
        return np.array(ids, "<u4").tobytes()

    def piece(self, b: bytes) -> bytes:
        return self.pieces[b]

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of many pieces, streamed through the window one after another."""
        if not pieces:
            return []
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        last = np.zeros(len(flat), bool)
        last[np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))) - 1] = True
        got = list(self.stream(
            (np.where(last[a:b], self.last_ids[flat[a:b]], self.inner_ids[flat[a:b]]), last[a:b])
            for a, b in slices(len(flat), self.window)))
        data = np.concatenate([x for x, _ in got]).astype("<u4").tobytes()
        stops = (4 * (np.flatnonzero(np.concatenate([x for _, x in got])) + 1)).tolist()
        return [data[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _word(self, w: bytes) -> bytes:
        if self.cutter and self.cutter.pieces([w]):
            return self._piece(w)
        return self.word(w) if len(w) <= LONG_WORD else b"".join(self.long_word(w, 0, len(w)))

    def cut(self, many: list[bytes]) -> Iterator[list[bytes]]:
        """For each text, its pieces, and its words that have to be split by themselves."""
        return self.cutter.cut(many) if self.cutter else map(bytes.split, many)

    def learn(self, words: Iterable[bytes]) -> None:
        """Encode the new short pieces among ``words`` together (others wait for their turn)."""
        if self.cutter:
            new = self.cutter.pieces([w for w in self.words.new(words) if len(w) <= SHORT])
            self.words.put_all(dict(zip(new, self.merge_all(new), strict=True)))

    def word(self, w: bytes) -> bytes:
        """Ids (little-endian 32 bit) of a run without ASCII white space."""
        if self.special_at and self.special_at.search(w):
            return b"".join(np.array([self.special[x.decode()]], "<u4").tobytes() if i % 2 else self.word(x)
                            for i, x in enumerate(self.special_at.split(w)) if x)
        s = w.decode()
        if PLAIN.fullmatch(s):
            return b"".join(self.piece(p.encode()) for p in self.pattern.findall(s.lower() if self.lower else s))
        if self.library.normalizer:
            s = self.library.normalizer.normalize_str(s)
        back = self.symbol_byte
        return b"".join(self.piece(bytes(back[c] for c in p)) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(s))

    def long_word(self, data: bytes, start: int, end: int) -> Iterator[bytes]:
        """The same for a run of any length, in bounded memory."""
        cut = 0
        for m in [*self.special_at.finditer(data, start, end)] if self.special_at else []:
            yield from self._section(data, start if not cut else cut, m.start())
            yield np.array([self.special[m[0].decode()]], "<u4").tobytes()
            cut = m.end()
        yield from self._section(data, cut or start, end)

    def _section(self, data: bytes, start: int, end: int) -> Iterator[bytes]:
        for piece in _pieces(self.pattern, self._normal(data, start, end)):
            ids: list[int] = []
            for token in self.transduce(s.encode() for s in piece):
                ids.append(token)
                if len(ids) >= 4096:
                    yield np.array(ids, "<u4").tobytes()
                    ids = []
            yield np.array(ids, "<u4").tobytes()

    def _normal(self, data: bytes, start: int, end: int) -> Iterator[str]:
        """Normalised slices; cut only where no character joins with the next."""
        decode = codecs.getincrementaldecoder("utf-8")().decode
        held = ""
        for a in range(start, end, CHUNK // 16):
            b = min(end, a + CHUNK // 16)
            held += decode(data[a:b], b == end)
            cut = len(held)
            if b < end:
                cut -= 1
                while cut > 0 and not _starts(held[cut]):
                    cut -= 1
            if cut:
                s, held = held[:cut], held[cut:]
                yield self.library.normalizer.normalize_str(s) if self.library.normalizer else s

    # ------------------------------------------------------------------ texts
    def encode_parts(self, data: bytes) -> Iterator[bytes]:
        """Ids of a text, in parts, as little-endian 32-bit integers.

        White space always ends a piece here, so words are independent.
        """
        if not self.word_split:
            raise ValueError("white space is part of this vocabulary's pieces")
        words, at, n = self.words, 0, len(data)
        while at < n:
            end = min(n, at + CHUNK)
            if end < n:
                m = SPACE.search(data, end, end + CHUNK)
                if m:
                    end = m.start()
                elif not SPACE.search(data, at, end):
                    m = SPACE.search(data, end)
                    end = m.start() if m else n
                    yield from self.long_word(data, at, end)
                    at = end
                    continue
                else:
                    while data[end - 1] not in b"\t\n\v\f\r ":
                        end -= 1
            split, = self.cut([data[at:end]])
            self.learn(set(split))
            yield b"".join(map(words.__getitem__, split))
            at = end

    def encode_many(self, many: list[bytes]) -> Iterator[Iterable[bytes]]:
        """For each text, its ids in parts; neighbouring texts are cut, and their new pieces learnt, together."""
        at = 0
        while at < len(many):
            if len(many[at]) > CHUNK:
                yield self.encode_parts(many[at])
                at += 1
                continue
            start, size = at, 0
            while at < len(many) and size + len(many[at]) <= GROUP and len(many[at]) <= CHUNK:
                size += len(many[at])
                at += 1
            split = list(self.cut(many[start:at]))
            self.learn(set().union(*split))
            for i, words in enumerate(split):
                split[i] = None
                yield [b"".join(map(self.words.__getitem__, words))]

    def encode(self, data: bytes) -> bytes:
        return b"".join(self.encode_parts(data))

    def decoder(self) -> Decoder:
        return Decoder(self)


def _starts(c: str) -> bool:
    """Whether a character never composes with what stands before it."""
    return unicodedata.category(c)[0] != "M" and not 0x1160 <= ord(c) <= 0x11FF


_LETTERS, _OTHERS = regex.compile(r"\p{L}+"), regex.compile(r"[^\s\p{L}\p{N}]+")


def _pieces(pattern, parts: Iterator[str]) -> Iterator[Iterator[str]]:
    """Split a stream of text; each piece is an iterator of its parts (read it to its end)."""
    buf, done = "", False

    def more() -> bool:
        nonlocal buf, done
        s = next(parts, None)
        done = s is None
        buf += s or ""
        return not done

    def run(m, kind) -> Iterator[str]:
        nonlocal buf
        buf = buf[m.end():]
        yield m[0]
        while not buf and more() and (x := kind.match(buf)):
            buf = buf[x.end():]
            yield x[0]

    while buf or more():
        at = 0
        for m in pattern.finditer(buf):
            if m.end() == len(buf) and not done:
                break
            at = m.end()
            yield iter([m[0]])
        else:
            buf = ""
            continue
        buf = buf[m.start():]
        if len(buf) <= 8:
            if not more():
                continue
        else:
            m = pattern.match(buf)
            kind = _LETTERS if _LETTERS.match(buf) else _OTHERS
            yield run(m, kind)


class Decoder:
    """Ids to text, incrementally: bytes of an unfinished character wait for the next ids.

    Vocabularies with a byte-level decoder give the bytes their symbols stand for (wrong
    sequences become U+FFFD, one per maximal part); those with none give their token
    strings, joined by single spaces.
    """

    def __init__(self, bpe: Bpe):
        self.table, self.joined = bpe.table, not bpe.byte_level_decoder
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: Iterable[int], final: bool = False) -> str:
        got = list(map(self.table.__getitem__, ids))
        sep = b" " if self.joined else b""
        data = sep.join(got)
        if self.joined and got:
            data, self.begun = (sep if self.begun else b"") + data, True
        return self.state.decode(data, final)


@functools.lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text, decode the ids again, and return digests of both.

    ``path`` is a tokenizer file that every executor can read.  One narrow pass; ids and
    decoded text are hashed part by part, so a text's ids are never held together.
    Null and empty text: no tokens, digests of nothing.  Null ids and repeated rows are
    kept as they are; further columns are ignored; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            n, ids_hex, text_hex = [], [], []
            for parts in bpe.encode_many(texts(batch)):
                count, ids_sha, text_sha, back = 0, hashlib.sha256(), hashlib.sha256(), bpe.decoder()
                for part in parts:
                    count += len(part) // 4
                    ids_sha.update(part)
                    text_sha.update(back.feed(np.frombuffer(part, "<u4").tolist()).encode())
                text_sha.update(back.feed([], True).encode())
                n.append(count)
                ids_hex.append(ids_sha.hexdigest())
                text_hex.append(text_sha.hexdigest())
            yield rows_batch(ENCODED, [batch.column("doc_id"), n, ids_hex, text_hex])

    return pick(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids themselves: ``doc_id, ids`` with ids as an array of int."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            yield rows_batch(schema, [batch.column("doc_id"),
                                      [np.frombuffer(b"".join(x), "<i4") for x in bpe.encode_many(texts(batch))]])

    return pick(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids",
               step: int = 4096) -> DataFrame:
    """``doc_id, text`` of ``encode_ids`` rows; null ids give an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                back, ids = bpe.decoder(), ids or []
                out.append("".join([back.feed(ids[a:a + step]) for a in range(0, len(ids), step)]
                                   + [back.feed([], True)]))
            yield rows_batch(schema, [batch.column("doc_id"), out])

    from pyspark.sql import functions as F
    return encoded.select(F.col(id_col).cast("bigint").alias("doc_id"),
                          F.col(ids_col).cast("array<int>").alias("ids")) \
                  .mapInArrow(run, "doc_id bigint, text string")
