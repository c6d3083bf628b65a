"""Token-id files with Elias-Fano document boundaries, written and read back by Spark.

One file holds one block of consecutive documents (ascending id):

    0   8 bytes  magic "PPTOKEN1"
    8   8 bytes  part: number of the range partition, big-endian like all header fields
    16  8 bytes  ids in the part before this block
    24  8 bytes  ids in this block
    32  8 bytes  documents in this block
    40  8 bytes  of these, documents with a null id (they come first)
    48  8 bytes  smallest document id (two's complement)
    56  8 bytes  bytes of one id: 2 if the vocabulary fits, else 4
    64  ...      Elias-Fano: the n + 1 document boundaries (ids before each document)
        ...      Elias-Fano: document ids less the smallest
        ...      the ids, little-endian

Each part is a share of a range shuffle, so files of parts in order are the documents in
order.  Spark's writer commits the files (one row, one file), and ``binaryFile`` reads
them from any store Spark can reach.  A line feed after the last byte is the writer's.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planpulse.llm.bpe import Known, byte_symbols
from planpulse.llm.common import part_offsets, pick, rows_batch, scratch_path, slices, texts

MAGIC = b"PPTOKEN1"
HEADER = struct.Struct(">8sQQQQQqQ")
KNOWN_PIECES = 300_000   # remembered twice over, per Python worker
BLOCK_IDS = 2_000_000   # a block closes once it holds so many ids
WORD_END = re.compile(r"(?<=[^\s])[\t-\r ]")
#: The byte-level pieces (a fixed pattern), for texts of the characters that ODD leaves.
LETTERS = "A-Za-z" + "".join(map(chr, (0xAA, 0xB5, 0xBA))) + "".join(
    f"{chr(a)}-{chr(b)}" for a, b in ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F)))
NUMBERS = "0-9" + "".join(map(chr, (0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE)))
PIECE = re.compile(rf" ?[{LETTERS}]+| ?[{NUMBERS}]+|'(?:[stmd]|re|ve|ll)| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
#: All but ASCII, extended Latin, and common punctuation, without their unusual white space.
ODD = re.compile("[^%s]" % "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in (
    (0x00, 0x1B), (0x20, 0x84), (0x86, 0x9F), (0xA1, 0x24F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20B0))))
CHUNK = 1 << 20


class EliasFano:
    """A non-decreasing sequence of n integers up to u in about 2 + log2(u / n) bits each.

    The low bits of each value lie packed side by side; the high bits are a bit vector with
    a one at (high part + index).  ``select`` finds the i-th one from a sample kept for
    every ``EVERY``-th one, as 32-bit positions.
    """

    EVERY = 512

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = values.astype(np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.zeros(0, np.uint8)
        if bits:
            shifts = np.arange(bits - 1, -1, -1, dtype=np.uint64)
            low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8))
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        if n and int(ones[-1]) >= 1 << 32:
            raise ValueError("a block holds too many documents for 32-bit samples")
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        flags[ones] = 1
        return cls(n, bits, low, np.packbits(flags), ones[::cls.EVERY].astype("<u4"))

    def tobytes(self) -> bytes:
        return struct.pack(">QQQQ", self.n, self.low_bits, len(self.low), len(self.high)) \
            + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, bits, nl, nh = struct.unpack_from(">QQQQ", data, at)
        at += 32
        low = np.frombuffer(data, np.uint8, nl, at)
        high = np.frombuffer(data, np.uint8, nh, at + nl)
        k = -(-n // cls.EVERY)
        samples = np.frombuffer(data, "<u4", k, at + nl + nh)
        return cls(n, bits, low, high, samples), at + nl + nh + 4 * k

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for j in range(self.low_bits):
            bit = i * self.low_bits + j
            out = out << np.uint64(1) | ((self.low[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(np.uint64)
        return out

    def select(self, i: int) -> int:
        """The i-th value, reading one sample and the bits up to the next ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = int(self.samples[i // self.EVERY])
        left, byte = i % self.EVERY, start >> 3
        skip = start & 7
        while True:
            bits = np.unpackbits(self.high[byte:byte + 256])[skip:]
            ones = np.flatnonzero(bits)
            if left < len(ones):
                pos = byte * 8 + skip + int(ones[left])
                break
            left -= len(ones)
            byte, skip = byte + 256, 0
        return (pos - i) << self.low_bits | int(self._low(np.array([i], np.int64))[0])

    def select_range(self, a: int, b: int) -> np.ndarray:
        """The values from the a-th up to the b-th, reading the bits between the samples around them."""
        if not 0 <= a <= b <= self.n:
            raise IndexError((a, b))
        if a == b:
            return np.zeros(0, np.uint64)
        first, after = a // self.EVERY, -(-b // self.EVERY)
        start = int(self.samples[first])
        end = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        ones = start + np.flatnonzero(np.unpackbits(self.high[start >> 3:-(-end // 8)])[start & 7:])
        i = np.arange(a, b, dtype=np.int64)
        pos = ones[a - first * self.EVERY:b - first * self.EVERY]
        return (pos - i).astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)

    def values(self) -> np.ndarray:
        i = np.arange(self.n, dtype=np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high))[:self.n]
        return (ones - i).astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)


class Pieces:
    """Ids of texts through the library, with its results for common pieces remembered.

    A text is split as the vocabulary's own pattern does, and the library encodes each new
    piece; texts with other than the usual Latin characters, and those with special tokens,
    are given to the library whole.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        pre = spec["pre_tokenizer"] or {}
        self.split = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre["use_regex"] \
            and not pre["add_prefix_space"]
        self.symbols = byte_symbols()
        self.width = 2 if max(self.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.type = f"<u{self.width}"
        self.code = "H" if self.width == 2 else "I"
        self.model = self.library.model.tokenize
        self.known = Known(self.piece, KNOWN_PIECES)

    def whole(self, text: str) -> bytes:
        return array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, x: str) -> bytes:
        """The library's merges on the piece's bytes, written as its byte-level symbols."""
        plain = (x if x.isascii() else x.encode().decode("latin-1")).translate(self.symbols)
        return array(self.code, [t.id for t in self.model(plain)]).tobytes()

    def plain(self, text: str) -> bool:
        return self.split and "<|" not in text and not ODD.search(text)

    def encode(self, text: str) -> bytes:
        if not self.plain(text):
            return self.whole(text)
        ids, n = self.known.__getitem__, len(text)
        if n <= CHUNK:
            return b"".join(map(ids, PIECE.findall(text)))
        parts, at = [], 0
        while at < n:
            m = WORD_END.search(text, at + CHUNK)   # up to white space that follows a word: no piece spans that place
            end = m.start() if m else n
            parts.append(b"".join(map(ids, PIECE.findall(text, at, end))))
            at = end
        return b"".join(parts)


@functools.lru_cache(maxsize=2)
def pieces(path: str, end_id: int) -> Pieces:
    return Pieces(path, end_id)


class Block:
    """Documents gathered for one file."""

    def __init__(self, part: int, before: int, width: int):
        self.part, self.before, self.width = part, before, width
        self.ids, self.doc_ids, self.nulls, self.bounds = [], [], 0, [0]

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)
        self.ids.append(ids)
        self.bounds.append(self.bounds[-1] + len(ids) // self.width)

    def tobytes(self) -> bytes:
        docs = np.array(self.doc_ids, np.int64)
        least = int(docs[0]) if len(docs) else 0
        head = HEADER.pack(MAGIC, self.part, self.before, self.bounds[-1], len(self.bounds) - 1, self.nulls,
                           least, self.width)
        above = docs.astype(np.uint64) - np.int64(least).astype(np.uint64)
        return b"".join([head, EliasFano.of(np.array(self.bounds)).tobytes(), EliasFano.of(above).tobytes(),
                         *self.ids])


class Reader:
    """One file's documents: ids by position, offsets through ``select``."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, self.part, self.before, self.n_ids, self.n, self.nulls, self.least, width = HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.bounds, at = EliasFano.read(view, HEADER.size)
        self.above, at = EliasFano.read(view, at)
        self.ids = np.frombuffer(view, f"<u{width}", self.n_ids, at)

    def doc_ids(self, a: int = 0, b: int | None = None) -> list[int | None]:
        b = self.n if b is None else b
        v = self.above.select_range(max(0, a - self.nulls), max(0, b - self.nulls))
        v = (v + np.int64(self.least).astype(np.uint64)).astype(np.int64)
        return [None] * (min(b, self.nulls) - min(a, self.nulls)) + v.tolist()

    def rows(self) -> Iterator[list]:
        """``doc_id, at, n_tokens, ids_crc32`` as columns, as many documents at once as share a sample."""
        for a, b in slices(self.n, EliasFano.EVERY):
            bounds = self.bounds.select_range(a, b + 1).astype(np.int64)
            ids = self.ids[bounds[0]:bounds[-1]].astype("<u4")
            at = (bounds - bounds[0]).tolist()
            crc = [zlib.crc32(ids[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
            yield [self.doc_ids(a, b), bounds[:-1] + self.before, np.diff(bounds), crc]

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of each text plus ``end_id`` to token files in ``path``.

    Raw rows are range partitioned by id (then by a hash of the text, so that repeated ids
    have one order), encoded where they land, and written block by block: a task holds one
    block.  Null text is empty; null ids come first; an empty table writes no block.
    """
    order = ["doc_id", "_tie"]
    rows = pick(docs, id_col, text_col).withColumn("_tie", F.xxhash64("text"))
    ranged = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]) \
                 .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order]).select("doc_id", "text")
    schema = pa.schema([("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(tokenizer, end_id)
        end = np.array([end_id], known.type).tobytes()
        block = Block(TaskContext.get().partitionId(), 0, known.width)
        for batch in batches:
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                block.add(doc_id, known.encode(data.decode()) + end)
                if block.bounds[-1] >= block_ids:
                    yield rows_batch(schema, [[block.tobytes()]])
                    block = Block(block.part, block.before + block.bounds[-1], known.width)
        if block.bounds[-1]:
            yield rows_batch(schema, [[block.tobytes()]])

    ranged.mapInArrow(run, "block binary").select(F.col("block").cast("string").alias("value")) \
          .write.option("maxRecordsPerFile", 1).text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Read token files back: ``doc_id, start, n_tokens, ids_crc32`` per document.

    ``start`` counts the ids of all documents before.  Offsets between parts come from the
    headers: one row per range partition, which bounds the window and the broadcast.
    """
    files = spark.read.format("binaryFile").load(path).select("content") \
                 .filter(F.length("content") >= HEADER.size)

    def field(at: int):
        return F.conv(F.hex(F.substring("content", at + 1, 8)), 16, 10).cast("bigint")

    totals = files.select(field(8).alias("_part"), field(24).alias("_n")).groupBy("_part").agg(F.sum("_n").alias("_n"))
    base = part_offsets(totals, [], {"_n": "_base"})
    schema = pa.schema([("_part", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                r = Reader(data.as_buffer())
                for columns in r.rows():
                    yield rows_batch(schema, [np.full(len(columns[0]), r.part), *columns])

    rows = files.mapInArrow(run, "_part bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(F.broadcast(base), "_part").select(
        "doc_id", (F.col("_base") + F.col("at")).cast("bigint").alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None, **more) -> DataFrame:
    """``write_tokens`` to ``path`` (a new folder below the shared one if none) and ``read_tokens``."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, tokenizer, path, end_id, **more)
    return read_tokens(spark, path)
