"""Best-fit packing of token sequences with certified bin counts.

Documents become pieces of at most ``capacity`` tokens, and pieces are dealt evenly over
tasks.  Each task packs its share with best-fit decreasing and computes a lower bound on
any packing of that share from dual-feasible functions.  If the two agree, the count is
certified.  Tasks with a gap give the pieces of their bins that are not full back, certified
tasks those of their emptiest bin; these are dealt anew, mixed with the others', and packed
again.  A round that does not save bins is dropped and ends the exchange.

Only lengths decide, so the rows that move are a few numbers each.  A task holds
``PART_ITEMS`` of them at most on average; every round is one round-robin shuffle, which no
hot document id or length can skew, and its result is a written table.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse.llm.bpe import load
from planpulse.llm.common import pick, rows_batch, texts, to_scratch

PART_ITEMS = 50_000


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins that any packing needs, as far as dual-feasible functions show.

    f maps lengths so that no set that fits a bin sums over the capacity; the sum of f over
    the capacity is then a bound.  Used: the identity; for each l up to half the capacity,
    "over capacity - l counts whole, under l nothing"; and for k = 1..16 the rounding
    x -> floor((k + 1) x / capacity) / k (x itself where (k + 1) x / capacity is whole).
    """
    if not len(lengths):
        return 0
    c = capacity
    count = np.bincount(lengths, minlength=c + 1).astype(np.int64)
    size = np.arange(c + 1, dtype=np.int64)
    mass = np.concatenate([[0], np.cumsum(count * size)])   # mass[i]: of lengths under i
    many = np.concatenate([[0], np.cumsum(count)])
    best = -(-int(mass[-1]) // c)
    cut = np.arange(0, c // 2 + 1)
    whole = many[-1] - many[c - cut + 1]
    middle = mass[c - cut + 1] - mass[cut]
    best = max(best, int((whole + -(-middle // c)).max()))
    for k in range(1, 17):
        scaled = (k + 1) * size
        f = np.where(scaled % c == 0, size * k, scaled // c * c)   # in units of capacity * k
        best = max(best, -(-int((f * count).sum()) // (c * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and each bin's fill.

    Open bins are kept by the room they have left; a bit mask over rooms finds the least
    room that suffices in one step.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        if room > n:
            by_room[room - n].append(b)
            mask |= 1 << (room - n)
    return bins, offsets, np.array(fills, np.int64)


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """Pieces of each text's ids plus ``end_id``: ``doc_id, piece, start, length, ids_crc32``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end, size = load(tokenizer), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            out: list[list] = [[], [], [], [], []]

            def emit(doc_id, k, part, out=out):
                for column, x in zip(out, (doc_id, k, k * capacity, len(part) // 4, zlib.crc32(part)), strict=True):
                    column.append(x)

            for doc_id, parts in zip(batch.column("doc_id").to_pylist(), bpe.encode_many(texts(batch)), strict=True):
                k, held = 0, b""
                for part in parts:
                    held += part
                    at = 0
                    while len(held) - at > size:
                        emit(doc_id, k, held[at:at + size])
                        k, at = k + 1, at + size
                    held = held[at:]
                held += end
                for at in range(0, len(held), size):
                    emit(doc_id, k, held[at:at + size])
                    k += 1
            yield rows_batch(PIECES, out)

    return pick(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def _deal(items: DataFrame, capacity: int, turn: int, parts: int) -> DataFrame:
    """One round: deal ``items`` evenly over ``parts`` tasks, pack each share, write the result."""
    names = items.columns
    schema = items.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        lengths = table.column("length").to_numpy().astype(np.int64)
        bins, offsets, fills = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        part = TaskContext.get().partitionId()
        again = fills[bins] < capacity if len(fills) > bound else bins == int(fills.argmin())
        n = table.num_rows
        more = {"sequence_id": (turn << 56) | (part << 28) | bins, "offset": offsets, "certified": np.full(n, len(fills) <= bound),
                "_again": again & (fills[bins] < capacity)}
        for k, v in more.items():
            table = table.append_column(k, pa.array(v))
        yield from table.to_batches(max_chunksize=10_000)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    packed = items.select(*names).repartition(parts).mapInArrow(
        run, f"{fields}, sequence_id bigint, offset bigint, certified boolean, _again boolean")
    return to_scratch(packed, f"round{turn}")


def pack(items: DataFrame, capacity: int, part_items: int = PART_ITEMS, rounds: int | None = None) -> DataFrame:
    """Pack rows with a ``length`` column (1 to ``capacity``) into sequences.

    Returns the rows with ``sequence_id``, ``offset`` (gapless from 0 in a sequence) and
    ``certified``: the task that packed the row used as few sequences as its bound proves
    are needed.  Equal lengths and repeated rows are packed one by one; no rows give no
    sequences.  The exchange goes on while it saves sequences: it ends when a round saves
    none or one task holds all that is left (or after ``rounds``, if given).
    """
    pool = to_scratch(items, "pieces")
    n = pool.count()
    settled: list[DataFrame] = []
    best_bins: int | None = None
    while n and (rounds is None or len(settled) < rounds):
        parts = max(1, -(-n // part_items))
        packed = _deal(pool, capacity, len(settled), parts)
        if best_bins is not None:
            if packed.select("sequence_id").distinct().count() >= best_bins:
                break
            settled[-1] = settled[-1].filter(~F.col("_again"))
        settled.append(packed)
        if parts == 1:
            break
        again = packed.filter("_again")
        n, best_bins = again.agg(F.count(F.lit(1)), F.count_distinct("sequence_id")).first()
        if best_bins <= 1:
            break
        pool = again.select(*items.columns)
    if not settled:
        settled.append(_deal(pool, capacity, 0, 1))
    return functools.reduce(DataFrame.unionByName, settled).drop("_again")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, **names: str) -> DataFrame:
    """Encode, cut and pack whole documents into sequences of at most ``capacity`` tokens.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified``.
    Null text is empty and so one ``end_id``; null ids and repeated rows are packed like any
    other; further columns are ignored.
    """
    return pack(cut(docs, tokenizer, capacity, end_id, **names), capacity)
