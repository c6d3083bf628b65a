"""SimHash near-duplicates: bit-sliced comparison inside blocks that share bits.

A text's fingerprint has a bit set where over half of its word shingles' 64-bit hashes
have it set.  Texts link if their fingerprints differ in at most ``radius`` bits, and
links are followed to components.

Only distinct fingerprints are compared.  Cut into radius + g bands, two fingerprints in
reach agree on g bands at least, so for every choice of g bands those that agree on it form
a block; g grows with the number of fingerprints so that blocks stay short.  A block is
stored vertically: one 64-bit word holds one bit of 64 fingerprints.  A query adds the
planes it differs in with carry-save counters, 64 distances per word at a time, and words
are abandoned once all their distances exceed the radius.  What leaves a block is a
spanning forest of its links, so a group of m copies costs m - 1 rows and not m squared.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse.llm.common import pick, rows_batch, texts, to_scratch
from planpulse.llm.components import components

CHUNK = 1 << 20
BLOCK = 512          # wanted rows per block; decides g
TILE = 1 << 15       # longer blocks are compared tile by tile, in several tasks
HELD = 1 << 19       # rows that a task gathers before it compares them
PAIRS = 1 << 15      # (query, word) pairs compared together
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
SPACE = re.compile(rb"[\t-\r ]")


def _word_lists(data: bytes) -> Iterator[list[bytes]]:
    at, n = 0, len(data)
    while at < n:
        m = SPACE.search(data, at + CHUNK) if at + CHUNK < n else None
        end = m.start() if m else n
        yield data[at:end].lower().split()
        at = end


def fingerprint(data: bytes, shingle: int = 4) -> int:
    """The unsigned 64-bit SimHash of a whole text; 0 if it has no words."""
    counts, total, words = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def add(hashes: list[int]) -> None:
        nonlocal total
        h = np.array(hashes, "<u8")
        total += len(h)
        counts[:] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)

    for more in _word_lists(data):
        words = words[len(words) - shingle + 1:] if total else words
        words += more
        if len(words) < shingle:
            continue
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:len(words) - shingle].tolist()]
        add([digest(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)])
    if not total and words:
        add([digest(b" ".join(words), 42)])
    if not total:
        return 0
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp`` with the fingerprint's bits as a (signed) bigint."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x, shingle) for x in texts(batch)], np.uint64)
            yield rows_batch(schema, [batch.column("doc_id"), batch.column("text_hash"), fps.view(np.int64)])

    rows = pick(docs, id_col, text_col, [F.xxhash64(F.col(text_col).cast("string")).alias("text_hash")])
    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def _ones(k: np.ndarray) -> np.ndarray:
    """Words with their lowest k bits set, k from 0 to 64."""
    k = np.clip(k, 0, 64)
    return np.where(k >= 64, ALL, (np.uint64(1) << np.minimum(k, 63).astype(np.uint64)) - np.uint64(1))


def planes(fps: np.ndarray) -> np.ndarray:
    """64 rows, one per bit: bit j of word w is that bit of fingerprint 64 w + j."""
    n = -(-len(fps) // 64) * 64
    padded = np.zeros(n, "<u8")
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near(fps: np.ndarray, sides: np.ndarray, ends: np.ndarray, order: list[int], radius: int) -> Iterator[tuple]:
    """Pairs (i, j), i < j < ends[i], within ``radius`` bits, in bounded lots.

    ``order``: the planes, most telling first.  ``sides``: 0 for all pairs; rows of sides 1
    and 2 are compared across only.
    """
    sliced = planes(fps)
    cross = [_ones(np.zeros(0, np.int64))] * 3
    if sides.any():
        flags = np.zeros((3, sliced.shape[1] * 64), np.uint8)
        flags[sides, np.arange(len(sides))] = 1
        cross = np.packbits(flags, axis=1, bitorder="little").view("<u8")
    first = np.arange(len(fps)) >> 6
    spans = np.where(ends > np.arange(len(fps)) + 1, ((ends - 1) >> 6) - first + 1, 0)
    upto = np.cumsum(spans)
    total, digits = int(upto[-1]) if len(upto) else 0, (radius + 1).bit_length()
    for a in range(0, total, PAIRS):
        k = np.arange(a, min(total, a + PAIRS))
        q = np.searchsorted(upto, k, "right")
        word = first[q] + (k - (upto[q] - spans[q]))
        alive = _ones(ends[q] - 64 * word) & ~_ones(q + 1 - 64 * word)
        if sides.any():
            alive &= np.where(sides[q] == 0, ALL, np.where(sides[q] == 1, cross[2][word], cross[1][word]))
        counts = [np.zeros(len(q), np.uint64) for _ in range(digits)]
        value = fps[q]
        for done, p in enumerate(order, 1):
            carry = sliced[p][word] ^ (np.uint64(0) - (value >> np.uint64(p) & np.uint64(1)))
            for c in counts:
                carry, c[:] = c & carry, c ^ carry
            alive &= ~carry
            if done % 8 == 0 or done == len(order):
                alive &= ~_over(counts, radius)
                keep = alive != 0
                if not keep.all():
                    q, word, alive, value = q[keep], word[keep], alive[keep], value[keep]
                    counts = [c[keep] for c in counts]
                if not len(q):
                    break
        if len(q):
            hit, bit = np.nonzero(np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield q[hit], word[hit] * 64 + bit


def _over(counts: list[np.ndarray], radius: int) -> np.ndarray:
    """Bits whose count, spread over the words of ``counts``, is above ``radius``."""
    more, same = np.zeros_like(counts[0]), np.full_like(counts[0], ALL)
    for d in reversed(range(len(counts))):
        if radius >> d & 1:
            same &= counts[d]
        else:
            more |= same & counts[d]
            same &= ~counts[d]
    return more


def forest(fps: np.ndarray, block: np.ndarray, sides: np.ndarray, order: list[int], radius: int) -> np.ndarray:
    """For rows sorted by ``block``: the first row that each one reaches inside its block."""
    root = np.arange(len(fps))
    ends = np.searchsorted(block, block, "right")
    for i, j in near(fps, sides, ends, order, radius):
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    return root


def band_masks(radius: int, g: int) -> list[int]:
    """Masks of every choice of g bands out of radius + g that share the 64 bits evenly."""
    edges = [64 * i // (radius + g) for i in range(radius + g + 1)]
    bands = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(bands, g)]


def links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """``distinct(fp)``, each fingerprint once -> ``(u, v)`` whose components are those of
    all pairs within ``radius`` bits.  Exact: every pair in reach meets in a block."""
    n = distinct.count()
    g = next((g for g in (1, 2, 3) if n / 2 ** (64 * g // (radius + g)) <= BLOCK), 4)
    masks = band_masks(radius, g)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    rows = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed]))
                           .alias("band", "key"))
    sizes = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    sizes = to_scratch(sizes.withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int")).drop("n"), "blocks")
    # Tile t of a row in a long block: once with each tile s, as side 1 or 2 of the tile pair.
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    tiled = rows.join(sizes, ["band", "key"]).withColumn("own", own) \
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select("fp", "band", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                         F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1)
                          .otherwise(2).alias("side"))
    keys = ["band", "key", "lo", "hi"]
    sorted_rows = tiled.repartition(*keys).sortWithinPartitions(*keys, "fp")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def compare(table: pa.Table) -> pa.RecordBatch:
        fp = table.column("fp").to_numpy().view(np.uint64)
        side = table.column("side").to_numpy()
        columns = [table.column(k).to_numpy() for k in keys]
        new = np.ones(len(fp), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        block = np.cumsum(new)
        us, vs = [], []
        for band in np.unique(columns[0]).tolist():
            a, b = np.searchsorted(columns[0], [band, band + 1])
            told = masks[band]
            order = [p for p in range(64) if not told >> p & 1]   # planes of the shared bands never differ
            root = forest(fp[a:b], block[a:b], side[a:b], order, radius)
            moved = np.flatnonzero(root != np.arange(b - a))
            us.append(fp[a:b][moved])
            vs.append(fp[a:b][root[moved]])
        return rows_batch(schema, [np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= HELD:   # all blocks but the last, which may go on
                table = pa.Table.from_batches(held).combine_chunks()
                last = np.all([c == c[-1] for c in (table.column(k).to_numpy() for k in keys)], axis=0)
                cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
                if cut:
                    yield compare(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
        if sum(b.num_rows for b in held):
            yield compare(pa.Table.from_batches(held).combine_chunks())

    return sorted_rows.mapInArrow(run, "u bigint, v bigint")


def _classes(docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Written tables: ``doc_id, text_hash, fp`` per row, and ``fp, root`` per fingerprint."""
    each = to_scratch(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = to_scratch(each.select("fp").distinct(), "distinct")
    star = components(links(distinct, radius)).withColumnsRenamed({"u": "fp", "v": "root"})
    return each, to_scratch(distinct.join(star, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    Fingerprints are unsigned 64-bit in lowercase hex; ``component_id`` is the least
    document id reachable over links, itself included (null only if all those are null).
    Null, empty and blank texts have fingerprint zero and link like others.  Repeated rows
    share a fingerprint; further columns are ignored; an empty table gives an empty result.
    """
    each, rooted = _classes(docs, shingle, radius, id_col, text_col)
    least = each.groupBy("fp").agg(F.min("doc_id").alias("least")).join(rooted, "fp") \
                .groupBy("root").agg(F.min("least").alias("component_id"))
    classes = to_scratch(rooted.join(to_scratch(least, "least"), "root").select("fp", "component_id"), "classes")
    return each.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less near-duplicates; of each component one row stays.

    It is the one with the least id (a null id only if all are; of rows that share that id,
    the one with the least text hash).  All columns are kept.
    """
    names = docs.columns   # renamed meanwhile: any name, even one with dots, may occur
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own_id, own_text = (F.col(f"c{names.index(c)}") for c in (id_col, text_col))
    each, rooted = _classes(docs, shingle, radius, id_col, text_col)
    rank = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")
    first = each.groupBy("fp").agg(F.min(rank).alias("first")).join(rooted, "fp").groupBy("root").agg(F.min("first").alias("f"))
    first = first.select(F.col("f.doc_id").alias("doc_id"), F.col("f.text_hash").alias("text_hash"))
    # Only rows that repeat an id and a text are shuffled again, to keep one of them.
    rows = each.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    first = to_scratch(first.join(rows, F.col("rows").isNotNull() & first["doc_id"].eqNullSafe(rows["doc_id"])
                                  & (first["text_hash"] == rows["text_hash"]))
                       .select(first["doc_id"].alias("_id"), first["text_hash"].alias("_hash"), "rows"), "first")
    stay = plain.join(first, own_id.cast("bigint").eqNullSafe(F.col("_id"))
                      & F.xxhash64(own_text.cast("string")).eqNullSafe(F.col("_hash")))
    once, more = stay.filter("rows = 1"), stay.filter("rows > 1").dropDuplicates([f"c{names.index(c)}" for c in (id_col, text_col)])
    return once.unionByName(more).select(*plain.columns).toDF(*names)
