"""K-d tree sharding: split at weighted medians until leaves reach the target bytes.

Points are groups of equal texts with their bytes as weight and four metadata dimensions:
size, source, language and least document id (names by their hash).  A node that is to
become k shards is cut along its widest dimension (its extent against the root's) where the
bytes below are floor(k / 2) / k of its own.  Equal coordinates are ordered by a hash, so
one value of a dimension, however hot, can be cut anywhere.

All nodes of a level are cut together, by distributed selection: bytes are summed per node
and cell of the key range (at most ``CELLS`` sums come to the driver at once), and the cell
that holds the median is refined until it is one point.  A level's cuts
become a small table that moves every point to a child, and the level is written.

Rows that share id and text are one row with their number until shards and slots are given.
A group heavier than 1 / ``SLICES`` of a shard would unbalance the leaves, so it is cut into
slices by document id first, and the copies of one row are dealt over the slices in turn;
there are at most shards x SLICES such groups, which bounds the list of them that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planpulse.llm.common import expanded, pick, slots, to_scratch

CELLS = 1 << 15       # cells of one pass, shared by a level's nodes
SLICES = 8
TASK_ROWS = 200_000   # copies of repeated rows that a task writes
DIMS = 4
TOP = (1 << 30) - 1   # coordinates are scaled to 30 bits; 32 bits of hash follow
TIE = 32
FIRST = 20            # a node's name is its first shard, shifted by this, and its shards


def _name(first: int, shards: int) -> int:
    return first << FIRST | shards


def _table(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A few rows of integers as a local relation (a row per node of one level)."""
    values = ", ".join("(" + ", ".join(f"{x}L" for x in row) + ")" for row in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})"))


def _key() -> Column:
    return F.element_at(F.array(*[f"k{d}" for d in range(DIMS)]), F.col("dim").cast("int") + 1)


def _select(points: DataFrame, aims: dict[int, tuple[int, int, int, float]]) -> dict[int, int]:
    """The cut key of each node: ``aims`` has node -> (dim, least key, greatest key, bytes wanted below)."""
    found: dict[int, int] = {}
    state = {n: [dim, lo, hi, want, 0] for n, (dim, lo, hi, want) in aims.items()}
    while state:
        cells = max(2, CELLS // len(state)).bit_length() - 1
        asked = [(n, dim, lo, hi, 1 << max(0, (hi - lo).bit_length() - cells)) for n, (dim, lo, hi, _, _) in state.items()]
        sums = points.join(_table(points.sparkSession, asked, ["node", "dim", "lo", "hi", "by"]), "node") \
                     .withColumn("key", _key()).filter(F.col("key").between(F.col("lo"), F.col("hi"))) \
                     .groupBy("node", F.expr("(key - lo) div by").alias("cell")) \
                     .agg(F.sum("w").alias("w"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        by_node: dict[int, list] = {}
        for n, cell, w, lo, hi in sums.collect():   # CELLS rows at most
            by_node.setdefault(n, []).append((cell, w, lo, hi))
        for n in list(state):
            dim, _, last, want, below = state[n]
            for _, w, lo, hi in sorted(by_node[n]):
                if below + w >= want or hi == last:
                    if lo == hi:
                        found[n] = lo if want - below < below + w - want else lo + 1
                        del state[n]
                    else:
                        state[n][1:] = [lo, hi, want, below]
                    break
                below += w
    return found


def grow(points: DataFrame, shards: int) -> DataFrame:
    """Cut ``points(w, k0..k3, ...)`` level by level; returns them with ``shard``.

    Every level is written, so its plan is short and the same for all levels; what differs
    is in the small tables of nodes.  A node without points is not cut further.
    """
    points = points.withColumn("node", F.lit(_name(0, shards)).cast("bigint"))
    extent = None
    while True:
        stats = points.groupBy("node").agg(F.sum("w").alias("w"), *[f(f"k{d}").alias(f"{f.__name__}{d}")
                                                                    for d in range(DIMS) for f in (F.min, F.max)])
        rows = {r["node"]: r for r in stats.collect()}   # one row per node
        wide = {n: [(r[f"max{d}"] >> TIE) - (r[f"min{d}"] >> TIE) for d in range(DIMS)] for n, r in rows.items()}
        if extent is None and rows:
            extent = [max(1, x) for x in wide[_name(0, shards)]]
        aims = {}
        for n, r in rows.items():
            k = n & ((1 << FIRST) - 1)
            if k > 1:
                dim = max(range(DIMS), key=lambda d: (wide[n][d] / extent[d], -d))
                aims[n] = (dim, r[f"min{dim}"], r[f"max{dim}"], r["w"] * (k // 2) / k)
        if not aims:
            return points.withColumn("shard", F.shiftright("node", FIRST).cast("int")).drop("node")
        cuts = []
        for n, cut in _select(points, aims).items():
            first, k = n >> FIRST, n & ((1 << FIRST) - 1)
            cuts.append((n, aims[n][0], cut, _name(first, k // 2), _name(first + k // 2, k - k // 2)))
        at = _table(points.sparkSession, cuts, ["node", "dim", "cut", "low", "high"])
        child = F.when(F.col("cut").isNull(), F.col("node")).when(_key() < F.col("cut"), F.col("low")).otherwise(F.col("high"))
        points = to_scratch(points.join(at, "node", "left").withColumn("node", child).drop("dim", "cut", "low", "high"), "level")


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    ``size`` is the text's UTF-8 bytes (null: none) plus 16; law ``bytes``: shards 0 to
    ``shards - 1`` hold nearly equal sizes; ``slot`` numbers a shard's rows from 0 in
    ascending document id; ``grown_shard`` is null under this law.  Equal texts share a
    shard unless their group alone outweighs 1 / SLICES of one.  Missing metadata count as
    one value; repeated rows each have a slot, and those of such a group are dealt over its
    slices; with fewer points than shards some stay empty; no rows give no rows.
    """
    def meta(c: str, out: str) -> Column:
        return (F.xxhash64(F.col(c).cast("string")) if c in docs.columns else F.lit(0).cast("bigint")).alias(out)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = pick(docs, id_col, text_col, [
        (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_text"), meta(source_col, "_source"), meta(lang_col, "_lang")]).drop("text")
    group = ["_text", "text_crc32", "size"]
    rows = rows.groupBy("doc_id", *group).agg(F.count(F.lit(1)).alias("_copies"), F.min("_source").alias("_source"),
                                              F.min("_lang").alias("_lang"))
    rows = to_scratch(rows, "rows")
    weight = F.sum(F.col("size") * F.col("_copies"))
    sums = rows.groupBy(*group).agg(weight.alias("w"))
    total, repeats = rows.agg(weight, F.sum(F.when(F.col("_copies") > 1, F.col("_copies")))).first()
    total, repeats = total or 0, repeats or 0
    most = max(1, total // (shards * SLICES))
    hot = sums.filter(F.col("w") > most).select(*group, (F.col("w") / most).cast("int").alias("_cuts"))
    # Copy j of a row goes to slice (hash of the id + j) mod slices: a row per slice, with its share of the copies.
    parts = F.coalesce(F.col("_cuts") + 1, F.lit(1))
    turns = F.when(F.col("_cuts").isNull(), F.lit(1)).otherwise(F.least("_copies", F.col("_cuts") + 1))
    rows = rows.join(F.broadcast(hot), group, "left") \
               .withColumn("_turn", F.explode(F.sequence(F.lit(0).cast("bigint"), turns.cast("bigint") - 1))) \
               .withColumn("_slice", F.pmod(F.xxhash64("doc_id") % parts + F.col("_turn"), parts).cast("int")) \
               .withColumn("_copies", F.when(F.col("_cuts").isNull(), F.col("_copies"))
                           .otherwise(F.floor((F.col("_copies") - 1 - F.col("_turn")) / parts) + 1)).drop("_cuts", "_turn")
    rows = to_scratch(rows, "sliced")
    group = [*group, "_slice"]
    points = rows.groupBy(*group).agg(weight.alias("w"), F.min("doc_id").alias("d3"), F.min("_source").alias("d1"),
                                      F.min("_lang").alias("d2")).withColumn("d0", F.col("size"))
    points = to_scratch(points, "values")
    lo_hi = points.agg(*[f(f"d{d}").cast("double").alias(f"{f.__name__}{d}") for d in range(DIMS) for f in (F.min, F.max)]).first()
    tie = F.shiftrightunsigned(F.xxhash64(*group), 64 - TIE)
    for d in range(DIMS):
        lo, hi = lo_hi[f"min{d}"] or 0.0, lo_hi[f"max{d}"] or 0.0
        unit = (F.coalesce(F.col(f"d{d}").cast("double"), F.lit(lo)) - lo) / max(hi - lo, 1.0)
        points = points.withColumn(f"k{d}", F.shiftleft((unit * TOP).cast("bigint"), TIE) + tie)
    points = to_scratch(points.select(*group, "w", *[f"k{d}" for d in range(DIMS)]), "points")
    placed = grow(points, shards).select(*group, "shard")
    out = rows.join(placed, group).select("doc_id", "size", "text_crc32", "_text", "shard", "_copies")
    out = slots(out, "shard", ["doc_id", "_text"], "_copies", "sharded")
    out = expanded(out, "_copies", "slot", max(1, -(-repeats // TASK_ROWS)))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
