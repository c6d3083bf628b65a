"""Merkle manifest of a dataset: leaves, subtree roots per language, one root, proofs.

Leaves are numbered per language in ascending document id and cut into superblocks of
BLOCK consecutive ones (a power of the fan-out, so no run crosses a border).  A superblock
is reduced to one node by its own task; nodes of a language are numbered again, so its tree
closes after a few such rounds, and the languages' subroots form one more tree.  On the way
back down, the nodes of a round and the outer nodes their superblock needs (the runs on the
path from it to the root) are cogrouped by superblock: each group finishes its reduction,
joins its nodes' siblings to the outer ones, and folds.  No task sees more than BLOCK nodes
and a path, however many rows a language has.
"""

from __future__ import annotations

import hashlib
import itertools
import string
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planpulse.llm.common import expanded, pick, slots, to_scratch

FAN = 8
BLOCK = FAN ** 4
TASK_ROWS = 100_000   # copies of repeated rows that a task writes


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def reduce_once(nodes: list[str]) -> list[str]:
    """Every FAN consecutive nodes (the last run: fewer, even one) become their digest."""
    return [digest(*nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]


def levels(nodes: list[str], whole: bool, block: int) -> list[list[str]]:
    """The nodes and their reductions: of a whole tree to one node, of a superblock to a full one's height."""
    out, height = [nodes], 1
    while (len(out[-1]) > 1) if whole else height < block:
        out.append(reduce_once(out[-1]))
        height *= FAN
    return out


def _runs(tree: list[list[str]], i: int) -> Iterator[tuple[int, list[str]]]:
    """Per level of the block: the place of node ``i``'s ancestor in its run, and the run."""
    for nodes in tree[:-1]:
        first = i // FAN * FAN
        yield i - first, nodes[first:first + FAN]
        i //= FAN


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    return F.sha2(F.concat(*[_field(c) for c in fields]), 256)


def _reduced(nodes: DataFrame, size: int) -> DataFrame:
    """One row a superblock of ``tree, idx, n, node``: ``tree, idx, n, node`` one round up.

    ``n`` is the tree's number of nodes.  A tree of one superblock becomes its root.
    """
    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        n = int(rows.n.iloc[0])
        top = levels(rows.node.tolist(), n <= size, size)[-1][0]
        return pd.DataFrame({"tree": [rows.tree.iloc[0]], "idx": [int(rows.idx.iloc[0]) // size],
                             "n": [-(-n // size)], "node": [top]})

    block = F.expr(f"idx div {size}").alias("block")
    return nodes.groupBy("tree", block).applyInPandas(reduce, "tree string, idx bigint, n bigint, node string")


def _rounds(nodes: DataFrame, size: int, name: str) -> list[DataFrame]:
    """``nodes`` and each round above it, until every tree is one node; finished trees stay as they are."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        more = _reduced(out[-1].filter("n > 1"), size).unionByName(out[-1].filter("n = 1"))
        out.append(to_scratch(more, f"{name}-{len(out)}"))
    return out


#: The path of a node: one row per level above it, from the lowest, with its place in the run and the siblings.
PATH = "tree string, idx bigint, step int, place int, siblings array<string>"
Above = list[tuple[int, list[str]]]


def _cogrouped(nodes: DataFrame, outer: DataFrame, finish: Callable[[pd.DataFrame, list[list[str]], Above], pd.DataFrame],
               schema: str, size: int) -> DataFrame:
    """Cogroup nodes with the outer nodes of their superblocks.

    ``finish`` gets a superblock's rows in order, its local reduction, and the places and
    siblings on the path from its top to the root.
    """
    names = [f.strip().split(" ")[0] for f in schema.split(", ")]

    def run(rows: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame([], columns=names)
        rows = rows.sort_values("idx").reset_index(drop=True)
        path = path.sort_values("step")
        above = [(int(p), list(s)) for p, s in zip(path.place, path.siblings, strict=True)]
        return finish(rows, levels(rows.node.tolist(), int(rows.n[0]) <= size, size), above)

    block = F.expr(f"idx div {size}").alias("block")
    return nodes.groupBy("tree", block).cogroup(outer.groupBy("tree", F.col("idx").alias("block"))).applyInPandas(run, schema)


def _paths_of(rows: pd.DataFrame, tree: list[list[str]], above: Above) -> pd.DataFrame:
    out = []
    for i in range(len(rows)):
        own = [(place, run[:place] + run[place + 1:]) for place, run in _runs(tree, i)]
        out += [(rows.tree[i], rows.idx[i], step, *x) for step, x in enumerate(own + above)]
    return pd.DataFrame(out, columns=["tree", "idx", "step", "place", "siblings"])


def _down(rounds: list[DataFrame], paths: DataFrame, lowest: int, size: int, name: str) -> DataFrame:
    """Paths of the nodes of round ``lowest``, from ``paths``, those of the trees' roots."""
    for r in range(len(rounds) - 2, lowest - 1, -1):
        paths = to_scratch(_cogrouped(rounds[r], paths, _paths_of, PATH, size), f"{name}-{r}")
    return paths


FOLDED = "tree string, doc_id string, leaf string, proof_sha256 string, folded_root string"


def _fold_leaves(rows: pd.DataFrame, tree: list[list[str]], above: Above) -> pd.DataFrame:
    outer = "".join(itertools.chain.from_iterable(siblings for _, siblings in above)).encode()
    ends: dict[str, str] = {}                 # a block's top -> the root it folds to
    proofs, folded = [], []
    for i, (leaf, changed) in enumerate(zip(rows.node, rows.changed, strict=True)):
        node, proof = leaf if changed is None else changed, hashlib.sha256()
        for place, run in _runs(tree, i):
            proof.update("".join(run[:place] + run[place + 1:]).encode())
            node = digest(*run[:place], node, *run[place + 1:])
        proof.update(outer)
        proofs.append(proof.hexdigest())
        if node not in ends:
            end = node
            for place, siblings in above:
                end = digest(*siblings[:place], end, *siblings[place:])
            ends[node] = end
        folded.append(ends[node])
    return pd.DataFrame({"tree": rows.tree, "doc_id": rows.doc_id, "leaf": rows.node, "proof_sha256": proofs,
                         "folded_root": folded})


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` of ``tree, doc_id, node, changed, copies`` as nodes: one a copy, with ``idx`` and ``n``."""
    sizes = to_scratch(rows.groupBy("tree").agg(F.sum("copies").alias("n")), "sizes")
    repeats = rows.agg(F.sum(F.when(F.col("copies") > 1, F.col("copies")))).first()[0] or 0
    placed = slots(rows, "tree", ["doc_id", "node"], "copies", "ordered", "idx")
    return expanded(placed, "copies", "idx", max(1, -(-repeats // TASK_ROWS))).join(sizes, "tree")


def manifest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source", chars_col: str = "n_chars", block: int = BLOCK) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    A leaf is the digest of a row's id, source, language, n_chars and text.  A language's
    leaves in ascending id (null first; equal ids: ascending leaf) give its subroot, the
    subroots in ascending language (null first, UTF-8 bytewise) the root.  Null languages
    are one tree.  ``proof_sha256`` digests the siblings on the way from leaf to root.
    ``folded_root`` is recomputed along them, for every third id (by crc32) from a row
    tampered with: its text's A-Z in lower case.  A null id is never tampered with, a null
    text stays.  Repeated rows are leaves of their own, counted together until numbered; an
    empty table has no rows; further columns are ignored.  ``block``, the leaves of a
    superblock, is a power of FAN that only divides the work.
    """
    spark = docs.sparkSession
    rows = pick(docs, id_col, text_col, [F.col(source_col).alias("source"), F.col(lang_col).cast("string").alias("lang"),
                                         F.col(chars_col).alias("n_chars")])
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = rows.select(
        F.when(F.col("lang").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "lang")).alias("tree"), "doc_id",
        leaf_digest([*fields, F.col("text")]).alias("node"),
        F.when(third & F.col("text").isNotNull(), leaf_digest([*fields, lower])).alias("changed"))
    rows = to_scratch(rows.groupBy("tree", "doc_id", "node", "changed").agg(F.count(F.lit(1)).alias("copies")), "rows")
    leaves = to_scratch(_numbered(rows).select("tree", "idx", "n", "node", "changed", F.col("doc_id").cast("string")), "leaves")
    rounds = _rounds(leaves.select("tree", "idx", "n", "node"), block, "nodes")
    subroots = rounds[-1].select("tree", F.col("node").alias("subroot"))

    # The subroots are the leaves of one more tree, in the order of their languages.
    ranked = subroots.withColumn("copies", F.lit(1).cast("bigint")).withColumn("all", F.lit(""))
    ranked = to_scratch(slots(ranked, "all", ["tree"], "copies", "languages", "rank"), "ranked")
    langs = ranked.count()
    top = _rounds(ranked.select(F.col("all").alias("tree"), F.col("rank").alias("idx"), F.lit(langs).cast("bigint").alias("n"),
                                F.col("subroot").alias("node")), block, "top")
    root = next((r.node for r in top[-1].select("node").take(1)), None)
    outer = _down(top, spark.createDataFrame([], PATH), 0, block, "outer").withColumnRenamed("idx", "rank").drop("tree")
    outer = outer.join(ranked.select("tree", "rank"), "rank") \
                 .select("tree", F.lit(0).cast("bigint").alias("idx"), "step", "place", "siblings")
    outer = _down(rounds, outer, 1, block, "paths")
    out = _cogrouped(leaves, outer, _fold_leaves, FOLDED, block).join(subroots, "tree")
    return out.select(F.col("doc_id").cast("bigint"), "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256",
                      "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"))
