"""Quality classifier: a byte-level convolutional network in numpy.

Chunks are two neighbouring cells, so they overlap by half and cover the whole text.  The
filters' maxima per chunk pass a rectifier; over the chunks of a text they are combined as
their greatest and their mean, and one logistic unit turns those into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from planpulse.llm.common import pick, rows_batch, ship, texts
from planpulse.llm.convnet import Adam, Filters, cells

FILTERS, WIDTH = 16, 6
PER_CLASS = 1500          # labelled rows a class that a model is fitted on
MAX_SAMPLE_BYTES = 65536  # longer texts are not in that sample (all are scored)
LABELS, LABEL_BYTES = 32, 8 << 20   # labels of a sample, by support, and bytes of each one's texts
EPOCHS, LOT, RATE = 12, 48, 0.02
SCORED = 1 << 22          # bytes of text scored together


class Model:
    """Filters and the logistic unit; scores do not depend on how texts are batched."""

    def __init__(self, filters: Filters, weights: np.ndarray, bias: np.ndarray):
        self.filters, self.weights, self.bias = filters, weights, bias

    @staticmethod
    def chunks(n_cells: int, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each chunk's second cell (the first one if a text has no more), first chunk of each text."""
        ends = np.append(firsts[1:], n_cells)
        second = np.arange(1, n_cells + 1)
        lone = ends - firsts == 1
        second[ends - 1] = ends - 1
        keep = np.ones(n_cells, bool)
        keep[(ends - 1)[~lone]] = False   # the last cell begins no chunk of its own
        first = np.flatnonzero(keep)
        return np.stack([first, second[first]]), np.searchsorted(first, firsts)

    def combine(self, pooled: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        (a, b), starts = self.chunks(len(pooled), firsts)
        h = np.maximum(np.maximum(pooled[a], pooled[b]), 0)
        n = np.diff(np.append(starts, len(a)))[:, None]
        return np.hstack([np.maximum.reduceat(h, starts), np.add.reduceat(h, starts) / n])

    def scores(self, many: list[bytes]) -> np.ndarray:
        out, at = [], 0
        while at < len(many):
            first, size = at, 0
            while at < len(many) and (at == first or size + len(many[at]) <= SCORED):
                size += len(many[at])
                at += 1
            rows, firsts = cells(many[first:at], WIDTH)
            logit = self.combine(self.filters.pooled(rows), firsts).astype(np.float64) @ self.weights + self.bias[0]
            out.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def fit(sample: list[tuple[bytes, int]], seed: int = 7) -> Model | None:
    """Fit on (text, label) pairs; None if a class is missing.  Deterministic."""
    labels = np.array([y for _, y in sample], np.float32)
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    filters = Filters(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)))
    weights, bias = rng.normal(0, 0.3, 2 * FILTERS), np.zeros(1)
    model = Model(filters, weights, bias)
    adam = Adam([filters.tables, weights, bias], RATE)
    steps = EPOCHS * -(-len(sample) // LOT)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(sample))
        for lot in np.array_split(order, -(-len(order) // LOT)):
            filters._pairs = None
            rows, firsts = cells([sample[i][0] for i in lot], WIDTH)
            pooled, at = filters.pooled_at(rows)
            (a, b), starts = model.chunks(len(pooled), firsts)
            cell = np.where(pooled[a] >= pooled[b], a[:, None], b[:, None])
            h = np.maximum(np.maximum(pooled[a], pooled[b]), 0)
            n = np.diff(np.append(starts, len(a)))
            greatest = np.maximum.reduceat(h, starts)
            z = np.hstack([greatest, np.add.reduceat(h, starts) / n[:, None]])
            p = 1 / (1 + np.exp(-np.clip(z @ weights + bias[0], -30, 30)))
            err = (p - labels[lot]) / len(lot)
            gz = err[:, None] * weights
            whole = np.repeat(np.arange(len(lot)), n)
            gh = gz[whole, FILTERS:] / n[whole][:, None] + gz[whole, :FILTERS] * (h == greatest[whole])
            gh *= h > 0
            gc = np.zeros(pooled.shape, np.float32)
            np.add.at(gc, (cell, np.broadcast_to(np.arange(FILTERS), cell.shape)), gh)
            adam.rate = RATE * (1 - adam.t / steps) + 1e-4
            adam.step([filters.back(rows, at, gc) + 1e-5 * filters.tables, z.T @ err + 1e-4 * weights, np.array([err.sum()])])
    filters._pairs = None
    return model


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % by


def sample(rows: DataFrame, docs: DataFrame, per_class: int, id_col: str, text_col: str) -> list[tuple[bytes, object]]:
    """Up to ``per_class`` (text, label) pairs of each label in ``rows(id, label)``.

    Ids are drawn by hash, on id and label alone: about four times as many as wanted by a
    threshold per label (so the ranking sees few rows of a frequent one), then the first.
    Their texts are fetched after that.  Of many labels the ``LABELS`` most frequent count
    (then the least), and of a label's texts the first ``LABEL_BYTES``, each of at most
    ``MAX_SAMPLE_BYTES``: so much reaches the driver.  Of several texts under one id the
    least one stands for it.
    """
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull())
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("_rows")).orderBy(F.desc("_rows"), "label").limit(LABELS)
    some = F.broadcast(counts.select("label", (F.lit(4.0 * per_class) / F.col("_rows")).alias("_share")))
    w = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    drawn = rows.join(some, "label").filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("_share") * (1 << 30)) \
                .select("id", "label").distinct() \
                .withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_class).drop("_n")
    text = F.col(text_col).cast("string")
    got = docs.select(F.col(id_col).alias("id"), text.alias("text")).filter(F.octet_length("text") <= MAX_SAMPLE_BYTES) \
              .join(F.broadcast(drawn), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    held = F.sum(F.octet_length("text")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    got = got.withColumn("_held", held).filter(F.col("_held") <= LABEL_BYTES).select("id", "label", "text").collect()
    return [(r["text"].encode(), r["label"]) for r in sorted(got, key=lambda r: (r["id"], str(r["label"])))]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = 5, held: int = 0,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on a bounded sample of the labelled rows whose id is not in the held-out fold."""
    rows = docs.select(F.col(id_col).alias("id")).join(
        labels.select(F.col("doc_id").alias("id"), F.col(label_col).cast("int").alias("label")), "id") \
        .filter(F.col("label").isin(0, 1) & (remainder("id", folds) != held))
    return fit(sample(rows, docs, per_class, id_col, text_col))


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score(docs: DataFrame, model: Model | None, threshold: float = 0.3, folds: int = 5, held: int = 0,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, over its whole text.

    ``predicted`` is 1 from ``threshold`` on.  Null and empty texts are one cell of zeros.
    A null id is not held out.  Without a model (no labels of both kinds) every score is
    0.5.  Repeated rows score alike; further columns are ignored.
    """
    held_out = F.coalesce(remainder(id_col, folds) == held, F.lit(False)).alias("held_out")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = texts(batch)
            p = model.scores(many) if model else np.full(len(many), 0.5)
            yield rows_batch(SCORES, [batch.column("doc_id"), batch.column("held_out"), p, (p >= threshold).astype(np.int32)])

    return pick(docs, id_col, text_col, [held_out]).mapInArrow(
        run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model | None, threshold: float = 0.3, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``threshold`` or more;
    all rows without a model."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = [x or b"" for x in batch.column(place).cast(pa.string()).cast(pa.binary()).to_pylist()]
            p = model.scores(many) if model else np.full(len(many), 0.5)
            yield batch.filter(pa.array(p >= threshold))

    names = docs.columns   # renamed meanwhile: any name, even one with dots, may occur
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(run, plain.schema).toDF(*names)
