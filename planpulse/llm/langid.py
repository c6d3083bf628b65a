"""Language identification: a byte convolutional network with several filter widths.

Texts are cut into windows of a fixed length, which are scored in batches: filters of two,
four and six bytes, max pooling over the window, a rectifier and a softmax over the learnt
languages.  A text's probabilities are the mean of its windows'.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse.llm.common import pick, rows_batch, ship, texts
from planpulse.llm.convnet import CELL, Adam, Filters, cells, narrow
from planpulse.llm.quality import SCORED, remainder, sample

WIDTHS = [2] * 8 + [4] * 12 + [6] * 12
PER_LANGUAGE = 300    # labelled rows a language that a model is fitted on
WINDOWS = 6           # of these, windows a row that are used in training, evenly spaced
EPOCHS, LOT, RATE = 10, 128, 0.02
UNKNOWN = "und"
#: A text is of a learnt language if so large a share of its three-byte strings is known, measured by that of
#: learnt rows held back: this part of their share that one in a hundred stays under.
HELD_BACK, ONE_IN, FAMILIAR = 5, 100, 0.7
SEEN_IN = 2           # rows of a language that a string must occur in to be known
_FOLD = np.frombuffer(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000"), np.uint8)
SLICE = 1 << 20
LETTER = regex.compile(r"\p{L}")


class Model:
    """Filters, the dense layer, and the languages in the order of its outputs."""

    def __init__(self, filters: Filters, weights: np.ndarray, bias: np.ndarray, languages: list[str]):
        self.filters, self.weights, self.bias, self.languages = filters, weights, bias, languages
        self.strings: list[np.ndarray] = []     # per language: its known three-byte strings
        self.floor = 0.0                        # least share of known strings
        self._known: list[np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": None}

    def familiar(self, many: list[bytes], language: list[str]) -> np.ndarray:
        """Share of each text's three-byte strings that its language is known to have (1 without any)."""
        if self._known is None:
            self._known = []
            for codes in self.strings:
                bits = np.zeros(1 << 21, np.uint8)
                np.bitwise_or.at(bits, codes >> 3, np.uint8(1) << (codes & 7).astype(np.uint8))
                self._known.append(bits)
        out = np.zeros(len(many))
        for i, (text, name) in enumerate(zip(many, language, strict=True)):
            if name in self.languages:
                bits, hits = self._known[self.languages.index(name)], 0
                for a in range(0, max(len(text) - 2, 0), SLICE):
                    codes = strings(text[a:a + SLICE + 2])
                    hits += int(((bits[codes >> 3] >> (codes & 7).astype(np.uint8)) & 1).sum())
                out[i] = hits / (len(text) - 2) if len(text) > 2 else 1.0
        return out

    def probabilities(self, many: list[bytes]) -> np.ndarray:
        """(texts, languages): the mean over each text's windows."""
        out, at = [], 0
        while at < len(many):
            first, size = at, 0
            while at < len(many) and (at == first or size + len(many[at]) <= SCORED):
                size += len(many[at])
                at += 1
            rows, firsts = cells(many[first:at], self.filters.width)
            p = softmax(np.maximum(self.filters.pooled(rows), 0).astype(np.float64) @ self.weights + self.bias)
            n = np.diff(np.append(firsts, len(p)))[:, None]
            out.append(np.add.reduceat(p, firsts) / n)
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))


def strings(text: bytes) -> np.ndarray:
    """Every three bytes of a text as a number; A-Z in lower case, digits alike."""
    b = _FOLD[np.frombuffer(text, np.uint8)].astype(np.uint32)
    return (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]


def learn_strings(pairs: list[tuple[bytes, str]], languages: list[str]) -> list[np.ndarray]:
    """Per language the three-byte strings that occur in at least SEEN_IN of its texts."""
    out = []
    for name in languages:
        found = [np.unique(strings(x)) for x, y in pairs if y == name and len(x) > 2]
        codes, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint32), return_counts=True)
        out.append(codes[n >= SEEN_IN])
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(pairs: list[tuple[bytes, str]], seed: int = 7) -> Model | None:
    """Fit on (text, language) pairs; None without any.  Deterministic."""
    languages = sorted({y for _, y in pairs})
    if not languages:
        return None
    windows, labels = [], []
    for x, y in pairs:
        n = max(1, -(-len(x) // CELL))
        for k in sorted({i * n // WINDOWS for i in range(WINDOWS)}):
            windows.append(x[k * CELL:(k + 1) * CELL])
            labels.append(languages.index(y))
            if k == 0 and len(x) > 40:   # short texts are windows, too
                windows.append(x[:len(x) // 2][:40])
                labels.append(labels[-1])
    labels = np.array(labels)
    rng = np.random.default_rng(seed)
    filters = Filters(rng.normal(0, 0.3, (max(WIDTHS), 256, len(WIDTHS))))
    mask = narrow(filters.tables, WIDTHS)
    filters.tables *= mask
    weights, bias = rng.normal(0, 0.3, (len(WIDTHS), len(languages))), np.zeros(len(languages))
    adam = Adam([filters.tables, weights, bias], RATE)
    steps = EPOCHS * -(-len(windows) // LOT)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        for lot in np.array_split(order, -(-len(order) // LOT)):
            filters._pairs = None
            rows, _ = cells([windows[i] for i in lot], filters.width)
            pooled, at = filters.pooled_at(rows)
            h = np.maximum(pooled, 0)
            p = softmax(h @ weights + bias)
            p[np.arange(len(lot)), labels[lot]] -= 1
            p /= len(lot)
            gh = (p @ weights.T) * (h > 0)
            adam.rate = RATE * (1 - adam.t / steps) + 1e-4
            adam.step([filters.back(rows, at, gh) * mask, h.T @ p + 1e-4 * weights, p.sum(axis=0)])
    filters._pairs = None
    model = Model(filters, weights, bias, languages)
    model.strings = learn_strings([x for i, x in enumerate(pairs) if i % HELD_BACK], languages)
    back = pairs[::HELD_BACK]
    shares = np.sort(model.familiar([x for x, _ in back], [y for _, y in back]))
    model.floor = FAMILIAR * float(shares[len(shares) // ONE_IN])
    return model


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, folds: int = 4, held: int = 2, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fit on a bounded sample of the rows with a language whose id is not in the held-out fold."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("label")) \
               .filter(F.col("label").isNotNull() & (remainder("id", folds) != held))
    return fit(sample(rows, docs, per_language, id_col, text_col))


def has_letter(data: bytes) -> bool:
    return LETTER.search(data.decode()) is not None


def identify(many: list[bytes], model: Model | None) -> tuple[list[str], np.ndarray]:
    """Language and its probability; ``und`` and 0 without a letter or a model."""
    if model is None:
        return [UNKNOWN] * len(many), np.zeros(len(many))
    p = model.probabilities(many)
    told = np.array([has_letter(x) for x in many], bool)
    best = p.argmax(axis=1)
    return [model.languages[b] if t else UNKNOWN for b, t in zip(best.tolist(), told.tolist(), strict=True)], \
        np.where(told, p.max(axis=1, initial=0), 0.0)


PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict(docs: DataFrame, model: Model | None, folds: int = 4, held: int = 2, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, over its whole text.

    Null, empty and letterless texts are ``und`` with score 0, and so is every text if
    there was nothing to learn from.  A null id is not held out.  Repeated rows are
    predicted alike; further columns are ignored.
    """
    held_out = F.coalesce(remainder(id_col, folds) == held, F.lit(False)).alias("held_out")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, p = identify(texts(batch), model)
            yield rows_batch(PREDICTED, [batch.column("doc_id"), batch.column("held_out"), names, p])

    return pick(docs, id_col, text_col, [held_out]).mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | None, least: float = 0.4, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is told with ``least`` or more.

    ``und`` goes, and so does a text of another language or of none (random letters, code):
    a softmax must choose one of the learnt languages, but such a text has too few of its
    three-byte strings (``Model.floor``).  Without a model nothing can be judged and every
    row stays.
    """
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = [x or b"" for x in batch.column(place).cast(pa.string()).cast(pa.binary()).to_pylist()]
            names, p = identify(many, model)
            share = model.familiar(many, names) if model else p
            yield batch.filter(pa.array([model is None or (n != UNKNOWN and s >= least and f >= model.floor)
                                         for n, s, f in zip(names, p.tolist(), share.tolist(), strict=True)], pa.bool_()))

    names = docs.columns   # renamed meanwhile: any name, even one with dots, may occur
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(run, plain.schema).toDF(*names)
