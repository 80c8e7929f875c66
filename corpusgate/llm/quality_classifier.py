"""Quality classifier: Naive Bayes support vectors.

Indicators of n-grams (up to three word shapes in a row with which of the words are equal, and words) are scaled by the ratio of their log
counts in the two classes; a linear hinge-loss model is then fitted by dual coordinate descent and its
margin turned into a probability. Log counts come from every training row; the support vectors from a
sample of at most ``SAMPLE`` of them, taken by the smallest hashes of the id.

Defined cases: a null or empty text has no n-gram and gets the score of the intercept; training rows
without a label are left out; if one class has no row, every score is that of the other; repeated rows
count and are scored one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgate.llm import texts

#: Slots of the hashed n-grams: the model is this many numbers, whatever the corpus.
SLOTS = 1 << 18
#: Largest number of training rows from which the support vectors are fitted.
SAMPLE = 6000
#: Shape of a byte: letter case, digit, or the sign itself.
SHAPE = bytes(
    0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x30 if 0x30 <= c <= 0x39 else c
    for c in range(256)
)
RUN = re.compile(rb"(.)\1+", re.S)


class Shapes(dict):
    """Number of the shape of a word: runs of the same kind of character count as one."""

    def __init__(self) -> None:
        super().__init__()
        self.numbers: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        shape = RUN.sub(rb"\1", word.translate(SHAPE))
        if len(self.numbers) > 100_000:
            self.numbers = {}
        if len(self) > 500_000:
            self.clear()
        if shape not in self.numbers:
            self.numbers[shape] = int(texts.word_hashes(np.array([shape], dtype=object))[0])
        self[word] = self.numbers[shape]
        return self.numbers[shape]


def indicators(rows: list[bytes], shapes: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """(document, slot), ordered and distinct, of the n-grams of some texts."""
    words = [t.split() for t in rows]
    off = texts.offsets(map(len, words))
    doc = texts.owner(off)
    shape = np.fromiter((shapes[w] for ws in words for w in ws), np.uint64, int(off[-1]))
    _, codes, distinct = texts.numbered(words)
    keys, docs = [], []
    for n in (1, 2, 3):
        at = texts.inside(off, n)
        pattern = np.full(len(at), n, np.uint64)  # which words of the n-gram are equal
        for a, b in ((0, 1), (1, 2), (0, 2)):
            if b < n:
                pattern = pattern * np.uint64(2) + (codes[at + a] == codes[at + b]).astype(np.uint64)
        keys.append(texts.mixed(texts.rolled(shape, n)[at] + pattern * texts.M3))
        docs.append(doc[at])
    keys.append(texts.mixed(texts.word_hashes(distinct))[codes])
    docs.append(doc)
    slot = (np.concatenate(keys) % np.uint64(SLOTS)).astype(np.int64)
    both = np.unique(np.concatenate(docs) * SLOTS + slot)
    return both // SLOTS, both % SLOTS


def log_ratios(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log of the classes' smoothed shares of documents with each n-gram; ``counts``: (2, slots), class 1 second."""
    share = (counts + 1) / (sizes[:, None] + 2)
    return np.log(share[1] / share[0])


def fitted(
    off: np.ndarray, slots: np.ndarray, y: np.ndarray, ratios: np.ndarray, cost: float = 1.0, rounds: int = 15, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a linear hinge-loss model over rows of ratios[slot], scaled to unit length."""
    rng = np.random.default_rng(seed)
    weights, bias, alpha = np.zeros(SLOTS + 1), 1.0, np.zeros(len(y))
    values = ratios[slots]
    norm = np.sqrt(np.maximum(texts.summed(values**2, off), 1e-12))
    square = np.ones(len(y)) + bias**2
    most = cost * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))  # both classes weigh the same
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            own = slice(off[i], off[i + 1])
            at, x = slots[own], values[own] / norm[i]
            gradient = y[i] * (weights[at] @ x + weights[-1] * bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), most[i])
            step = new - alpha[i]
            if step:
                weights[at] += step * y[i] * x
                weights[-1] += step * y[i] * bias
                alpha[i], moved = new, max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights[:-1], float(weights[-1] * bias)


@dataclass
class Model:
    weights: np.ndarray  # of each slot, ratio included
    ratios: np.ndarray
    intercept: float
    slope: float = 4.0
    shift: float = 0.0

    def margins(self, rows: list[bytes], shapes: Shapes) -> np.ndarray:
        doc, slot = indicators(rows, shapes)
        value = self.ratios[slot]
        total = np.bincount(doc, self.weights[slot] * value, minlength=len(rows))
        norm = np.sqrt(np.maximum(np.bincount(doc, value**2, minlength=len(rows)), 1e-12))
        return total / norm + self.intercept

    def scores(self, rows: list[bytes], shapes: Shapes) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.margins(rows, shapes) + self.shift)))


def counted(labelled: DataFrame, text_col: str, label_col: str) -> tuple[np.ndarray, np.ndarray]:
    """((2, slots) document counts of the n-grams, documents of each class) over every labelled row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, total, sizes = Shapes(), np.zeros((2, SLOTS), np.int64), np.zeros(2, np.int64)
        for part in texts.slices(batches):
            y = np.array(part.column("label").to_pylist(), np.int64)
            doc, slot = indicators(texts.raw(part), shapes)
            total += np.bincount(y[doc] * SLOTS + slot, minlength=2 * SLOTS).reshape(2, SLOTS)
            sizes += np.bincount(y, minlength=2)
        label, slot = np.nonzero(total)
        n = np.concatenate([total[label, slot], sizes])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([label, [0, 1]])), pa.array(np.concatenate([slot, [SLOTS, SLOTS]])), pa.array(n)],
            names=["label", "slot", "n"],
        )

    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("long").alias("label"))
    got = texts.arrow(rows, count, "label long, slot long, n long").groupBy("label", "slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, SLOTS + 1), np.int64)  # two numbers a slot: bounded by SLOTS
    counts[got["label"].to_numpy(), got["slot"].to_numpy()] = got["n"].to_numpy()
    return counts[:, :-1], counts[:, -1]


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", sample: int = SAMPLE) -> Model:
    """Learn from rows with a text and a label of 0 or 1."""
    labelled = labelled.where(F.col(label_col).isin(0, 1))
    counts, sizes = counted(labelled, text_col, label_col)
    ratios = log_ratios(counts, sizes)
    if not sizes.all():
        side = 6.0 if sizes[1] else -6.0
        return Model(np.zeros(SLOTS), ratios, side if sizes.any() else 0.0, 1.0)
    share = np.minimum(1.0, sample / 2 / sizes)
    key = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)) / (1 << 30)
    most = F.when(F.col(label_col) == 1, float(share[1])).otherwise(float(share[0]))
    chosen = labelled.where(key < most).select(F.col(text_col).alias("text"), F.col(label_col).cast("long").alias("label"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for part in texts.slices(batches):
            doc, slot = indicators(texts.raw(part), shapes)
            ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(slot.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("label"), lists], names=["label", "slots"])

    got = texts.arrow(chosen, listed, "label long, slots array<int>").toArrow()  # about `sample` rows of slot numbers
    lists = [np.asarray(x, np.int64) for x in got["slots"].to_pylist()]
    y = np.where(got["label"].to_numpy() == 1, 1.0, -1.0)
    if len(set(y)) < 2:
        return Model(np.zeros(SLOTS), ratios, 0.0)
    off, slots = texts.offsets(map(len, lists)), np.concatenate(lists)
    weights, intercept = fitted(off, slots, y, ratios)
    return Model(weights, ratios, intercept)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; the model (two numbers a slot) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for part in texts.slices(batches):
            score = shared.value.scores(texts.raw(part), shapes)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], names=[id_col, "score"])

    return texts.arrow(docs.select(F.col(id_col), F.col(text_col).alias("text")), run, f"`{id_col}` {kind}, score double")


def held(id_col: Column, parts: int, which: int) -> Column:
    """Whether the CRC-32 of the id as text leaves ``which`` when divided by ``parts``."""
    return F.coalesce(F.crc32(id_col.cast("string")) % parts == which, F.lit(False))
