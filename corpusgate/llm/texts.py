"""Words, slices and hashes of whole texts, shared by the operators that work in Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from corpusgate.llm.shipping import ship

#: Text bytes worked on at once in a task. A text longer than this is a slice of its own, never cut.
SLICE_BYTES = 3 << 19

#: Rows that Spark sends a task at once.
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "500"

#: `bytes.split()` without arguments splits at exactly \x20 and \x09-\x0D.
SPACE = b" \t\n\x0b\x0c\r"

#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space.
PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
#: Lower-cases A-Z only.
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors, and batches that suit long texts."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(BATCH_CONF) == "10000":  # Spark's default; another setting is the user's
        spark.conf.set(BATCH_CONF, BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()  # workers serve many tasks

    return df.mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of at most ``SLICE_BYTES`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null becomes empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def offsets(counts: Iterable[int]) -> np.ndarray:
    """Start of each run, and the end of the last."""
    counts = np.fromiter(counts, np.int64)
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def numbered(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the documents, a number for each word (equal words, equal numbers), and the distinct words."""
    off = offsets(map(len, words))
    flat = np.empty(off[-1], dtype=object)
    flat[:] = [w for ws in words for w in ws]
    codes, distinct = pd.factorize(flat)
    return off, codes.astype(np.int64), distinct


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def word_hashes(distinct: np.ndarray) -> np.ndarray:
    """The same 64-bit hash of a word in every task."""
    if not len(distinct):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(distinct, categorize=False).astype(np.uint64)


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the window of ``n`` values that starts at each place; windows may cross documents."""
    out = hashes[: max(0, len(hashes) - n + 1)].copy()
    for k in range(1, n):
        out = out * M1 + hashes[k : k + len(out)]
    return mixed(out)


def inside(off: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of ``n`` values that lie within one document."""
    total = int(off[-1])
    left = np.repeat(off[1:], np.diff(off)) - np.arange(total)
    return np.flatnonzero(left >= n)


def owner(off: np.ndarray) -> np.ndarray:
    """The document of each value."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))


def summed(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of the values of each document."""
    total = np.cumsum(values)
    run = np.concatenate([np.zeros(1, total.dtype), total])
    return run[off[1:]] - run[off[:-1]]


def covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """True for every place within a window of ``n`` that begins at one of ``starts``."""
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + n, total), -1)
    return np.cumsum(step[:-1]) > 0
