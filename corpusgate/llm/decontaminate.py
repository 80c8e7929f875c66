"""Benchmark decontamination with suffix arrays of the training texts.

Each task cuts its documents into shards of a few MB, sorts the suffixes of a shard to the depth of a
window and binary-searches every suffix of the benchmark that holds a window. Windows found one after
the other on one diagonal are joined to longest verbatim matches, with their places on both sides.

A word that no benchmark text has ends every match, so only runs of benchmark words that are long enough
for a window enter a suffix array; no match is lost by that. The benchmark is searched in blocks of a
bounded number of words, one after the other in the same pass over the documents, so a broadcast never
grows with either table; documents are not shuffled.

Defined cases: null or empty texts and items have no words; an item shorter than a window is one window
of its own length; repeated documents are judged one by one, items that repeat an id count as one; a null
item id is written as an empty string; empty tables give documents without hits, or no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.llm import texts

WINDOW = 10
#: Words of benchmark text that are broadcast at once: about 20 MB.
BLOCK_WORDS = 1_000_000
HITS = "array<struct<item: string, item_word: int, doc_word: int, length: int>>"
HIT = pa.struct([("item", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("length", pa.int32())])


@dataclass
class Block:
    """Part of the benchmark: numbers of its words from 1, and its windows by item."""

    vocabulary: dict[bytes, int]
    items: list[str]
    words: np.ndarray
    window: np.ndarray  # of each item
    suffix: np.ndarray  # places in words where a window starts
    item: np.ndarray  # of each suffix
    first: np.ndarray  # word of its item at which each suffix starts


def block_of(rows: Iterable[tuple[object, str | None]], window: int) -> Block:
    """Number the words of some items and list their window starts."""
    vocabulary: dict[bytes, int] = {}
    items, numbers, sizes = [], [], []
    for item_id, text in rows:
        words = (text or "").encode().translate(texts.PLAIN).split()
        if words:
            items.append("" if item_id is None else str(item_id))
            numbers += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
            sizes.append(len(words))
    off = texts.offsets(sizes)
    width = np.minimum(np.diff(off), window)
    starts = np.diff(off) - width + 1
    item = np.repeat(np.arange(len(items)), starts)
    first = np.arange(int(starts.sum())) - np.repeat(np.cumsum(starts) - starts, starts)
    return Block(vocabulary, items, np.array(numbers, np.int64), width, off[item] + first, item, first)


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_words`` words; the driver holds one at a time."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / (6 * block_words)))
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k)
        yield block_of(((r["id"], r["text"]) for r in part.toLocalIterator()), window)


def suffix_array(values: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``values`` (0 ends a run), ordered by the ``depth`` values that start there: prefix doubling."""
    rank, k = np.unique(values, return_inverse=True)[1].astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while k < depth:
        second = np.zeros_like(rank)
        second[:-k] = rank[k:] + 1
        key = rank * (len(values) + 2) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if rank[order[-1]] == len(values) - 1:
            break
        k *= 2
    return order


def _bound(values: np.ndarray, order: np.ndarray, depth: int, lo: np.ndarray, hi: np.ndarray, want: np.ndarray) -> np.ndarray:
    """First place in each range of ``order`` whose value at ``depth`` is at least ``want``."""
    lo, hi = lo.copy(), hi.copy()
    while len(open_ := np.flatnonzero(lo < hi)):
        mid = (lo[open_] + hi[open_]) >> 1
        less = values[order[mid] + depth] < want[open_]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
    return lo


def search(block: Block, values: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix number, place in ``values``) of every window of the block in the shard."""
    none = np.empty(0, np.int64)
    if not len(values) or not len(block.suffix):
        return none, none
    order = suffix_array(values, window)
    padded = np.concatenate([values, np.zeros(window, np.int64)])
    width = block.window[block.item]
    live = np.arange(len(block.suffix))
    lo, hi = np.zeros(len(live), np.int64), np.full(len(live), len(values), np.int64)
    found = []
    for depth in range(window):
        want = block.words[block.suffix[live] + depth]
        low = _bound(padded, order, depth, lo, hi, want)
        hi = _bound(padded, order, depth, low, hi, want + 1)
        lo = low
        some = lo < hi
        done = some & (width[live] == depth + 1)
        found.append((live[done], lo[done], hi[done]))
        rest = some & ~done
        live, lo, hi = live[rest], lo[rest], hi[rest]
        if not len(live):
            break
    suffix, lo, hi = (np.concatenate(x) for x in zip(*found))
    n = hi - lo
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return np.repeat(suffix, n), order[at]


def matched(block: Block, rows: list[bytes], window: int) -> tuple[np.ndarray, list[tuple[int, str, int, int, int]]]:
    """Words of each document, and its longest matches as (document, item, item word, document word, length)."""
    get = block.vocabulary.get
    words = [t.translate(texts.PLAIN).split() for t in rows]
    off = texts.offsets(map(len, words))
    codes = np.fromiter((get(w, 0) for ws in words for w in ws), np.int64, int(off[-1]))
    shortest = int(block.window.min()) if len(block.window) else window
    doc = texts.owner(off)
    # runs of known words within a document
    known = codes > 0
    edge = np.concatenate([[True], (known[1:] != known[:-1]) | (doc[1:] != doc[:-1])]) if len(codes) else known
    start = np.flatnonzero(edge)
    length = np.diff(np.concatenate([start, [len(codes)]]))
    use = known[start] & (length >= shortest) if len(start) else np.zeros(0, bool)
    start, length = start[use], length[use]
    # each run followed by a 0
    total = int((length + 1).sum())
    place = np.repeat(start - (np.cumsum(length + 1) - (length + 1)), length + 1) + np.arange(total)
    values = codes[np.minimum(place, max(len(codes) - 1, 0))] if total else np.empty(0, np.int64)
    values[np.cumsum(length + 1) - 1] = 0
    suffix, at = search(block, values, window)
    if not len(at):
        return np.diff(off), []
    item, first, word = block.item[suffix], block.first[suffix], place[at]
    order = np.lexsort((word, word - first, item))
    item, first, word = item[order], first[order], word[order]
    same = (item[1:] == item[:-1]) & (word[1:] == word[:-1] + 1) & (first[1:] == first[:-1] + 1)
    same &= doc[word[1:]] == doc[word[:-1]]
    head = np.flatnonzero(np.concatenate([[True], ~same]))
    run = np.diff(np.concatenate([head, [len(item)]])) + block.window[item[head]] - 1
    owner = doc[word[head]]
    return np.diff(off), [
        (int(d), block.items[i], int(f), int(w), int(n))
        for d, i, f, w, n in zip(owner, item[head], first[head], word[head] - off[owner], run)
    ]


def _by_row(count: int, hits: list[tuple[int, str, int, int, int]]) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(count)]
    for d, item, first, word, length in hits:
        out[d].append({"item": item, "item_word": first, "doc_word": word, "length": length})
    return out


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(id, n_words, hits): one row per document with its longest verbatim matches."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(
        F.col(id_col), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"), F.array().cast(HITS).alias("hits")
    )

    def searcher(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in texts.slices(batches):
                n, found = matched(shared.value, texts.raw(part), window)
                had = part.column("hits").to_pylist()
                hits = [a + b for a, b in zip(had, _by_row(part.num_rows, found))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column("text"), pa.array(n), pa.array(hits, pa.list_(HIT))],
                    names=[id_col, "text", "n_words", "hits"],
                )

        return run

    for block in blocks(benchmark, item_col, item_text_col, window, block_words):
        shared = spark.sparkContext.broadcast(block)
        out = texts.arrow(out, searcher(shared), f"`{id_col}` {kind}, text string, n_words long, hits {HITS}")
    return out.drop("text")


def contamination(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of `matches`: words in matches, items matched and a digest of their ids, the longest match."""
    kind = found.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest long"
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for hits in batch.column("hits").to_pylist():
                end = n_hit = 0
                for start, stop in sorted((h["doc_word"], h["doc_word"] + h["length"]) for h in hits):
                    n_hit += max(0, stop - max(start, end))
                    end = max(end, stop)
                items = sorted({h["item"] for h in hits})
                sha = hashlib.sha256(",".join(items).encode()).hexdigest()
                rows.append((n_hit, len(items), sha, n_hit > 0, max((h["length"] for h in hits), default=0)))
            columns = [list(c) for c in zip(*rows)] or [[], [], [], [], []]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("n_words"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest"],
            )

    return texts.arrow(found, digest, schema)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    spark, out = docs.sparkSession, docs

    def filtering(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in texts.slices(batches, text_col):
                _, found = matched(shared.value, texts.raw(part, text_col), window)
                keep = np.ones(part.num_rows, bool)
                keep[[h[0] for h in found]] = False
                yield part.filter(pa.array(keep))

        return run

    for block in blocks(benchmark, item_col, item_text_col, window, block_words):
        out = texts.arrow(out, filtering(spark.sparkContext.broadcast(block)), docs.schema)
    return out
