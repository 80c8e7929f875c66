"""Periodic runs of words: recompression into a run-length grammar, whose LCE queries extend grid candidates.

A run is a stretch with smallest period q and at least ``max(least, times * q)`` words (``times`` of at
least 2) that no neighbouring word extends keeping period q. A run of period p holds one place i of each
grid with steps of ``(times - 1) * p`` for which i + p lies in it too, so all pairs (i, i + p) on these
harmonic grids, for every p, are candidates; pairs whose words, or those around them, differ cannot be in
a run and go at once. The texts with a candidate left are compressed level by level: blocks of one symbol,
then pairs of a left and a right symbol, until a few symbols a text are left. Equal stretches are parsed
alike but for a symbol at their ends, so the longest common extension of two places is found by going up
and down the levels once. Extended both ways, a candidate gives the exact run, or none.

Defined cases: a null or empty text has no words and no run; very long texts are taken whole (about 200
bytes of memory a word); repeated rows are judged one by one; an empty table gives an empty result; of
the other columns, whatever their names, none is read; a null id is returned as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.llm import texts

#: Symbols a text may be left with at the top of the grammar; these are compared one by one.
TOP = 8
#: Candidates extended at once.
BLOCK = 1 << 21


@dataclass
class Level:
    """Symbols, the place of each one's parent on the next level, and the first child of each parent."""

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray  # one entry more than parents
    blocks: bool

    def reversed(self) -> Level:
        above = len(self.first) - 2
        return Level(self.symbols[::-1], above - self.parent[::-1], len(self.symbols) - self.first[::-1], self.blocks)


@dataclass
class Grammar:
    levels: list[Level]
    top: np.ndarray

    def reversed(self) -> Grammar:
        return Grammar([x.reversed() for x in self.levels], self.top[::-1])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols are equal from places i and j on, for i != j; both end at a wall."""
        p, q = i.copy(), j.copy()
        stopped = np.full(len(p), len(self.levels))
        going = np.arange(len(p))
        for height, level in enumerate(self.levels):
            if not len(going):
                break
            a, b = p[going], q[going]
            same = level.symbols[a] == level.symbols[b]
            above_a, above_b = level.parent[a], level.parent[b]
            inside = (level.first[above_a] != a) | (level.first[above_b] != b)  # not both at a parent's start
            if level.blocks:
                left, right = level.first[above_a + 1] - a, level.first[above_b + 1] - b
                step, ends = np.where(inside & same, np.minimum(left, right), 0), inside & (~same | (left != right))
            else:  # a right symbol ends its parent in both places
                step, ends = inside & same, inside & ~same
            a, b = a + step, b + step
            stopped[going[ends]] = height
            p[going], q[going] = np.where(ends, a, level.parent[a]), np.where(ends, b, level.parent[b])
            going = going[~ends]
        while len(going):
            going = going[self.top[p[going]] == self.top[q[going]]]
            p[going] += 1
            q[going] += 1
        for height in range(len(self.levels) - 1, -1, -1):
            level, now = self.levels[height], np.flatnonzero(stopped > height)
            a, b = level.first[p[now]], level.first[q[now]]
            step = (level.symbols[a] == level.symbols[b]).astype(a.dtype)
            if level.blocks:
                step *= np.minimum(level.first[p[now] + 1] - a, level.first[q[now] + 1] - b)
            p[now], q[now] = a + step, b + step
        return p - i


def recompressed(symbols: np.ndarray) -> Grammar:
    """Grammar of texts between walls (distinct negative symbols, first and last); others count from 0."""
    levels: list[Level] = []
    fresh, turn = int(symbols.max(initial=-1)) + 1, 0
    while len(symbols) and np.diff(np.flatnonzero(symbols < 0)).max(initial=0) > TOP + 1:
        size = len(symbols)
        starts = np.concatenate([[True], symbols[1:] != symbols[:-1]])
        if not starts.all():
            first = np.append(np.flatnonzero(starts), size)
            length, above = np.diff(first), symbols[first[:-1]]
            long = length > 1
            codes, kinds = pd.factorize(above[long] * (int(length.max()) + 1) + length[long])
            levels.append(Level(symbols, np.cumsum(starts) - 1, first, True))
            above[long] = fresh + codes
            fresh, symbols, size = fresh + len(kinds), above, len(above)
        turn += 1
        side = texts.mixed(symbols.astype(np.uint64) * texts.M1 + np.uint64(turn)) >> np.uint64(63) == 1
        word = symbols >= 0
        left, right = word & side, word & ~side
        one, two = left[:-1] & right[1:], right[:-1] & left[1:]
        at = np.flatnonzero(one if one.sum() >= two.sum() else two)
        if len(at):
            starts = np.ones(size, bool)
            starts[at + 1] = False
            first = np.append(np.flatnonzero(starts), size)
            parent, above = np.cumsum(starts) - 1, symbols[first[:-1]]
            codes, kinds = pd.factorize(symbols[at] * fresh + symbols[at + 1])
            levels.append(Level(symbols, parent, first, False))
            above[parent[at]] = fresh + codes
            fresh, symbols = fresh + len(kinds), above
    return Grammar(levels, symbols)


def candidates(symbols: np.ndarray, walls: np.ndarray, longest: int, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (place, period) on the harmonic grids that may lie in a run."""
    need = min(max(least - p, (times - 1) * p) for p in range(1, max(least, 1) + 1))  # equal pairs in a row that any run has
    places, periods, held = [], [], 0
    for p in range(1, longest // times + 1):
        step = (times - 1) * p
        at = np.flatnonzero(symbols[:-p:step] == symbols[p::step]) * step
        row, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for d in range(1 - need, need) if len(at) else ():
            one, two = np.clip(at + d, 0, len(symbols) - 1), np.clip(at + p + d, 0, len(symbols) - 1)
            row = np.where(symbols[one] == symbols[two], row + 1, 0)
            best = np.maximum(best, row)
        at = at[best >= need]
        at = at[np.searchsorted(walls, at) == np.searchsorted(walls, at + p)]  # both places in one text
        if len(at):
            places.append(at)
            periods.append(np.full(len(at), p))
            held += len(at)
        if held > BLOCK:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def _extended(grammar: Grammar, back: Grammar, at: np.ndarray, period: np.ndarray, least: int, times: int) -> np.ndarray:
    """(start, end, period) of the runs that the candidates lie in, distinct, smallest period of each stretch."""
    last = len(back.levels[0].symbols if back.levels else back.top) - 1
    after = grammar.common(at, at + period)
    before = back.common(last - at + 1, last - at - period + 1)
    rows = np.stack([at - before, at + period + after, period], axis=1)
    rows = rows[rows[:, 1] - rows[:, 0] >= np.maximum(least, times * period)]
    return _smallest(rows)


def _smallest(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort(rows.T[::-1])]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


def found(codes: np.ndarray, off: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """(document, start, length, period) of every run, ordered, of documents of numbered words."""
    count = len(off) - 1
    place = lambda docs: np.arange(off[-1]) + docs + 1  # noqa: E731  each text follows a wall
    docs = texts.owner(off)
    symbols = np.empty(off[-1] + count + 1, np.int64)
    walls = off + np.arange(count + 1)
    symbols[walls] = -1 - np.arange(count + 1)
    symbols[place(docs)] = codes
    longest = int(np.diff(off).max(initial=0))
    if off[-1] < BLOCK:  # few enough words to hold all candidates: only texts with one are compressed
        blocks = list(candidates(symbols, walls, longest, least, times))
        if not blocks:
            return np.empty((0, 4), np.int64)
        at, period = (np.concatenate(x) for x in zip(*blocks))
        owner = np.searchsorted(walls, at) - 1
        chosen = np.unique(owner)
        own = np.zeros(count, bool)
        own[chosen] = True
        keep = np.concatenate([[True], np.repeat(own, np.diff(off) + 1)])
        moved = np.cumsum(keep) - 1
        grammar = recompressed(symbols[keep])
        rows = _extended(grammar, grammar.reversed(), moved[at], period, least, times)
        walls, names = moved[np.concatenate([[0], walls[1:][own]])], chosen
    else:
        grammar = recompressed(symbols)
        back = grammar.reversed()
        parts = [_extended(grammar, back, at, p, least, times) for at, p in candidates(symbols, walls, longest, least, times)]
        rows, names = _smallest(np.concatenate([np.empty((0, 3), np.int64), *parts])), np.arange(count)
    owner = np.searchsorted(walls, rows[:, 0]) - 1
    out = np.stack([names[owner], rows[:, 0] - walls[owner] - 1, rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def collapsed(codes_off: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """True for each word that stays: one outside of all runs, or in the first period of each that holds it."""
    total = int(codes_off[-1])
    step = np.zeros(total + 1, np.int64)
    base = codes_off[runs[:, 0]] + runs[:, 1]
    np.add.at(step, base + runs[:, 3], 1)
    np.add.at(step, base + runs[:, 2], -1)
    return np.cumsum(step[:-1]) == 0


def detected(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 6,
    times: int = 4,
    prepare: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(id, n_words, runs array of (start, length, period) by start and period, collapsed text) of every row.

    ``prepare`` may replace the words of a row, given its id, before they are searched. No shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches):
            words = [t.split() for t in texts.raw(part)]
            if prepare:
                words = [prepare(i, w) for i, w in zip(part.column("id").to_pylist(), words)]
            off, codes, _ = texts.numbered(words)
            runs = found(codes, off, least, times)
            stays, short = collapsed(off, runs), set(runs[:, 0].tolist())
            left = [
                b" ".join([w for w, s in zip(ws, stays[off[k] : off[k + 1]].tolist()) if s] if k in short else ws)
                for k, ws in enumerate(words)
            ]
            ends = np.searchsorted(runs[:, 0], np.arange(len(words) + 1))
            fields = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.diff(off)), lists, pa.array(left, pa.binary())],
                names=["id", "n_words", "runs", "collapsed"],
            )

    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = texts.arrow(own, search, schema)
    return rows.select(F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def summary(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the run of the greatest exponent (ties: first start, then period) and digests of `detected` rows."""
    best = F.expr(
        "aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>),"
        " (a, r) -> if(a is null or r.length * a.period > a.length * r.period, r, a))"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return rows.select(
        F.col(f"`{id_col}`"), F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed"
    ).select(
        F.col(f"`{id_col}`"),
        "n_runs",
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("lines", lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
