"""Quality rules: characters inside repeated n-grams and lines, by rolling hashes of several lengths.

Defined cases: a null or empty text has no words, all counts 0 and fails the base rule; a text shorter
than an n-gram has none of that length; repeated rows are judged one by one; an empty table gives an
empty result; other columns, whatever their names, are not read and `rejected` and `accepted` keep them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusgate.llm import texts

SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Limits:
    """Largest accepted shares of the word characters, by n-gram length, and of those in repeated lines."""

    grams: dict[int, float] = field(
        default_factory=lambda: {5: 0.50, 6: 0.48, 7: 0.46, 8: 0.44, 9: 0.42, 10: 0.40}
    )
    lines: float = 0.30
    min_words: int = 50
    repeat_words: float = 0.50


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs at least twice."""
    codes, distinct = pd.factorize(keys)
    return (np.bincount(codes, minlength=len(distinct))[codes] > 1) if len(keys) else np.zeros(0, bool)


def _exact_triples(codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Words inside 3-word windows found at least twice in their document; compared by the words themselves."""
    total = len(codes)
    at = texts.inside(off, 3)
    if not len(at):
        return np.zeros(total, bool)
    size = int(codes.max()) + 1
    pair = pd.factorize(codes[at] * size + codes[at + 1])[0].astype(np.int64)
    triple, kinds = pd.factorize(pair * size + codes[at + 2])
    return texts.covered(at[repeated(texts.owner(off)[at] * len(kinds) + triple)], 3, total)


def measured(rows: list[bytes], limits: Limits) -> dict[str, np.ndarray]:
    """Base counts, the share of characters in repeated n-grams of each length and in repeated lines, verdicts."""
    words = [t.split() for t in rows]
    off, codes, distinct = texts.numbered(words)
    n_words = np.diff(off)
    drop = texts.SPACE + CONTINUATION
    word_chars = np.array([len(t.translate(None, drop)) for t in rows], np.int64)
    lengths = np.fromiter((len(w.translate(None, CONTINUATION)) for w in distinct), np.int64, len(distinct))[codes]
    n_symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in rows], np.int64)
    n_dup_lines, line_chars = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for k, text in enumerate(rows):
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            if line in seen:
                n_dup_lines[k] += 1
                line_chars[k] += len(line.translate(None, drop))
            elif line.strip(texts.SPACE):
                seen.add(line)
    n_repeat = texts.summed(_exact_triples(codes, off), off)
    base = (n_words < limits.min_words) | (n_repeat > limits.repeat_words * n_words)
    kept, chars = ~base, np.maximum(word_chars, 1)
    out = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "base_failed": base,
    }
    seeds = texts.mixed((codes.astype(np.uint64) + np.uint64(1)) * texts.M1)
    documents = texts.mixed((texts.owner(off).astype(np.uint64) + np.uint64(1)) * texts.M3)
    for n, most in limits.grams.items():
        at = texts.inside(off, n)
        keys = texts.rolled(seeds, n)[at] ^ documents[at]
        inside = texts.covered(at[repeated(keys)], n, len(codes))
        share = texts.summed(inside * lengths, off) / chars
        out[f"gram{n}_share"] = share
        kept &= share <= most
    out["line_share"] = line_chars / chars
    out["kept"] = kept & (out["line_share"] <= limits.lines)
    return out


def rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits | None = None) -> DataFrame:
    """One row per document: its counts, shares and verdicts. Needs no shuffle."""
    limits = limits or Limits()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    shares = [f"gram{n}_share" for n in limits.grams] + ["line_share"]
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(
        [f"{c} long" for c in counts] + ["base_failed boolean"] + [f"{s} double" for s in shares] + ["kept boolean"]
    )
    order = [*counts, "base_failed", *shares, "kept"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, text_col):
            got = measured(texts.raw(part, text_col), limits)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), *(pa.array(got[c]) for c in order)], names=[id_col, *order]
            )

    return texts.arrow(docs.select(id_col, text_col), judge, schema)


def accepted(docs: DataFrame, text_col: str = "text", limits: Limits | None = None) -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    limits = limits or Limits()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, text_col):
            yield part.filter(pa.array(measured(texts.raw(part, text_col), limits)["kept"]))

    return texts.arrow(docs, keep, docs.schema)
