"""License scans with a positional index of license words, read from a file's rarest words down.

A first pass counts in how many documents each template word stands; it gives the inverse document
frequencies. The index holds, per word, its positions in the mandatory phrases of all templates. A file's
license words are looked up from the highest inverse document frequency down: the first one of a template
gives offsets at which the template may start, each further one keeps those where it stands at the same
offset. What is left when all mandatory words are through has every mandatory phrase in its place. The
share of the template's inverse document frequencies that stands at such an offset is the score.

A template fits wherever its mandatory phrases stand verbatim at one offset and the score is at least
``least`` (0.6). There is no other threshold: no word, place or template is left out before that.
Templates begin at any offset, also before the first word or beyond the last one.

Defined cases: null and empty texts have no words, no label and score 0; of equally rare words the
alphabetically first is looked up first; overlapping places all count; repeated rows are scanned one by
one; an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.llm import texts

#: (phrase, label) that make a place by themselves, as the query's contract gives them. Fixed values.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: (label, text, mandatory phrases): notices of public licenses. Fixed values.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ["you may not use this file except in compliance with the license"]),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted", "this software and associated documentation files"]),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy", ["permission is hereby granted free of charge to any person obtaining a copy"]),
    ("mit-grant", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ["this permission notice shall be included in all copies or substantial portions of the software"]),
    ("mit-notice", "released under the mit license", ["the mit license"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-3.0", "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ["gnu general public license as published by the free software foundation", "version 3 of the license"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-2.0", "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ["gnu general public license as published by the free software foundation", "version 2 of the license"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["gnu affero general public license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0 international"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike 4 0 international"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-nc-4.0", "licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial 4 0 international"]),
    ("cc0", "released under cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms"]),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ["redistributions of source code must retain the above copyright notice"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify and or distribute"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ["boost software license version 1 0"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ["in no event will the authors be held liable for any damages arising from the use of this software"]),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", ["eclipse public license 2 0"]),
]

#: (label, identifier) of lines that name a license by its short identifier. Fixed values.
IDENTIFIERS = [
    ("apache-2.0", "Apache-2.0"), ("mit-notice", "MIT"), ("gpl-3.0", "GPL-3.0"), ("gpl-2.0", "GPL-2.0"), ("lgpl", "LGPL"), ("agpl", "AGPL"),
    ("cc-by-4.0", "CC-BY-4.0"), ("cc-by-sa-4.0", "CC-BY-SA-4.0"), ("cc-by-nc-4.0", "CC-BY-NC-4.0"), ("cc0", "CC0-1.0"), ("bsd", "BSD-2-Clause"),
    ("bsd", "BSD-3-Clause"), ("mpl-2.0", "MPL-2.0"), ("isc", "ISC"), ("unlicense", "Unlicense"), ("bsl-1.0", "BSL-1.0"), ("zlib", "Zlib"), ("epl-2.0", "EPL-2.0"),
]

#: Smallest share of a template's inverse document frequencies that must stand at one offset.
LEAST = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    weights: tuple[float, ...]
    base: bool
    must: tuple[tuple[int, bytes], ...]  # positions and words of the mandatory phrases, rarest word first


def split(text: str) -> list[bytes]:
    return text.lower().encode().translate(texts.PLAIN).split()


def all_templates(base: Sequence = tuple(BASE), templates: Sequence = tuple(TEMPLATES), identifiers: Sequence = tuple(IDENTIFIERS)) -> list[tuple]:
    """(label, words, mandatory phrases, base) of every template; an identifier line is mandatory as a whole."""
    lines = [(label, f"spdx license identifier {name}") for label, name in identifiers]
    return (
        [(label, tuple(split(p)), [split(p)], True) for p, label in base]
        + [(label, tuple(split(t)), [split(p) for p in phrases], False) for label, t, phrases in templates]
        + [(label, tuple(split(t)), [split(t)], False) for label, t in lines]
    )


def vocabulary(library: Sequence[tuple]) -> set[bytes]:
    return {w for _, words, _, _ in library for w in words}


def positions(words: Sequence[bytes], phrase: Sequence[bytes]) -> range:
    at = next(i for i in range(len(words)) if tuple(words[i : i + len(phrase)]) == tuple(phrase))
    return range(at, at + len(phrase))


def compiled(counts: dict[bytes, int], total: int, library: Sequence[tuple]) -> list[Template]:
    """Templates with the weights, and the order of their mandatory words, that the document frequencies give."""
    idf = lambda w: math.log((total + 1) / (counts.get(w, 0) + 1)) + 1
    out = []
    for label, words, phrases, is_base in library:
        at = {i for p in phrases for i in positions(words, p)}
        must = sorted(((i, words[i]) for i in at), key=lambda m: (-idf(m[1]), m[1], m[0]))
        out.append(Template(label, words, tuple(map(idf, words)), is_base, tuple(must)))
    return out


def postings(library: Sequence[Template]) -> dict[bytes, list[tuple[int, int]]]:
    """Word to its (template, position) in mandatory phrases, the words from the rarest down."""
    weight = {w: x for t in library for w, x in zip(t.words, t.weights)}
    words = sorted({w for t in library for _, w in t.must}, key=lambda w: (-weight[w], w))
    out: dict[bytes, list[tuple[int, int]]] = {w: [] for w in words}
    for t, template in enumerate(library):
        for i, word in template.must:
            out[word].append((t, i))
    return out


def candidates(words: list[bytes], library: Sequence[Template], index: dict[bytes, list[tuple[int, int]]]) -> dict[int, set[int]]:
    """Template to the offsets at which all its mandatory words stand."""
    present = index.keys() & set(words)
    able = {t for t, template in enumerate(library) if all(w in present for _, w in template.must)}
    needed = {w for t in able for _, w in library[t].must}
    firsts = {library[t].must[0][1] for t in able}
    places: dict[bytes, list[int]] = {w: [] for w in firsts}
    if firsts:
        for at, word in enumerate(words):
            if word in places:
                places[word].append(at)
    size, offsets = len(words), {}
    for word in index:  # the file's license words, rarest first
        if word not in needed:
            continue
        for t, i in index[word]:
            if t not in able:
                continue
            if t not in offsets:
                offsets[t] = {at - i for at in places[word]}
            else:
                offsets[t] = {o for o in offsets[t] if 0 <= o + i < size and words[o + i] == word}
    return offsets


def found(words: list[bytes], library: Sequence[Template], index: dict[bytes, list[tuple[int, int]]], least: float = LEAST) -> list[tuple[int, int, float]]:
    """(template, offset, score) of the templates that fit."""
    if index.keys().isdisjoint(words):
        return []
    size, out = len(words), []
    for t, offsets in candidates(words, library, index).items():
        template = library[t]
        for offset in sorted(offsets):
            kept = sum(x for i, (w, x) in enumerate(zip(template.words, template.weights)) if 0 <= offset + i < size and words[offset + i] == w)
            score = kept / sum(template.weights)
            if score >= least:
                out.append((t, offset, min(score, 1.0)))
    return out


def frequencies(docs: DataFrame, words: set[bytes], text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """In how many documents each of a fixed set of words stands, and the number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for part in texts.slices(batches):
            for text in texts.raw(part):
                n[""] += 1
                n.update(w.decode() for w in words.intersection(text.translate(texts.PLAIN).split()))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    rows = texts.arrow(docs.select(F.col(text_col).alias("text")), count, "word string, n long")
    counts = {r["word"].encode(): r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return counts, counts.pop(b"", 0)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: Sequence = tuple(BASE), templates: Sequence = tuple(TEMPLATES),
    identifiers: Sequence = tuple(IDENTIFIERS), least: float = LEAST,
) -> DataFrame:
    """(id, n_words, found): one row per document with its (label, base, word, score) places. No shuffle of documents."""
    known = all_templates(base, templates, identifiers)
    counts, total = frequencies(docs, vocabulary(known), text_col)
    library = compiled(counts, total, known)
    index = postings(library)
    kind = docs.schema[id_col].dataType.simpleString()
    place = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches):
            n, places = [], []
            for text in texts.raw(part):
                words = text.translate(texts.PLAIN).split()
                n.append(len(words))
                places.append([
                    {"label": library[t].label, "base": library[t].base, "word": at, "score": score}
                    for t, at, score in found(words, library, index, least)
                ])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(places, pa.list_(place))], names=[id_col, "n_words", "found"]
            )

    schema = f"`{id_col}` {kind}, n_words long, found array<struct<label: string, base: boolean, word: long, score: double>>"
    return texts.arrow(docs.select(F.col(id_col), F.col(text_col).alias("text")), run, schema)


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per scanned document: its base places and all its labels."""
    own = F.filter("found", lambda f: f["base"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda f: f["label"]))), ",")
    return scanned.select(
        id_col,
        "n_words",
        F.size(own).cast("long").alias("n_base"),
        F.array_min(F.transform(own, lambda f: f["word"])).alias("first_word"),
        F.array_max(F.transform(own, lambda f: f["word"])).alias("last_word"),
        names(own).alias("base_labels"),
        names(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0)).alias("score"),
    )
