"""Plain versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_words(text: str | None) -> list[str]:
    return PLAIN.findall(lowered(text or ""))


def quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = SPACED.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def contamination(text: str | None, items: list[tuple[object, str | None]], window: int = 10) -> tuple:
    """n_words, n_hit, n_items, items_sha256, contaminated."""
    words = plain_words(text)
    places: dict[tuple, list[int]] = {}
    sizes = {min(window, len(plain_words(t))) for _, t in items} - {0}
    for size in sizes:
        for i in range(len(words) - size + 1):
            places.setdefault(tuple(words[i : i + size]), []).append(i)
    hit, found = set(), set()
    for item, t in items:
        own = plain_words(t)
        size = min(window, len(own))
        for j in range(len(own) - size + 1 if size else 0):
            for i in places.get(tuple(own[j : j + size]), ()):
                hit.update(range(i, i + size))
                found.add("" if item is None else str(item))
    sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), sha, bool(hit)


def shingles(text: str | None) -> set:
    words = SPACED.findall(lowered(text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def linked(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id to (n_shingles, component_id), for distinct ids."""
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders: dict[tuple, list[int]] = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    tried = set()
    for at in holders.values():
        for a in at:
            for b in at:
                if a < b and (a, b) not in tried:
                    tried.add((a, b))
                    x, y = sets[a][1], sets[b][1]
                    common = len(x & y)
                    if 100 * common >= 80 * (len(x) + len(y) - common):
                        low, high = sorted((root(sets[a][0]), root(sets[b][0])))
                        parent[high] = low
    return {i: (len(s), root(i)) for i, s in sets}


def licences(text: str | None, base: list[tuple[str, str]]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels."""
    words = plain_words(text)
    at, labels = [], set()
    for phrase, label in base:
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def licence_labels(docs: list[tuple], library: list[tuple], least: float) -> list[tuple]:
    """(id, labels, score): every template tried at every offset of every text."""
    texts = [(i, [w.encode() for w in plain_words(t)]) for i, t in docs]
    held = [set(words) for _, words in texts]
    vocabulary = {w for _, words, _, _ in library for w in words}
    idf = {w: math.log((len(docs) + 1) / (sum(w in h for h in held) + 1)) + 1 for w in vocabulary}
    out = []
    for i, words in texts:
        labels, best = set(), 0.0
        for label, own, phrases, _ in library:
            must = [(n, p) for p in phrases for n in [next(k for k in range(len(own)) if list(own[k : k + len(p)]) == p)]]
            whole = sum(idf[w] for w in own)
            for at in range(1 - len(own), len(words)):
                here = lambda k: words[at + k] if 0 <= at + k < len(words) else None  # noqa: E731, B023
                if all(here(n + k) == w for n, p in must for k, w in enumerate(p)):
                    score = sum(idf[w] for k, w in enumerate(own) if here(k) == w) / whole
                    if score >= least:
                        labels.add(label)
                        best = max(best, min(score, 1.0))
        out.append((i, ",".join(sorted(labels)), round(best, 9)))
    return out


def tokens(docs: list[tuple[int, str | None]], tokenizer, end_id: int = 2) -> list[tuple]:
    """(doc_id, start, n_tokens, ids_crc32) in order of the id."""
    out, start = [], 0
    for i, text in sorted(docs, key=lambda d: d[0]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    return out


def distance_at_most_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def duplicate_lines(docs: list[tuple[int, str | None]], near_chars: int = 20) -> dict[tuple[int, int], bool]:
    """(doc_id, line_no) of every line to drop, and whether it is an exact copy of an earlier one only."""
    rows = [(i, n, x) for i, t in sorted(docs, key=lambda d: d[0]) for n, x in enumerate((t or "").split("\n")) if SPACED.search(x)]
    first: dict[str, tuple[int, int]] = {}
    for i, n, x in rows:
        first.setdefault(x, (i, n))
    near: set[str] = set()
    kinds = sorted((x for x in first if len(x) >= near_chars - 1), key=len)
    by_size: dict[int, list[str]] = {}
    for x in kinds:
        by_size.setdefault(len(x), []).append(x)
    for x in kinds:
        if len(x) < near_chars:
            continue
        for size in (len(x) - 1, len(x), len(x) + 1):
            if size < near_chars:
                continue
            if any(first[y] < first[x] and y != x and distance_at_most_one(x, y) for y in by_size.get(size, ())):
                near.add(x)
                break
    return {(i, n): x not in near for i, n, x in rows if x in near or first[x] != (i, n)}
