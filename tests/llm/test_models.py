"""Language-model scores, periodic runs and whitening beside plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgate.llm import context_mixing, periodic_runs, quality_classifier, queries, texts, whitening
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns whose names the operators use themselves."""
    long = " ".join(f"w{i}" for i in range(8_000))
    rows = [(0, None), (1, ""), (2, " \t\n\x0b"), (3, long), (4, "a b " * 40), (5, "A " * 9), (5, "A " * 9), (6, "É!! É"), (None, "x y x y x y x y x"), (7, "a b " * 40 + "c")]
    names = ["id", "n_words", "runs", "collapsed", "train", "gram", "word", "row", "score", "base", "rare", "words", "n"]
    return spark.createDataFrame([(i, t, *["q"] * len(names)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))


# periodic runs


def plain_runs(words, least=6, times=4):
    seen = {}
    for q in range(1, len(words) // times + 1):
        t = 0
        while t < len(words) - q:
            start = t
            while t < len(words) - q and words[t] == words[t + q]:
                t += 1
            if t + q - start >= max(least, times * q):
                seen.setdefault((start, t + q), q)
            t += 1
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def made(rng, size):
    out, letters = [], rng.choice([1, 2, 3, 40])
    while len(out) < size:
        if rng.random() < 0.5:
            part = [rng.randrange(letters) for _ in range(rng.randrange(1, 12))]
            out += part * rng.randrange(1, 9) + part[: rng.randrange(len(part))]
        else:
            out += [rng.randrange(letters) for _ in range(rng.randrange(1, 20))]
    return out


@pytest.mark.parametrize("block", [periodic_runs.BLOCK, 40])
def test_runs_of_made_words(monkeypatch, block):
    monkeypatch.setattr(periodic_runs, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(120):
        docs = [made(rng, rng.randrange(200)) for _ in range(rng.randrange(1, 6))]
        codes = np.array([x for d in docs for x in d], np.int64)
        for least, times in ((6, 4), (1, 2), (9, 3)):
            got = periodic_runs.found(codes, texts.offsets(map(len, docs)), least, times)
            assert [tuple(r) for r in got] == [(k, *r) for k, d in enumerate(docs) for r in plain_runs(d, least, times)]


def test_places_that_agree_across_texts():
    docs = [[1, 2, 3, 4, 5, 6, 7, 8], list(range(20, 30)), [1, 2, 3, 4, 5, 6, 7, 8], list(range(40, 200))]
    docs = docs + [[7] * 9] + docs
    for some in (docs, docs[:4], docs[::-1]):
        got = periodic_runs.found(np.array([x for d in some for x in d], np.int64), texts.offsets(map(len, some)))
        assert [tuple(r) for r in got] == [(k, *r) for k, d in enumerate(some) for r in plain_runs(d)]


def test_common_extensions_both_ways():
    rng = random.Random(4)
    words = made(rng, 400)
    symbols = np.array([-1, *words, -2])
    grammar = periodic_runs.recompressed(symbols)
    assert len(grammar.top) <= periodic_runs.TOP + 2
    i = np.array([rng.randrange(1, 400) for _ in range(500)])
    j = np.array([rng.randrange(1, 400) for _ in range(500)])
    i, j = i[i != j], j[i != j]
    for one, way in ((grammar, symbols), (grammar.reversed(), symbols[::-1])):
        want = [next(k for k in range(len(way)) if way[a + k] != way[b + k]) for a, b in zip(i, j)]
        assert one.common(i, j).tolist() == want


def plain_summary(doc_id, text):
    words = brute.SPACED.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(left))


def test_periodic_runs_query(spark, odd):
    small = spark.read.parquet(f"{FOLDER}/documents.parquet").where(F.length("text") < 4000)
    for docs in (odd, small):
        got = periodic_runs.summary(periodic_runs.detected(docs, prepare=queries.repeated_tail)).collect()
        want = [plain_summary(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(w[1] for w in want)
    rows = {(r["doc_id"], r["collapsed"]) for r in periodic_runs.detected(odd).collect()}
    assert {(0, ""), (1, ""), (4, "a b"), (5, "A"), (None, "x y"), (7, "a b c")} <= rows
    assert periodic_runs.detected(odd.limit(0)).count() == 0
    assert queries.op12_periodic_runs(spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


# whitening


def whitened_beside_dense(df, id_col="vec_id", vector_col="embedding", least=1e-9):
    rows = {}
    for r in whitening.whitened(df, id_col, vector_col).collect():
        rows.setdefault(r[id_col], []).append(r)
    given = [(i, v) for i, v in df.select(id_col, vector_col).collect() if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in given], object)
    fit = np.array(sorted({tuple(r) for r in x}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((n * fit - sums) / n).astype(float)
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    keep = [k for k in np.argsort(-e)[:16] if e[k] > 1e-12 * max(e.max(), 1e-300)]
    plain = ((n * x - sums) / n).astype(float) @ axes[:, keep] / np.sqrt(e[keep])
    explained = e[keep] / e.sum()
    w = []
    for k, (i, _) in enumerate(given):
        got = rows[i][0]
        assert got["n"] == n and got["deviation"] == sum((n * a - b) ** 2 for a, b in zip(x[k], sums))
        assert len(got["whitened"]) == len(keep) and np.allclose(got["explained"], explained, rtol=least)
        assert got["identity_error"] < 1e-9
        w.append(got["whitened"])
    assert sum(map(len, rows.values())) == len(given)
    return np.array(w), plain, e[keep]


def test_whitening_beside_a_dense_solver(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    got, plain, e = whitened_beside_dense(df)
    assert got.shape[1] == 16
    assert np.allclose(np.abs(got), np.abs(plain), atol=1e-8 / (np.diff(-e).min() / e[0]))
    out = whitening.by_component(whitening.whitened(df))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 16 * len(got) and out.agg(F.min("component"), F.max("component")).first()[:] == (1, 16)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=5).round(2).tolist()) for k in range(40)]
    rows += [(100, rows[0][1]), (100, rows[0][1]), (None, rows[1][1])]
    bad = [(200, None), (201, [1.0, None, 2.0, 3.0, 4.0]), (202, [float("nan")] * 5), (203, [float("inf")] + [0.0] * 4), (204, []), (205, [1.0, 2.0]), (206, [1e300] * 5)]
    names = "x string, v string, id string, n string, whitened string, place string, own string"
    df = spark.createDataFrame([(i, v, *["q"] * 7) for i, v in rows + bad], f"vec_id long, embedding array<double>, {names}")
    out = whitening.whitened(df)
    assert sorted(r["vec_id"] for r in out.collect() if r["vec_id"] is not None) == [*range(40), 100, 100] and out.count() == 43
    assert out.first()["n"] == 40 and len(out.first()["whitened"]) == 5
    assert whitening.by_component(out).count() == 43 * 5
    assert whitening.whitened(df.limit(0)).count() == 0
    assert whitening.by_component(whitening.whitened(df.where("vec_id > 199"))).where("vec_id <> 204").count() in (0, 2)


def test_whitening_of_special_spectra(spark):
    rng = np.random.default_rng(5)
    make = lambda a: spark.createDataFrame([(k, v) for k, v in enumerate(np.asarray(a, float).tolist())], "vec_id long, embedding array<double>")
    equal = np.concatenate([np.eye(6), -np.eye(6)]) * 3  # all deviations equal
    got, _, e = whitened_beside_dense(make(equal))
    assert got.shape == (12, 6) and np.allclose(e, e[0]) and np.allclose(got.T @ got / 12, np.eye(6))
    flat = rng.integers(-50, 50, (30, 2)) @ rng.integers(-3, 3, (2, 7))  # rank two
    got, plain, _ = whitened_beside_dense(make(flat))
    assert got.shape[1] == 2 and np.allclose(np.abs(got), np.abs(plain), atol=1e-8)
    assert [len(r["whitened"]) for r in whitening.whitened(make(np.ones((3, 4)))).collect()] == [0, 0, 0]
    far = rng.normal(size=(50, 3)) * [1e9, 1e3, 1]  # beyond 64-bit products, deviations far apart
    got, plain, _ = (None,) * 3
    out = whitening.whitened(make(far)).collect()
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in out) and out[0]["identity_error"] < 1e-4


# language-model scores


def plain_keys(text):
    words = [brute.lowered(w) for w in brute.SPACED.findall(text or "")]
    return "".join(f"{w} " for w in words).encode() + b"\n"


def test_grams_are_contexts_and_bytes():
    words = [[b"ab", "cé".encode()], [], [b"ab", b"cd", b"ab", b"cd"]]
    got = [np.concatenate([g[d == k] for d, g in context_mixing.read(words)]) for k in range(3)]
    for own, keys in zip(words, got):
        body = b"".join(w + b" " for w in own) + b"\n"
        lead = b"\n" * 5 + body
        assert [int(k) & 255 for k in keys] == list(body)
        for t, key in enumerate(keys):
            assert int(key) >> 32 == int.from_bytes(lead[t + 1 : t + 5][::-1], "big")
    assert got[0][0] == got[1][0] & ~np.uint64(255) | np.uint64(ord("a")) == got[2][0]
    # equal contexts after the same five bytes, unless the word so far is of another length
    one, two, three = (context_mixing.grams(b"\n" * 5 + x) for x in (b"abcde abcdef", b"xbcdef", b"x abcdef"))
    assert one[5] != one[11] and one[11] == three[7] and one[11] >> np.uint64(32) == two[5] >> np.uint64(32)


def test_long_texts_in_pieces(monkeypatch):
    words = [[f"w{i * i % 97}".encode() for i in range(500)], [b"x"], [f"v{i}".encode() for i in range(7)]]
    whole = [(int(d), int(g)) for ds, gs in context_mixing.read(words) for d, g in zip(ds, gs)]
    monkeypatch.setattr(context_mixing, "PIECE_WORDS", 7)
    monkeypatch.setattr(context_mixing, "GRAM_BLOCK", 13)
    monkeypatch.setattr(texts, "SLICE_BYTES", 100)
    assert [(int(d), int(g)) for ds, gs in context_mixing.read(words) for d, g in zip(ds, gs)] == whole


def some_grams(seed=1, size=3000):
    rng = random.Random(seed)
    words = [[rng.choice([b"the", b"then", b"a", b"ant", b"tea"]) for _ in range(size // 4)]]
    keys = np.concatenate([g for _, g in context_mixing.read(words)])
    keys, counts = np.unique(keys, return_counts=True)
    counts = np.where(np.arange(len(keys)) % 5 == 0, 0, counts).astype(float)  # some are seen in no training text
    pairs = Counter()
    for k, c in zip(keys.tolist(), counts):
        pairs[k >> 48, k & 255] += c
    low = [np.array([p[i] for p in pairs], np.uint64) for i in (0, 1)]
    return keys, counts, context_mixing.Short.of(*low, np.array(list(pairs.values())))


def test_occurrences_beside_a_plain_count():
    keys, counts, short = some_grams()
    got = context_mixing.occurrences(keys, counts, short)
    for k, shift in enumerate(context_mixing.CONTEXTS):
        for j in range(9):
            own = Counter()
            for key, c in zip(keys.tolist(), counts):
                own[key >> shift, (key & 255) >> (8 - j)] += c
            assert got[k, j].tolist() == [own[key >> shift, (key & 255) >> (8 - j)] for key in keys.tolist()]


def test_probabilities_of_all_bytes_add_to_one():
    keys, counts, short = some_grams()
    rng = np.random.default_rng(2)
    weights = rng.normal(0.3, 0.2, (context_mixing.GATES, len(context_mixing.CONTEXTS)))
    cells = rng.random(context_mixing.CELLS)
    for context in rng.choice(keys, 20) >> np.uint64(8):
        every = np.concatenate([keys, context << np.uint64(8) | np.arange(256, dtype=np.uint64)])
        seen = context_mixing.occurrences(every, np.concatenate([counts, np.zeros(256)]), short)[:, :, -256:]
        logits, gate, longest = context_mixing.predictors(seen)
        p = context_mixing.refined((weights[gate] * logits).sum(axis=1), context_mixing.bits(every[-256:]), longest, cells)
        assert abs(p.reshape(8, -1).prod(axis=0).sum() - 1) < 1e-9


def plain_base(rows, held):
    words = {k: [*map(brute.lowered, brute.SPACED.findall(t or "")), None] for k, (_, t) in enumerate(rows)}
    c = Counter(w for k, ws in words.items() if not held(rows[k][0]) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(rows[k][0], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for k, ws in words.items()]


def test_scores_and_both_ways_to_them(spark, odd, monkeypatch):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = quality_classifier.held(F.col("doc_id"), 5, 1)
    for docs in (odd, given):
        got = context_mixing.scored(docs, ~held).toPandas()
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        want = plain_base(rows, lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1)
        key = lambda r: (r[0] is not None, r)
        mine = [(None if math.isnan(r[0]) else int(r[0]), *map(int, r[1:4]), r[4]) for r in got.iloc[:, :5].itertuples(index=False)]
        assert [r[:4] for r in sorted(mine, key=key)] == [r[:4] for r in sorted(want, key=key)]
        assert np.allclose([r[4] for r in sorted(mine, key=key)], [r[4] for r in sorted(want, key=key)], rtol=1e-12)
        assert (got["score"] < 0).all() and np.allclose(got["bits_per_byte"], -got["score"] * math.log2(10) / got["n_bytes"])
        assert sorted(got["n_bytes"]) == sorted(len(plain_keys(t)) for _, t in rows)
    unseen = got[got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 1)]
    assert -unseen["score"].sum() * math.log2(10) / unseen["n_bytes"].sum() < 3  # held out; bytes alone take more than 4
    monkeypatch.setattr(context_mixing, "FREQUENT", 64)
    monkeypatch.setattr(context_mixing, "FREQUENT_WORDS", 16)
    joined = context_mixing.scored(given, ~held).toPandas().set_index("doc_id").loc[got["doc_id"]]
    assert np.allclose(joined["base_score"], got["base_score"]) and (joined["n_known"].to_numpy() == got["n_known"].to_numpy()).all()
    assert np.allclose(joined["score"], got["score"], rtol=0.02)  # the shards' weights depend on how they are dealt


def test_scores_without_rows(spark, odd):
    assert context_mixing.scored(odd.limit(0), F.lit(True)).count() == 0
    none = context_mixing.scored(odd, F.lit(None).cast("boolean")).collect()
    assert {r["train_tokens"] for r in none} == {0} and all(abs(r["base_score"]) < 1e-6 and abs(r["bits_per_byte"] - 8) < 1e-6 for r in none)
