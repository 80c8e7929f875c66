"""The ten operators beside plain versions, on made cases and on the smallest given tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusgate.llm import (
    decontaminate,
    jaccard_join,
    licenses,
    line_dedup,
    mixing,
    quality_classifier,
    quality_rules,
    queries,
    texts,
    token_records,
    toxicity,
    url_filters,
)
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, source string, n_words string, score string, hits string, id string, label string, cls string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns whose names the operators use themselves."""
    long = " ".join(f"w{i}" for i in range(30_000))
    copy = " ".join(f"c{i % 70}" for i in range(120))
    rows = [(0, None), (1, ""), (2, " \t\n\x0b"), (3, long), (4, copy), (5, copy), (5, copy), (6, "É!! É!! the mit license, É"), (None, "some words of a text without an id"), (7, copy + " tail")]
    return spark.createDataFrame([(i, t, None if k % 3 else "s", "x", "y", "z", "q", "r", "t") for k, (i, t) in enumerate(rows)], CLASH)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "c3 c4 c5 c6 c7 c8 c9 c10 c11 c12 c13"), (2, "mit license"), (3, None), (None, "w1 w2"), (1, "c3 c4 c5 c6 c7 c8 c9 c10 c11 c12 c13")], "item_id long, text string")


def plain(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def key(row):
    return tuple((x is not None, x) for x in row)


def test_quality_rules(spark, odd):
    for docs in (odd, given(spark)):
        got = quality_rules.rules(docs).drop("kept", *[c for c in quality_rules.rules(docs).columns if c.endswith("_share")])
        want = [(i, *brute.quality(t)) for i, t in plain(docs)]
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    kept = quality_rules.accepted(odd)
    assert kept.columns == odd.columns and 3 in {r["doc_id"] for r in kept.collect()}
    assert quality_rules.rules(odd.limit(0)).count() == 0
    repeated = spark.createDataFrame([(1, "\n".join(["one line of eight words that comes again"] * 30))], "doc_id long, text string")
    assert quality_rules.accepted(repeated).count() == 0


def test_contamination(spark, odd, bench):
    given_bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    for docs, items in ((odd, bench), (given(spark), given_bench)):
        pairs = [tuple(r) for r in items.select("item_id", "text").collect()]
        want = sorted([(i, *brute.contamination(t, pairs)) for i, t in plain(docs)], key=key)
        for words in (decontaminate.BLOCK_WORDS, 3):  # one block, and many
            found = decontaminate.matches(docs, items, block_words=words if docs is odd else decontaminate.BLOCK_WORDS)
            got = decontaminate.contamination(found).drop("longest")
            assert sorted(map(tuple, got.collect()), key=key) == want
    left = decontaminate.clean(odd, bench)
    assert left.columns == odd.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=lambda i: (i is not None, i)) == sorted((w[0] for w in sorted([(i, *brute.contamination(t, [tuple(r) for r in bench.collect()])) for i, t in plain(odd)], key=key) if not w[5]), key=lambda i: (i is not None, i))
    assert decontaminate.contamination(decontaminate.matches(odd, bench.limit(0))).where("contaminated").count() == 0
    assert decontaminate.matches(odd.limit(0), bench).count() == 0


def test_longest_match_and_place(spark, bench):
    docs = spark.createDataFrame([(1, "a b " + "c3 c4 c5 c6 c7 c8 c9 c10 c11 c12 c13 tail")], "doc_id long, text string")
    hits = {(h["item"], h["item_word"], h["doc_word"], h["length"]) for h in decontaminate.matches(docs, bench.where("item_id = 1").limit(1)).first()["hits"]}
    assert hits == {("1", 0, 2, 11)}


def test_suffix_array_orders_by_depth():
    values = np.array([2, 1, 2, 1, 0, 2, 1, 3, 0])
    order = decontaminate.suffix_array(values, 4)
    keys = [tuple([*values[i : i + 4], 0, 0, 0, 0][:4]) for i in order]
    assert keys == sorted(keys)


def test_url_filters(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y", "https://a.example.com/en/#t", "http://x.net/es/1", "http://x.net/es", "http://x.net", "ftp://a.b.com", "http://com/", "http://xcom/", "a://b://c.com/"]
    pages = spark.createDataFrame([(k, u, "h", "p") for k, u in enumerate(urls)] + [(6, urls[6], "h", "p")], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judged(pages, url_filters.rule_table(spark)).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[4] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[5] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert got[6] == ("x.net", "/es/1", "net/es/", "block")
    assert got[7][2] is None and got[8] == ("x.net", "", None, "allow") and got[9][2] is None
    assert got[10][2] == "com/" and got[11][2] is None and got[12] == ("b:", "//c.com/", None, "allow")
    assert url_filters.judged(pages, url_filters.rule_table(spark)).count() == len(urls) + 1
    assert url_filters.allowed(pages, url_filters.rule_table(spark)).count() == len(urls) - 2
    assert url_filters.judged(pages.limit(0), url_filters.rule_table(spark)).count() == 0
    assert url_filters.judged(pages, url_filters.rule_table(spark, [])).where("verdict = 'block'").count() == 0


def near_copies(seed, count, words=60):
    rng = random.Random(seed)
    bases = [[f"b{k}x{rng.randrange(4000)}" for _ in range(words)] for k in range(6)]
    rows = []
    for i in range(count):
        text = list(bases[0 if rng.random() < 0.4 else rng.randrange(6)])
        for _ in range(rng.randrange(4)):
            text[rng.randrange(words)] = f"e{rng.randrange(9000)}"
        rows.append((i, " ".join(text)))
    return rows + [(count, rows[0][1]), (count + 1, "a b"), (count + 2, "A B"), (count + 3, None), (count + 4, "")]


def test_jaccard_join(spark, odd):
    for docs in (spark.createDataFrame(near_copies(3, 150), "doc_id long, text string").repartition(4), given(spark)):
        want = {(i, *v) for i, v in brute.linked(plain(docs)).items()}
        assert {tuple(r) for r in jaccard_join.linked(docs).collect()} == want
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_join.linked(odd).collect()}
    assert {(0, 0), (1, 1), (4, 4), (5, 4), (7, 4), (None, None)} <= got
    kept = jaccard_join.deduplicated(odd)
    assert kept.columns == odd.columns and kept.where("doc_id in (5, 7)").count() == 0 and kept.where("doc_id = 4").count() == 1
    assert jaccard_join.linked(odd.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    """Null and repeated ids: which rows go is decided row by row."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [
        (1, text("a"), "s"), (None, text("a") + " tail", "s"), (None, text("b"), "s"), (None, "other words", "s"),  # a null id near an id
        (2, text("c"), "s"), (3, text("c") + " tail", "s"), (3, text("d"), "s"),  # one id, two texts
        (None, text("e"), "s"), (None, text("e") + " tail", "s"), (None, text("e"), "s"),  # null ids alone
        (4, text("f"), "s"), (4, text("f"), "s"), (4, text("f") + " tail", "s"), (5, text("f"), "s"),  # repeated smallest id
        (6, text("g"), "t"), (6, text("g"), "s"), (None, None, "s"), (None, None, "s"), (7, "", "s"), (7, "", "s"),
    ]
    docs = spark.createDataFrame([(*r, {"k": r[2]}) for r in rows], "doc_id long, text string, source string, tags map<string, string>")
    kept = jaccard_join.deduplicated(docs.repartition(5))
    assert kept.columns == docs.columns and kept.schema["tags"].dataType == docs.schema["tags"].dataType
    got = [(r["doc_id"], (r["text"] or "-")[0]) for r in kept.collect()]
    want = [(1, "a"), (None, "b"), (None, "o"), (2, "c"), (3, "d"), (None, "e"), (4, "f"), (6, "g"), (None, "-"), (None, "-"), (7, "-"), (7, "-")]
    assert sorted(got, key=key) == sorted(want, key=key)
    again = jaccard_join.deduplicated(docs.repartition(3, "source"))
    assert sorted(map(str, again.collect())) == sorted(map(str, kept.collect()))


def test_order_of_frequent_shingles_keeps_results(spark, monkeypatch):
    docs = spark.createDataFrame(near_copies(9, 120), "doc_id long, text string")
    want = {(i, *v) for i, v in brute.linked(plain(docs)).items()}
    monkeypatch.setattr(jaccard_join, "FREQUENT", 2)
    monkeypatch.setattr(jaccard_join, "RANGE_BYTES", 1 << 12)
    monkeypatch.setattr(jaccard_join, "MARKED", 64)
    assert {tuple(r) for r in jaccard_join.linked(docs).collect()} == want


def test_deduplication_keeps_columns_named_like_its_own(spark):
    text = " ".join(f"k{i}" for i in range(30))
    rows = [(1, text, "a", "n1", "s"), (2, text, "b", "n2", "s"), (3, "other words", "c", "n3", "s"), (3, "other words", "c", "n3", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row string, __one string, stays string")
    kept = jaccard_join.deduplicated(docs)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_licenses(spark, odd):
    for docs in (odd, given(spark)):
        got = licenses.summary(licenses.scan(docs)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
        want = [(i, *brute.licences(t, licenses.BASE)) for i, t in plain(docs)]
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    text = "MIT License mit license. Licensed under CC BY-NC 4.0; the GNU General Public License"
    row = licenses.summary(licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == (3, 0, 13, "gpl,mit")
    assert "cc-by-nc-4.0" in row["labels"].split(",") and 0 <= row["score"] <= 1
    assert licenses.scan(odd.limit(0)).count() == 0


NOTICES = [
    ("SPDX-License-Identifier: MIT", "mit-notice"),
    ("// SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit-grant"),
    ("Distributed under the Boost Software License, Version 1.0.", "bsl-1.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl,gpl-3.0"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "apache,apache-2.0"),
    ("version 2 0 of the apache licence; permission is granted", ""),
    ("Apache License Version 2.0", "apache"),  # the base phrase alone; the notice needs more of its words
    ("the gnu lesser general public license", "gpl,lgpl"),  # the base phrase stands in it
]


def test_licence_labels(spark, odd):
    notices = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NOTICES)], "doc_id long, text string")
    known = licenses.all_templates()
    for docs in (notices, odd.where("text not like 'w0 %' or text is null"), given(spark).where("length(text) < 1500")):
        for least in (licenses.LEAST, 0.3):
            got = licenses.summary(licenses.scan(docs, least=least)).select("doc_id", "labels", "score").collect()
            want = brute.licence_labels(plain(docs), known, least)
            assert sorted(((i, lab, round(s, 9)) for i, lab, s in got), key=key) == sorted(want, key=key)
    got = {r["doc_id"]: r["labels"] for r in licenses.summary(licenses.scan(notices)).collect()}
    assert {NOTICES[i][0]: got[i] for i in got} == dict(NOTICES)


def test_token_records(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    docs = given(spark)
    got = token_records.encoded(docs, queries.tokenizer_path(), 2, str(tmp_path / "a"))
    assert sorted(tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == brute.tokens(plain(docs), tokenizer)
    some = got.where("doc_id % 40 = 3")
    picked = token_records.at(spark, str(tmp_path / "a"), some).collect()
    assert {(r["doc_id"], zlib.crc32(r["ids"])) for r in picked} == {(r["doc_id"], r["ids_crc32"]) for r in some.collect()}
    rows = token_records.encoded(odd, queries.tokenizer_path(), 2).collect()
    assert len(rows) == odd.count() and {r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2)} == {1}
    assert token_records.encoded(odd.limit(0), queries.tokenizer_path(), 2).count() == 0


def test_encoder_agrees_with_whole_texts():
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        encoder = token_records.Encoder(f.read())
    rows = ["It's <|endoftext|> ÉTÉ,, Zoë. a.b ,x 12,000 don't\n\nStop!", "naïve cafe\u0301 ſ ŉ İstanbul ß, Ǆ. 日本語 text", "  ", "\u00a0x\u2028y", "a" * 5000 + ", " + "ñ" * 300]
    want = [np.array(e.ids, "<u2").tobytes() for e in encoder.tokenizer.encode_batch(rows, add_special_tokens=False)]
    assert encoder.words and encoder.parts and list(encoder.encode(rows, 2)) == want


def test_damaged_record_is_found():
    data = bytearray(token_records.framed(7, b"\x01\x00\x02\x00", 2) + token_records.END)
    assert [(r[2], list(r[3])) for r in token_records.parsed(bytes(data))] == [(7, [1, 2])]
    for at in (0, 9, 14, len(data) - 3):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(token_records.parsed(bytes(broken)))


def test_line_dedup(spark, odd):
    rng = random.Random(5)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randint(18, 40))) for _ in range(20)]

    def edit(x):
        i, c = rng.randrange(len(x)), rng.choice("abcé")
        return rng.choice([x, x[:i] + x[i + 1 :], x[:i] + c + x[i:], x[:i] + c + x[i + 1 :]])

    rows = [(i, "\n".join(edit(edit(rng.choice(base))) for _ in range(rng.randint(1, 6)))) for i in range(60)]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string"), given(spark)):
        got = {(r["doc_id"], r["line_no"]): r["exact"] for r in line_dedup.duplicates(docs).collect()}
        assert got == brute.duplicate_lines(plain(docs))
        counts = {(r["doc_id"], r["n_dropped"], r["n_near"]) for r in line_dedup.per_document(docs).collect()}
        assert counts == {(i, sum(k[0] == i for k in got), sum(k[0] == i and not x for k, x in got.items())) for i, _ in plain(docs)}
    left = line_dedup.cleaned(odd)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert line_dedup.per_document(odd.limit(0)).count() == 0


def test_line_dedup_goes_by_row(spark):
    """Repeated and null ids, repeated rows, and columns named like the operator's own."""
    own = ["want", "gone", "row", "doc", "copy", "gid", "gdoc", "rid", "rdoc", "repeats", "id", "line_no", "__id", "__gone"]
    line = "a line of some thirty letters x"
    make = lambda *rows: spark.createDataFrame([(i, t, *["q"] * len(own)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in own))
    texts_of = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    for one, two in ((1, 2), (None, 2), (None, None), (2, 2)):
        docs = make((one, line), (two, f"{line}\nonly here, in this text"), (two, "only one keeps this line\nanother line of its own"))
        left = line_dedup.cleaned(docs)
        kept = [t for _, t in texts_of(left)]
        assert left.columns == docs.columns and "only one keeps this line\nanother line of its own" in kept
        assert sum(t.count(line) for t in kept) == 1 and sum("only here" in t for t in kept) == 1
    docs = make((7, line), (7, line), (7, line), (8, "other words in this one"), (None, line + "y"))
    assert [t for _, t in texts_of(line_dedup.cleaned(docs))].count("") == 3
    rows = sorted((tuple(r) for r in line_dedup.per_document(docs).collect()), key=repr)
    assert rows == sorted([(7, 1, 1, 1, 0), (7, 1, 1, 1, 0), (7, 1, 1, 1, 0), (8, 1, 0, 0, None), (None, 1, 0, 0, None)], key=repr)
    dropped = line_dedup.duplicates(docs).where("copy = 0").collect()
    assert [(r["doc_id"], r["kept_id"], r["exact"]) for r in dropped] == [(7, None, False)]
    clash = spark.createDataFrame([(1, "http://x.net/es/1", "a"), (2, "http://x.org/", "b")], "page_id long, url string, good string")
    assert [r["good"] for r in url_filters.allowed(clash.withColumn("__good", F.lit(1)).withColumn("page", F.lit(2)), url_filters.rule_table(spark)).collect()] == ["b"]


def test_mixing(spark, odd):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), "big" if i % 10 < 6 else f"s{i % 10}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = mixing.Target(entropy=0.5, repeats=2.0)
    planned = {r["source"]: r for r in mixing.plan(docs, target).collect()}
    size = {i: len(t.split()) + 1 for i, t, _ in rows}
    drawn = mixing.drawn(docs, mixing.plan(docs, target), target).select("document.doc_id", "document.source", "epoch").collect()
    n, times = {}, {}
    for r in drawn:
        n["=" + r["source"]] = n.get("=" + r["source"], 0) + size[r["doc_id"]]
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    for source, r in planned.items():
        assert 0 <= r["budget"] - n[source] <= 61 and r["budget"] <= 2.0 * r["n"] + 1
    assert abs(sum(r["weight"] for r in planned.values()) - 1) < 1e-9
    assert max(times.values()) <= 2
    # the exponent against a plain bisection
    shares = [r["n"] for r in planned.values()]

    def entropy(a):
        w = np.array([x**a for x in shares], float)
        w /= w.sum()
        return float(-(w * np.log(w)).sum())

    a = planned["=big"]["exponent"]
    wanted = entropy(1) + 0.5 * (entropy(0) - entropy(1))
    repeats = lambda e: max(x ** (e - 1) for x in shares) * sum(shares) / sum(x**e for x in shares)
    assert entropy(a) <= wanted + 1e-9 and repeats(a) <= 2 + 1e-9
    assert a == 0 or entropy(a - 1e-4) > wanted or repeats(a - 1e-4) > 2
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns and mixing.mixed(odd.limit(0)).count() == 0


def test_toxicity_learns_and_composes(spark, odd):
    grammar = toxicity.Grammar({b"idiot": 0.9})
    assert grammar.score(b"you idiot") > grammar.score(b"an idiot") > grammar.score(b"not an idiot") > grammar.score(b"fine")
    assert grammar.score(b"he said an idiot") < grammar.score(b"an idiot")
    rng = random.Random(4)
    vocabulary = [f"wort{k}" for k in range(300)]
    rows = []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(40)]
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(40), rng.choice(["zorkel", "zorkelen"]))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    learned = toxicity.learned(spark.createDataFrame(rows[:300], "doc_id long, text string, label int"))
    assert b"zorkel" in learned.words
    right = [(learned.score(t.encode()) >= 0.3) == bool(y) for _, t, y in rows[300:]]
    assert sum(right) >= 98
    scored = toxicity.scored(odd, learned)
    assert scored.count() == odd.count() and scored.where("score < 0 or score > 1 or score is null").count() == 0
    none = toxicity.learned(odd.select("doc_id", "text", F.lit(None).cast("int").alias("label")))
    assert none.score(b"an idiot") >= 0.3 > none.score(b"")


def test_threats_count_however_they_are_written(spark):
    grammar = toxicity.Grammar({b"idiot": 0.9})
    plain = grammar.strength(b"you will burn today")
    assert plain > 0
    for text in ("You will burn.", "you will BURN!", "You will (burn)", "so,you will burn?Yes", "Du willst TÖTEN", "fine.idiot.fine"):
        assert grammar.strength(text.encode()) > 0, text
    assert grammar.strength(b"KILL them") == grammar.strength(b"kill them") > 0
    texts_ = ["You will burn.", "KILL them! Fine; idiot.Really", "nothing at all.", "", "He said burn. Not you idiot"]
    for text in texts_:  # the shortcut changes nothing
        assert grammar.strength(text.encode()) == sum(grammar.clause(c.split()) for c in toxicity.CLAUSE.split(text.encode()))
    docs = spark.createDataFrame([(1, "You will hang!"), (2, "nothing at all")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, grammar).collect()}
    assert score[1] > score[2]


def test_quality_classifier(spark, odd):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        words = [f"wort{rng.randrange(500)}" for _ in range(30)]
        rows.append((i, " ".join(w + "***" if i % 3 == 0 and rng.random() < 0.7 else w for w in words), int(i % 3 > 0)))
    model = quality_classifier.fit(spark.createDataFrame(rows[:300], "doc_id long, text string, label int"))
    scores = model.scores([t.encode() for _, t, _ in rows[300:]], quality_classifier.Shapes())
    assert np.mean((scores >= 0.5) == [y == 1 for *_, y in rows[300:]]) >= 0.97
    scored = quality_classifier.scored(odd, model)
    assert scored.count() == odd.count() and scored.where("score < 0 or score > 1 or score is null").count() == 0
    one = quality_classifier.fit(odd.select("doc_id", "text", F.lit(1).alias("label")))
    assert one.scores([b"", b"x y"], quality_classifier.Shapes()).min() >= 0.5


def test_held_out_rows(spark):
    ids = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("held", quality_classifier.held(F.col("doc_id"), 3, 1))
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in ids.collect())


def test_pipeline(spark):
    """run() against the stages' plain versions; what mixing draws is taken from its own plan."""
    from tokenizers import Tokenizer

    docs = given(spark)
    rejected = {r["doc_id"] for r in quality_rules.rules(docs).where("not kept").collect()}
    left = [(i, t) for i, t in plain(docs) if i not in rejected]
    roots = brute.linked(left)
    left = [(i, t) for i, t in left if roots[i][1] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    left = {i for i, t in left if not brute.contamination(t, items)[4]}
    clean = docs.where(F.col("doc_id").isin(*left))
    drawn = [(r["doc_id"], r["text"]) for r in mixing.mixed(clean).collect()]
    want = brute.tokens(drawn, Tokenizer.from_file(queries.tokenizer_path()))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == sorted(want)


def test_slices_keep_rows_and_bound_text(spark):
    import pyarrow as pa

    rows = ["x" * (texts.SLICE_BYTES // 2)] * 3 + [None, "", "y" * (2 * texts.SLICE_BYTES)]
    parts = list(texts.slices([pa.RecordBatch.from_pydict({"text": rows})]))
    assert [t for p in parts for t in p.column("text").to_pylist()] == rows
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= texts.SLICE_BYTES for p in parts)
