import random
import statistics

import pytest

from pyspark.sql import functions as F

from corpusgate.functions import aggregates as agg
from corpusgate.operators import ordering as o
from tests.helpers import found


def series(spark, n=500, groups=3, seed=1):
    rnd = random.Random(seed)
    data = [(f"g{rnd.choice([0, 0, 0, *range(groups)])}", i, rnd.randint(0, 50)) for i in range(n)]
    return spark.createDataFrame(data, "g string, pos long, v long"), data


def test_chunked_forms_equal_plain_windows(spark):
    df, _ = series(spark)
    chunk = F.floor(F.col("pos") / 37)
    plain = o.row_numbers(df, ["g"], [F.col("pos")], "n")
    assert found(plain, "g", "pos", "n") == found(o.row_numbers(df, ["g"], [F.col("pos")], "n", chunk), "g", "pos", "n")
    plain = o.running_total(df, ["g"], [F.col("pos")], "v", "s")
    assert found(plain, "g", "pos", "s") == found(o.running_total(df, ["g"], [F.col("pos")], "v", "s", chunk), "g", "pos", "s")
    key = lambda d: sorted((r["g"], r["pos"], -1 if r["p"] is None else r["p"]) for r in d.collect())
    plain = o.previous_value(df, ["g"], ["pos"], "v", "p")
    assert key(plain) == key(o.previous_value(df, ["g"], ["pos"], "v", "p", chunk))


def test_duplicate_flags_differ_for_the_first_holder(spark):
    df = spark.createDataFrame([("p", "a", 0), ("p", "b", 1), ("p", "a", 2), ("q", "a", 3), ("p", None, 4), ("p", None, 5)], "p string, n string, pos int")
    later = o.later_duplicates(df, ["p", "n"], "pos", "f")
    every = o.all_duplicates(df, ["p", "n"], "f")
    assert [r["pos"] for r in later.where("f").orderBy("pos").collect()] == [2]
    assert [r["pos"] for r in every.where("f").orderBy("pos").collect()] == [0, 2]


def test_sequential_keys(spark):
    df = spark.createDataFrame([("a-b", 1), ("c-d", 1), ("c-d", 2)], "p string, pos int")
    got = found(o.sequential_keys(df, "p", [F.col("pos")]), "p", "pos", "key")
    assert got == [("a-b", 1, "a_b_card_001"), ("c-d", 1, "c-d_card_001"), ("c-d", 2, "c-d_card_002")]


def test_vocabulary_keeps_first_form_and_cap(spark):
    df = spark.createDataFrame(
        [("p", 0, "The Gas x gas PRESSURE"), ("p", 1, "pressure Kelvin with héllo unit_1"), ("q", 0, "a b c")],
        "paper string, pos int, text string",
    )
    got = found(o.first_seen_vocabulary(df, "paper", "pos", "text", cap=4), "paper", "rank", "token", "raw_token")
    assert got == [("p", 1, "gas", "Gas"), ("p", 2, "pressure", "PRESSURE"), ("p", 3, "kelvin", "Kelvin"), ("p", 4, "unit_1", "unit_1")]


def test_vocabulary_equals_a_plain_scan(spark):
    rnd = random.Random(3)
    data = [(rnd.choice("pq"), i, " ".join(rnd.choice(["the", "Ab", "ab", "cd", "Ef", "gh1", "i", "jkl"]) + rnd.choice(["", "x", "y"]) for _ in range(30))) for i in range(40)]
    want = {}
    for g, _, text in data:
        seen = want.setdefault(g, [])
        for tok in text.split():
            low = tok.lower()
            if len(low) >= 2 and low not in ("the",) and low not in [s for s, _ in seen] and len(seen) < 10:
                seen.append((low, tok))
    df = spark.createDataFrame(data, "g string, pos int, text string")
    got = found(o.first_seen_vocabulary(df, "g", "pos", "text", cap=10), "g", "rank", "token", "raw_token")
    assert got == sorted((g, i + 1, a, b) for g, s in want.items() for i, (a, b) in enumerate(s))


def test_budget_clips_the_crossing_part(spark):
    df = spark.createDataFrame([("p", 0, "abcd"), ("p", 1, "efgh"), ("p", 2, "ij"), ("q", 0, "z")], "p string, pos int, t string")
    assert found(o.budgeted_text(df, "p", "pos", "t", 6), "p", "t") == [("p", "abcdef"), ("q", "z")]


def test_monotone_breaks_and_drops(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 3.0), ("a", 2, 2.0), ("b", 0, 5.0)], "g string, pos int, v double")
    assert found(o.monotone_breaks(df, ["g"], ["pos"], "v"), "g", "pos", "previous") == [("a", 2, 3.0)]
    assert found(o.value_drops(df, ["g"], "pos", "v"), "g", "pos") == [("a", 2)]


def test_exact_median_against_statistics(spark):
    rnd = random.Random(5)
    for n in (1, 2, 3, 10, 999, 5000):
        values = [float(rnd.randint(0, 30)) if n < 500 else rnd.random() for _ in range(n)]
        df = spark.createDataFrame([("a", v) for v in values], "g string, v double")
        row = agg.exact_median(df, ["g"], "v").first()
        assert row["median"] == statistics.median(values) and row["count"] == n
        assert agg.exact_median(df, [], "v").first()["median"] == statistics.median(values)


def test_median_with_one_dominating_value(spark):
    values = [7.0] * 700 + [float(i) for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert agg.exact_median(df, [], "v").first()["median"] == statistics.median(values)


@pytest.mark.parametrize("rows", [1, 3, 40])
def test_median_of_a_bracket_in_ranges(spark, monkeypatch, rows):
    monkeypatch.setattr(agg, "CHUNK_ROWS", rows)
    rnd = random.Random(rows)
    values = [rnd.choice([rnd.random(), 0.5]) for _ in range(3001)]
    df = spark.createDataFrame([(g, v) for v in values for g in "ab"], "g string, v double")
    want = statistics.median(values)
    assert {r["median"] for r in agg.exact_median(df, ["g"], "v", accuracy=50).collect()} == {want}
    assert agg.exact_median(df, [], "v", accuracy=50).first()["median"] == want


def test_fingerprint_ignores_order_and_sees_changes(spark):
    data = [("p", i, f"t{i}") for i in range(50)]
    def h(rows):
        df = spark.createDataFrame(rows, "p string, i int, t string")
        return df.select("p", agg.row_digest("i", "t").alias("d")).groupBy("p").agg(agg.multiset_fingerprint(F.col("d")).alias("h")).first()["h"]

    assert h(data) == h(list(reversed(data)))
    assert h(data) != h(data[:-1])
    assert h(data) != h([*data[:-1], ("p", 49, "other")])
    assert h(data) != h([*data, data[0]])
    assert h([("p", 1, None)]) != h([("p", 1, "")])
