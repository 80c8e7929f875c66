import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from corpusgate.operators import similarity as s
from tests.helpers import claims, found


def toks(text):
    return frozenset(re.findall(r"[a-zA-Z0-9_]+", text.lower()))


def texts(n, seed, copies=0.3):
    """Random texts with exact and near copies; about a third of the rows fall in one copy group."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        if out and rnd.random() < copies:
            base = out[0][2].split() if rnd.random() < 0.7 else rnd.choice(out)[2].split()
            if base and rnd.random() < 0.5:
                base[rnd.randrange(len(base))] = rnd.choice(words)
            text = " ".join(base)
        else:
            text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 14)))
        out.append((i, rnd.choice("ab"), text))
    return out


def brute_pairs(data, t):
    out = set()
    for (i, g, a), (j, h, b) in combinations(data, 2):
        x, y = toks(a), toks(b)
        if g == h and x and y and len(x & y) / len(x | y) >= t:
            out.add((i, j))
    return out


@pytest.mark.parametrize("threshold,cell", [(0.75, 2000), (0.5, 3), (0.9, 2), (1.0, 5), (0.3, 7)])
def test_near_duplicates_equal_brute_force(spark, threshold, cell):
    data = texts(160, seed=int(threshold * 100), copies=0.5)
    df = spark.createDataFrame(data, "id int, g string, text string")
    classes, members = s.token_classes(df, "id", ["g"], "text")
    by_class = defaultdict(list)
    for r in members.collect():
        by_class[r["class_id"]].append(r["row_id"])
    got, n_pairs = set(), 0
    for r in s.near_duplicate_classes(classes, ["g"], threshold, cell=cell).collect():
        n_pairs += r["n_pairs"]
        left, right = by_class[r["a"]], by_class[r["b"]]
        pairs = combinations(left, 2) if r["a"] == r["b"] else ((x, y) for x in left for y in right)
        got |= {tuple(sorted(p)) for p in pairs}
    want = brute_pairs(data, threshold)
    assert got == want and n_pairs == len(want)


def test_a_large_copy_group_stays_small(spark):
    df = spark.range(3000).select(F.col("id"), F.lit("g").alias("g"), F.when(F.col("id") < 1000, "the same text here").otherwise(F.concat(F.lit("own words "), F.col("id"), F.lit(" x"), F.col("id"))).alias("text"))
    out = s.near_duplicates(df, "id", ["g"], "text").collect()
    assert len(out) == 1 and out[0]["n_pairs"] == 1000 * 999 // 2


def test_null_blocks_match_each_other(spark):
    df = spark.createDataFrame([(1, None, "a b c"), (2, None, "a b c d"), (3, "x", "a b c")], "id int, g string, text string")
    got = s.near_duplicates(df, "id", ["g"], "text", 0.7).collect()
    assert [(r["a"], r["b"]) for r in got] == [(1, 2)]


def test_value_policy_needs_both_kinds_without_reuse(spark):
    text = "rate equals k times p over one plus k p"
    rows = claims(
        spark,
        {"id": "c1", "informal_text": text, "value_kind": "experimental_invariant", "claim_type": "identity"},
        {"id": "c2", "informal_text": text + " again", "value_kind": "experimental_invariant", "claim_type": "identity"},
        {"id": "c3", "informal_text": text, "value_kind": "bridge_lemma", "claim_type": "identity"},
        {"id": "c4", "informal_text": text, "value_kind": None, "claim_type": "identity"},
        {"id": "c5", "informal_text": text, "value_kind": "experimental_invariant", "claim_type": "lemma"},
        {"id": "c6", "informal_text": text, "value_kind": "experimental_invariant", "claim_type": "identity"},
    )
    out = s.unreused_near_duplicates(s.claim_signature(rows))
    assert found(out, "id", "partners", "first_partner") == [("c1", 2, "c2"), ("c2", 2, "c1"), ("c6", 2, "c1")]


def test_unreused_equals_brute_force(spark):
    data = texts(150, seed=11, copies=0.6)
    df = spark.createDataFrame(data, "id int, g string, text string").withColumn("k", F.lit("experimental_invariant"))
    got = {r["id"]: (r["partners"], r["first_partner"]) for r in s.unreused_near_duplicates(df, "id", ["g"], "text", "k", 0.6).collect()}
    partners = defaultdict(list)
    for i, j in brute_pairs(data, 0.6):
        partners[i].append(j)
        partners[j].append(i)
    assert got == {i: (len(p), min(p)) for i, p in partners.items()}


@pytest.mark.parametrize("sizes", [{}, {"cell_tokens": 60}])
def test_suggestions_equal_brute_force(spark, sizes):
    items, cands = texts(60, 21), texts(50, 22)
    di = spark.createDataFrame([(i, g, t) for i, g, t in items], "item int, g string, text string")
    dc = spark.createDataFrame([(i, g, t) for i, g, t in cands], "cand int, g string, text string")
    for group in (["g"], []):
        got = s.suggest_by_overlap(di, "item", "text", dc, "cand", "text", "cand", group, k=3, **sizes)
        have = defaultdict(list)
        for r in got.orderBy("item", "rank").collect():
            have[r["item"]].append((r["cand"], round(r["score"], 9)))
        want = {}
        for i, g, t in items:
            scored = [
                (-len(toks(t) & toks(u)) / len(toks(t) | toks(u)), j)
                for j, h, u in cands
                if (not group or g == h) and toks(t) & toks(u)
            ]
            if scored:
                want[i] = [(j, round(-x, 9)) for x, j in sorted(scored)[:3]]
        assert dict(have) == want


def test_one_table_can_stand_on_both_sides(spark):
    df = spark.createDataFrame([(i, "g", t) for i, _, t in texts(30, 5)], "id int, g string, text string")
    other = df.select(F.col("id").alias("cand"), "text", "g")
    for sizes in ({}, {"cell_tokens": 40}):
        best = s.suggest_by_overlap(df, "id", "text", other, "cand", "text", "cand", ["g"], k=1, **sizes)
        assert {r["score"] for r in best.collect()} == {1.0}


def test_contains_join_equals_brute_force(spark):
    rnd = random.Random(9)
    hay = ["".join(rnd.choice("abAé 1-") for _ in range(rnd.randint(0, 30))) for _ in range(80)]
    needles = ["".join(rnd.choice("abAé 1-") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    needles += [h[3:15] for h in hay if len(h) > 16][:20]
    dh = spark.createDataFrame(list(enumerate(hay)), "i int, text string")
    dn = spark.createDataFrame(list(enumerate(needles)), "j int, needle string")
    for fold in (False, True):
        low = (lambda x: x.lower()) if fold else (lambda x: x)
        want = sorted((i, j) for i, h in enumerate(hay) for j, n in enumerate(needles) if low(n) in low(h))
        assert found(s.contains_join(dh, "text", dn, "needle", ignore_case=fold), "i", "j") == want


def test_no_anchor_carries_a_text(spark):
    """Texts are shuffled by their hash only; what is dealt by anchor holds hashes."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hay = spark.createDataFrame([(1, "some a long text of words")], "i int, text string")
        needles = spark.createDataFrame([(1, "a long text"), (2, "xt")], "j int, needle string")
        joined = s.contains_join(hay, "text", needles, "needle")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert found(joined, "i", "j") == [(1, 1), (1, 2)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    kept = re.findall(r"Generate .*\), \[([^\]]*)\], \w+, \[__anchor", plan)
    assert kept and not [k for k in kept if "text" in k or "__hay" in k]


def test_a_token_of_all_rows_is_cut_on_both_sides(spark):
    n, cell = 400, 50
    postings = spark.range(n).selectExpr("id AS class_id", "0L AS blk", "5 AS size", "0 AS at", "7L AS tok")
    left, right = s._triangle(postings, cell)
    keys = ["blk", "tok", "low", "high"]
    held = [max(r["count"] for r in side.groupBy(*keys).count().collect()) for side in (left, right)]
    assert max(held) < 2 * cell
    pairs = left.join(right, keys).where("low < high OR a < b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b")
    assert pairs.count() == pairs.distinct().count() == n * (n - 1) // 2


def test_candidates_do_not_grow_with_the_vocabulary(spark):
    """Sets of rare words of their own and common ones, without near duplicates, meet on no prefix token."""
    own = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.concat(F.lit("r"), F.col("id") * 8 + i))
    common = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.concat(F.lit("c"), i))
    classes = spark.range(2000).select(F.col("id").alias("class_id"), F.concat(common, own).alias("tokens"), F.lit(1).alias("n"))
    ordered = s.rare_first(classes).select("class_id", F.slice("ordered", 1, 4).alias("prefix"))
    held = ordered.select(F.explode("prefix").alias("tok")).groupBy("tok").count()
    assert held.where("count > 1").count() == 0
    assert s.near_duplicate_classes(classes, []).count() == 0


def test_blank_queries_find_nothing(spark):
    rows = spark.createDataFrame([(1, "Gas Law", 1918), (2, "Other", 2000)], "id int, title string, year int")
    q = spark.createDataFrame([(" gas ",), (" ",), ("191",), ("law\u0001",)], "q string")
    assert found(s.search_rows(rows, ["title", "year"], q, "q"), "id", "q") == [(1, " gas "), (1, "191")]


def test_mentions_are_whole_identifiers(spark):
    docs = spark.createDataFrame([("d", "me", "use foo, foo' and xfoo; me bar_1.")], "d string, own string, body string")
    names = spark.createDataFrame([("foo",), ("foo'",), ("bar",), ("bar_1",), ("me",)], "name string")
    got = s.mention_join(docs, "d", "body", names, "name", "own")
    assert found(got, "name") == [("bar_1",), ("foo",), ("foo'",)]


def test_shortest_prefix_wins_and_skips_itself(spark):
    names = spark.createDataFrame([("theta_eq", 0), ("theta", 1), ("thetb", 2), ("the", 3)], "n string, pos int")
    toks_ = spark.createDataFrame([("thet", "x"), ("thet", "theta"), ("theta", "theta"), ("theta_", "y"), ("z", "y")], "t string, own string")
    got = s.prefix_join(toks_, "t", names, "n", "pos", self_name="own")
    here, there = names.withColumn("g", F.lit("a")), toks_.withColumn("g", F.lit("b"))
    assert s.prefix_join(there, "t", here, "n", "pos", "own", ["g"]).count() == 0
    assert s.prefix_join(there.withColumn("g", F.lit("a")), "t", here, "n", "pos", "own", ["g"]).count() == 3
    assert found(got, "t", "own", "match") == [("thet", "theta", "thetb"), ("thet", "x", "theta"), ("theta_", "y", "theta_eq")]


def test_path_owner_then_declared_namespace(spark):
    files = spark.createDataFrame(
        [("A/B.lean", ""), ("A/B/C.lean", ""), ("A/Bx.lean", "namespace Z\nnamespace Q.R"), ("T.lean", "")], "path string, text string"
    )
    pre = spark.createDataFrame([("A.B", "p1", 0), ("Q.R", "p2", 1), ("A.B.C", "p3", 2)], "ns string, owner string, pos int")
    got = s.path_prefix_join(files, "path", pre, "ns", "owner", "pos", extension="lean", text="text")
    assert sorted((r["path"], r["owner"]) for r in got.collect()) == [("A/B.lean", "p1"), ("A/B/C.lean", "p1"), ("A/Bx.lean", "p2"), ("T.lean", None)]


def test_pieces_of_texts_are_not_shuffled_to_few_needles(spark):
    hay = spark.createDataFrame([(1, "a gas line"), (2, "linen"), (3, "none")], "i int, text string")
    needles = spark.createDataFrame([(1, "line"), (2, "gas"), (3, "a gas l")], "j int, needle string")
    out = s.contains_join(hay, "text", needles, "needle")
    assert found(out, "i", "j") == [(1, 1), (1, 2), (1, 3), (2, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__width" not in plan and "hashpartitioning(__anchor" not in plan


def test_order_of_tokens_shuffles_no_posting(spark):
    """The counts come as a table of fixed size; sets are put in order where they stand."""
    classes = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["b", "c"]), (3, ["c", "d"])], "class_id int, tokens array<string>")
    out = s.rare_first(classes)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    code = {r["t"]: r["h"] for r in spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    got = {r["class_id"]: r["ordered"] for r in out.collect()}
    assert got == {1: [code["a"], code["b"], code["c"]], 2: [code["b"], code["c"]], 3: [code["d"], code["c"]]}


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_families_in_cells_equal_brute_force(spark, monkeypatch, few):
    """A family of near copies meets in groups and cells; bits and ids are joined where they are too many to broadcast."""
    monkeypatch.setattr(s, "BROADCAST_IDS", few)
    monkeypatch.setattr(s, "FAMILY_CELL", 3)
    monkeypatch.setattr(s, "GROUP_SETS", 4)
    rnd = random.Random(4)
    stem = [f"w{i}" for i in range(24)]
    data = [(i, "g", " ".join(rnd.sample(stem, 22) + [f"own{i}"])) for i in range(40)] + [(100 + i, g, t) for i, g, t in texts(60, 8)]
    df = spark.createDataFrame(data, "id int, g string, text string")
    classes, members = s.token_classes(df, "id", ["g"], "text")
    rows = defaultdict(list)
    for r in members.collect():
        rows[r["class_id"]].append(r["row_id"])
    got = set()
    for r in s.near_duplicate_classes(classes, ["g"], 0.7, cell=5).collect():
        got |= {tuple(sorted((i, j))) for i in rows[r["a"]] for j in rows[r["b"]] if i != j}
    assert got == {tuple(sorted(p)) for p in brute_pairs(data, 0.7)} and len(got) > 300
