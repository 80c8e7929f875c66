import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from corpusgate.operators import comparing, linking
from tests.helpers import cards, claims, found, mapping


def test_null_and_blank_keys_are_no_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "")], "i int, k string")
    parent = spark.createDataFrame([("a",)], "id string")
    assert found(linking.orphans(child, parent, {"k": "id"}), "i") == [(2,)]


def test_empty_parent_set_silences_optional_checks(spark):
    child = spark.createDataFrame([(1, "p", "a"), (2, "q", "a")], "i int, g string, k string")
    none = spark.createDataFrame([], "id string")
    assert found(linking.orphans(child, none, {"k": "id"}), "i") == [(1,), (2,)]
    assert found(linking.orphans(child, none, {"k": "id"}, skip_if_parent_empty=True), "i") == []
    parent = spark.createDataFrame([("p", "z")], "g string, id string")
    got = linking.orphans(child, parent, {"g": "g", "k": "id"}, skip_if_parent_empty=True, parent_group=["g"])
    assert found(got, "i") == [(1,)]


def test_ghost_links_are_kept_then_cleared(spark):
    rows = claims(spark, {"id": "c1", "linked_assumptions": ["a2", "ghost", "a1", "a2"], "linked_assumptions_unresolved": ["old"]}, {"id": "c2"})
    known = spark.createDataFrame([("p1", "a1"), ("p1", "a2"), ("p2", "ghost")], "paper_id string, id string")
    args = (["id"], ["paper_id"], "linked_assumptions")
    got = {r["id"]: r for r in linking.resolve_links(rows, *args, known, "id", "linked_assumptions_unresolved").collect()}
    assert got["c1"]["linked_assumptions"] == ["a2", "a1"]
    assert got["c1"]["linked_assumptions_unresolved"] == ["ghost", "old"]
    assert got["c2"]["linked_assumptions"] == [] and got["c2"]["linked_assumptions_unresolved"] is None
    more = known.unionByName(spark.createDataFrame([("p1", "ghost"), ("p1", "old")], known.schema))
    again = linking.resolve_links(rows, *args, more, "id", "linked_assumptions_unresolved").where("id = 'c1'").first()
    assert again["linked_assumptions"] == ["a2", "ghost", "a1", "old"] and again["linked_assumptions_unresolved"] is None


def test_cards_follow_mapping_and_claims(spark):
    m = mapping(spark, {"paper_id": "p-1", "claim_to_decl": {"c1": "one", "c2": "two"}}, {"paper_id": "p-2", "claim_to_decl": {"zz": "only"}, "target_file": "x.lean"})
    cl = claims(spark, {"paper_id": "p-1", "id": "c1", "status": "machine_checked"}, {"paper_id": "p-1", "id": "c2", "status": None})
    got = found(linking.derive_cards(m, cl), "id", "lean_decl", "file_path", "proof_status", "verification_boundary", "reviewer_status")
    assert got == [
        ("p-1_card_001", "N.S.one", "formal/N/S.lean", "machine_checked", "fully_machine_checked", "accepted"),
        ("p-1_card_002", "N.S.two", "formal/N/S.lean", "mapped", "human_review_only", "unreviewed"),
        ("p_2_card_001", "N.S.only", "x.lean", "mapped", "human_review_only", "unreviewed"),
    ]


def test_review_state_survives_republishing(spark):
    new = cards(spark, {"id": "k1", "claim_id": "c1", "lean_decl": "d"}, {"id": "k2", "claim_id": "c2", "lean_decl": "d"}, {"id": "k3", "claim_id": None, "lean_decl": "d"})
    old = cards(
        spark,
        {"id": "o1", "claim_id": "c1", "lean_decl": "d", "reviewer_status": "blocked", "notes": "first"},
        {"id": "o2", "claim_id": "c1", "lean_decl": "d", "reviewer_status": "accepted", "notes": ""},
        {"id": "o3", "claim_id": "c2", "lean_decl": "other", "reviewer_status": "accepted"},
        {"id": "o4", "claim_id": "", "lean_decl": "d", "reviewer_status": "reviewed", "notes": "n"},
    )
    out = linking.carry_over(new, old, ["claim_id", "lean_decl"], ["reviewer_status"], ["notes"], old_order=["pos"])
    assert sorted((r["id"], r["reviewer_status"], r["notes"]) for r in out.collect()) == [
        ("k1", "accepted", None), ("k2", "unreviewed", None), ("k3", "reviewed", "n")
    ]


def test_kernel_links_are_united_and_sorted(spark):
    rows = cards(spark, {"id": "k1", "executable_links": ["z", ""]}, {"id": "k2"})
    kernels = spark.createDataFrame([("a", ["k1", "k9"]), ("", ["k2"])], "id string, linked array<string>")
    out = linking.enrich_links(rows, "id", "executable_links", kernels, "id", "linked")
    assert found(out, "id", "executable_links") == [("k1", ["a", "z"]), ("k2", [])]


def test_upsert_keeps_order_and_is_idempotent(spark):
    ddl = "id string, pos int, v int"
    base = spark.createDataFrame([("a", 0, 1), ("b", 1, 2), ("a", 2, 3)], ddl)
    prop = spark.createDataFrame([("b", 0, 20), ("c", 1, 30), ("c", 2, 31)], ddl)
    merged = linking.upsert(base, prop, ["id"], "pos")
    assert [(r["id"], r["v"]) for r in merged.orderBy("appended", "pos").collect()] == [("a", 3), ("b", 20), ("c", 31)]
    again = linking.upsert(merged.select("id", "pos", "v"), prop, ["id"], "pos")
    assert found(again, "id", "v") == found(merged, "id", "v")
    preview = linking.upsert_preview(base.where("pos < 2"), merged, ["id"], ["v"])
    assert sorted(r["id"] for r in preview.collect()) == ["a", "b", "c"]


def test_proposals_for_another_paper_are_rejected(spark):
    ddl = "id string, pos int, paper string, want string"
    prop = spark.createDataFrame([("a", 0, "p", "p"), ("b", 1, "q", "p")], ddl)
    none = spark.createDataFrame([], ddl)
    assert found(linking.upsert(none, prop, ["id"], "pos", expect=("paper", "want")), "id") == [("a",)]
    assert found(linking.rejected_proposals(prop, "paper", "want"), "id") == [("b",)]


def test_plan_differences(spark):
    plan = spark.createDataFrame([("p", "a", "x"), ("p", "b", "y"), ("p", "c", "z"), ("q", "a", "x")], "g string, k string, v string")
    m = spark.createDataFrame([("p", "a", "x"), ("p", "b", "other")], "g string, k string, v string")
    got = linking.plan_differences(plan, m, ["g", "k"], "v", group="g")
    assert sorted((r["g"], r["k"] or "", r["kind"]) for r in got.collect()) == [("p", "b", "mismatch"), ("p", "c", "missing"), ("q", "", "no_mapping")]


def test_mapping_is_filled_and_kept(spark):
    cl = claims(spark, {"id": "x_claim_1", "linked_formal_targets": ["N.S.t"]}, {"id": "x_claim_2"})
    old = spark.createDataFrame([("p1", "x_claim_2", " "), ("p1", "gone", "kept")], "paper_id string, claim_id string, short_decl string")
    ns = spark.createDataFrame([("p1", "N.S")], "paper_id string, namespace string")
    assert found(linking.fill_mapping(cl, old, ns), "claim_id", "short_decl") == [("gone", "kept"), ("x_claim_1", "t"), ("x_claim_2", "claim_c_2")]


def test_card_lookup_prefers_the_stronger_key(spark):
    rows = cards(spark, {"id": "k1", "claim_id": "c1", "lean_decl": "N.a"}, {"id": "k2", "claim_id": "k1", "lean_decl": "N.b"}, {"id": "k3", "claim_id": "c3", "lean_decl": "N.a"})
    keys = spark.createDataFrame([("k1",), ("N.a",), ("c3",), ("b",), ("?",)], "lookup string")
    assert found(linking.card_lookup(keys, rows), "lookup", "card_id") == [("N.a", "k1"), ("b", "k2"), ("c3", "k3"), ("k1", "k1")]


def test_span_alignment_counts_nulls_as_equal(spark):
    span = "struct<source_file:string,start:int,end:int>"
    a = spark.createDataFrame([("c1", ("f", 1, 2)), ("c2", ("f", 1, 3)), ("c3", None), ("c4", None)], f"id string, source_span {span}")
    b = spark.createDataFrame([("c1", ("f", 1, 2)), ("c2", ("f", 1, 4)), ("c3", None)], f"id string, source_span {span}")
    row = linking.align_spans(a, b, ["id"]).first()
    assert (row["total_compared"], row["alignment_error_count"]) == (3, 1)
    assert linking.align_spans(a, b.limit(0), ["id"]).first()["alignment_error_rate"] is None


state = st.dictionaries(st.sampled_from("abcdef"), st.sampled_from(["mapped", "machine_checked", "disputed", ""]), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(state, state)
def test_diff_properties(spark, a, b):
    ddl = "k string, s string"
    fa, fb = spark.createDataFrame(list(a.items()), ddl), spark.createDataFrame(list(b.items()), ddl)
    assert comparing.status_changes(fa, fa.select("*"), ["k"], "s").count() == 0
    forward = {r["k"]: (r["from"], r["to"]) for r in comparing.status_changes(fa, fb, ["k"], "s").collect()}
    want = {}
    for k in a.keys() | b.keys():
        if k not in a:
            want[k] = ("", b[k] or "(new)")
        elif k not in b:
            want[k] = (a[k], "(removed)")
        elif a[k] != b[k]:
            want[k] = (a[k], b[k])
    assert forward == want
    up = {(r["k"], r["kind"]) for r in comparing.rank_changes(fa, fb, ["k"], "s").collect()}
    down = {(r["k"], {"new": "broken", "broken": "new"}[r["kind"]]) for r in comparing.rank_changes(fb, fa, ["k"], "s").collect()}
    assert up == down


def test_text_drift_ignores_new_and_removed(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "3")], "id string, d string")
    b = spark.createDataFrame([("x", "1"), ("y", "9"), ("w", "3")], "id string, d string")
    assert found(comparing.text_drift(a, b, ["id"], "d"), "id") == [("y",)]


def test_group_changes_drop_unchanged_groups(spark):
    ddl = "g string, i string, s string, d string"
    a = spark.createDataFrame([("same", "1", "m", "x"), ("gone", "1", "m", "x"), ("moved", "1", "m", "x"), ("drift", "1", "m", "x")], ddl)
    b = spark.createDataFrame([("same", "1", "m", "x"), ("fresh", "1", "m", "x"), ("moved", "1", "n", "x"), ("drift", "1", "m", "y")], ddl)
    got = {r["g"]: r["change"] for r in comparing.group_changes(a, b, "g", "i", "s", "d").collect()}
    assert got == {"gone": "removed", "fresh": "added", "moved": "changed", "drift": "changed"}


def test_reference_orphans_of_many_kinds(spark):
    refs = spark.createDataFrame([("a", "", "1"), ("a", "", "2"), ("b", "p", "1"), ("b", "q", "1"), ("a", "", "")], "kind string, scope string, ref string")
    targets = spark.createDataFrame([("a", "", "1"), ("b", "p", "9")], "kind string, scope string, ref string")
    assert found(linking.reference_orphans(refs, targets), "kind", "scope", "ref") == [("a", "", "2"), ("b", "p", "1"), ("b", "q", "1")]
    assert found(linking.reference_orphans(refs, targets, ["b"]), "kind", "scope", "ref") == [("a", "", "2"), ("b", "p", "1")]


def test_hot_key_orphans(spark):
    rnd = random.Random(2)
    child = spark.createDataFrame([(i, "hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 99)}") for i in range(4000)], "i int, k string")
    parent = spark.createDataFrame([(f"k{j}",) for j in range(50)], "id string")
    want = child.where((F.col("k") == "hot") | (F.substring("k", 2, 9).try_cast("int") >= 50)).count()
    assert linking.orphans(child, parent, {"k": "id"}).count() == want


def test_dangling_references_of_many_kinds(spark):
    rows = [("a", "", "1", None, "p", "1"), ("a", "", "1", "uses a", "p", "x"), ("a", "", "2", "uses a", "p", "y"), ("a", "", " ", "uses a", "p", "y")]
    rows += [("b", "p", "1", None, "p", "1"), ("b", "p", "1", "uses b", "p", "x"), ("b", "q", "1", "uses b", "q", "x"), ("b", "p", "5", "uses b", "p", "z")]
    rows += [("n", "p", "p", None, "p", "p"), ("n", "p", "p", "not here", "p", "w"), ("n", "q", "q", "not here", "q", "v")]
    rows += [("a", "", "hot", "uses a", "p", f"r{i}") for i in range(500)] + [("a", "", "fine", None, "p", "fine")] + [("a", "", "fine", "uses a", "p", f"r{i}") for i in range(500)]
    facts = spark.createDataFrame(rows, "target string, scope string, ref string, kind string, group_id string, row_id string")
    lost = found(linking.dangling(facts, ["b"], ["n"]).where("ref <> 'hot'"), "kind", "scope", "ref", "row_id")
    assert lost == [("not here", "p", "p", "w"), ("uses a", "", "2", "y"), ("uses b", "p", "5", "z")]
    assert linking.dangling(facts).where("ref = 'hot'").count() == 500
    assert ("uses b", "q", "1", "x") in found(linking.dangling(facts), "kind", "scope", "ref", "row_id")
    assert linking.dangling(facts.limit(0), ["b"], ["n"]).count() == 0


@pytest.mark.parametrize("most", [0, 2, 100])
def test_references_of_much_used_keys_are_not_shuffled(spark, monkeypatch, most):
    """However many of the keys are broadcast, the same references are found; with all of them none is shuffled."""
    monkeypatch.setattr(linking, "BROADCAST_KEYS", most)
    rows = [("a", "", f"k{i}", "uses a", "p", f"{i}_{j}") for i in range(8) for j in range(2**i)] + [("a", "", "k5", None, "p", "k5"), ("a", None, "k6", "uses a", "p", "x")]
    facts = spark.createDataFrame(rows, "target string, scope string, ref string, kind string, group_id string, row_id string")
    lost = linking.dangling(facts)
    if most == 100:
        assert "Exchange hashpartitioning" not in lost._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["row_id"] for r in lost.collect()) == sorted(f"{i}_{j}" for i in range(8) if i != 5 for j in range(2**i))


@pytest.mark.parametrize("most", [0, 3, 100])
def test_lost_links_are_the_dangling_references(spark, monkeypatch, most):
    """Rows with their references give what their exploded references give, however many keys are broadcast."""
    monkeypatch.setattr(linking, "BROADCAST_KEYS", most)
    rng = random.Random(5)
    sorts, kinds = ["own", "maybe", "named", "wide", "core"], [("to own", "own"), ("to maybe", "maybe"), ("not named", "named"), ("to wide", "wide"), ("to core", "core")]
    everywhere, optional, unwanted = ["wide", "core"], ["maybe", "core"], ["named"]
    ids = [None, "", " ", *"abcdefghij"]
    rows, facts = [], []
    for i in range(600):
        group, sort = rng.choice(["p", "q", "r", "s", "", None]), rng.choice([*range(4), None])
        group = rng.choice("pq") if sort in (1, 2) else group
        row, places = rng.choice(ids[:3] if sort == 3 and i % 3 else ids), [rng.randrange(5) for _ in range(rng.randrange(4))]
        links = [rng.choice([*ids, "wide-only", "hot"]) for _ in places]
        rows.append((group, row, i, sort, places, links))
        scope = lambda x, g=group or "": "" if x in everywhere else g
        facts += [(sorts[sort], scope(sorts[sort]), row, None, group or "", row, i)] if sort is not None else []
        facts += [(kinds[k][1], scope(kinds[k][1]), ref, kinds[k][0], group or "", row, i) for k, ref in zip(places, links, strict=True)]
    rows += [("p", "core1", 601, core, [], []) for core in ([4] if most == 3 else [])]
    facts += [("core", "", "core1", None, "p", "core1", 601)] if most == 3 else []
    plain = spark.createDataFrame(facts, "target string, scope string, ref string, kind string, group_id string, row_id string, pos long")
    packed = spark.createDataFrame(rows, "group_id string, row_id string, pos long, sort tinyint, link_kinds array<tinyint>, links array<string>")
    names = ["group_id", "row_id", "pos", "kind", "ref"]
    lost = linking.lost_links(packed, sorts, kinds, everywhere, optional, unwanted)
    want = linking.dangling(plain, optional, unwanted).select(*names)
    assert lost.columns == names and want.count() > 100
    assert lost.exceptAll(want).count() == want.exceptAll(lost).count() == 0
