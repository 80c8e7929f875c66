import pytest
from pyspark.sql import functions as F

from corpusgate.operators import metrics as m
from tests.helpers import cards, claims, found, kernels, symbols


def test_degree_metrics_by_hand(spark):
    edges = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", "y"), ("a", "y")], "src string, dst string")
    row = m.degree_metrics(edges).first()
    assert row["dependency_reuse_ratio"] == 1.0 and row["total_edges"] == 4
    assert (row["average_fan_in"], row["average_fan_out"]) == (1.0, 1.0)
    assert (row["max_fan_in"], row["max_fan_out"], row["shared_targets_count"], row["declarations_with_in_degree"]) == (2, 3, 2, 2)
    assert list(m.degree_metrics(edges.limit(0)).first()) == [0.0, 0, 0, 0.0, 0.0, 0, 0, 0]


def test_stated_graph_hides_cards_even_if_invalid(spark):
    stated = spark.createDataFrame([("p", "", "x"), ("q", "a", "b")], "paper_id string, src string, dst string")
    derived = spark.createDataFrame([("p", "c", "d"), ("r", "e", "f")], "paper_id string, src string, dst string")
    assert found(m.graph_or_cards(stated, stated, derived), "paper_id", "src") == [("q", "a"), ("r", "e")]


def test_edges_have_confidence_by_method(spark):
    rows = cards(spark, {"id": "k", "dependency_ids": [" a ", "", "b"], "dependency_extraction_method": "x_tier1"}, {"id": "l", "dependency_ids": ["c"]})
    assert found(m.edges_from_cards(rows), "src", "dst", "confidence") == [("a", "k", "high"), ("b", "k", "high"), ("c", "l", "medium")]


def test_conflict_rate_counts_a_symbol_twice(spark):
    rows = symbols(
        spark,
        {"id": "a", "normalized_name": "t", "ambiguity_flags": ["role_unclear"]},
        {"id": "b", "normalized_name": "t", "ambiguity_flags": ["role_unclear"]},
        {"id": "c", "normalized_name": None},
    )
    total = m.symbol_conflicts(rows, "paper_id", "normalized_name", F.coalesce(F.size("ambiguity_flags"), F.lit(0)) > 0).where("is_total = 1").first()
    assert (total["with_flags"], total["overloaded"], total["symbol_count"]) == (2, 2, 3)
    assert total["conflict_rate"] == pytest.approx(4 / 3)


def test_shared_names_need_two_groups(spark):
    df = spark.createDataFrame([("a", "p", "1"), ("a", "p", "2"), ("b", "p", "3"), ("b", "q", ""), ("", "p", "x"), ("", "q", "x")], "n string, g string, i string")
    assert found(m.shared_names(df, "n", "g"), "n") == [("b",)]
    df = df.withColumn("pos", F.lit(4))
    assert found(m.cross_group_duplicates(df, "n", "g", "i", "pos"), "g", "location") == [("p", "3"), ("q", "index_4")]


def test_micro_scores(spark):
    pred = spark.createDataFrame([("p", "1"), ("p", "1"), ("p", "2"), ("x", "9")], "g string, id string")
    gold = spark.createDataFrame([("p", "1"), ("q", "5")], "g string, id string")
    row = m.prf_micro(m.match_gold(pred, gold, ["g"], "id")).first()
    assert (row["tp"], row["n_pred"], row["n_gold"]) == (1, 2, 2)
    assert (row["precision"], row["recall"], row["f1"]) == (0.5, 0.5, 0.5)
    assert m.prf_micro(m.match_gold(pred, gold.limit(0), ["g"], "id")).count() == 0


def test_nothing_to_compare_scores_one(spark):
    ddl = "g string, k string, v string"
    row = m.evaluate_entries(spark.createDataFrame([("p", "a", "x")], ddl), spark.createDataFrame([("q", "a", "x")], ddl), ["g", "k"], "v", "g").first()
    assert (row["precision"], row["recall"], row["f1"], row["disagreement"]) == (1.0, 1.0, 1.0, 0.0)


def test_reviewer_status_rules_need_a_valid_state(spark):
    rows = cards(
        spark,
        {"id": "1", "reviewer_status": "blocked"},
        {"id": "2", "reviewer_status": "accepted", "proof_status": "machine_checked"},
        {"id": "3", "reviewer_status": "accepted"},
        {"id": "4", "reviewer_status": "unreviewed", "proof_status": "machine_checked"},
        {"id": "5", "reviewer_status": None},
        {"id": "6", "reviewer_status": "odd"},
    )
    t = m.reviewer_status(rows, "paper_id", "reviewer_status", "notes", "proof_status").where("is_total = 1").first()
    got = [t[x] for x in ("total_cards", "accepted", "missing_status", "invalid_status", "blocked_without_notes", "accepted_not_checked", "checked_but_unreviewed")]
    assert got == [6, 2, 1, 1, 1, 1, 1]


def test_reviewer_report_sections(spark):
    rows = claims(spark, {"id": "1", "status": " "}, {"id": "2", "status": "disputed", "review_notes": "n"}, {"id": "3", "status": "odd", "value_kind": "bridge_lemma"})
    assert found(m.reviewer_report(rows, "status", "review_notes", "value_kind"), "section", "key", "n") == [
        ("disputed", "with_notes", 1), ("invalid_status", "odd", 1), ("status", "disputed", 1), ("status", "odd", 1), ("status", "unparsed", 1), ("value_kind", "bridge_lemma", 1),
    ]


def test_regression_phases(spark):
    actuals = spark.createDataFrame([("t", "a", 1.0), ("t", "b", 5.0)], "task string, metric string, value double")
    limits = m.threshold_table(spark, {"t": {"a": 2.0, "b": 5.0, "gone": 1.0, "_x": 9.0}, "none": {"a": 0.0}}, {"t": {"b": 4.0}, "none": {"b": 0.0}})
    times = spark.createDataFrame([("t", 121.0), ("u", 120.0)], "task string, value double")
    got = m.regression_check(actuals, limits, times, 120.0)
    assert found(got, "phase", "task", "metric") == [(1, "t", "_runtime_seconds"), (2, "none", ""), (2, "t", "a"), (3, "t", "b")]


def test_expected_coverage_falls_back_without_cards(spark):
    cl = claims(spark, {"id": "1", "status": "linked_to_kernel", "linked_formal_targets": ["x"]}, {"id": "2", "paper_id": "p2", "status": "linked_to_kernel"})
    ca = cards(spark, {"id": "k", "claim_id": "ghost", "executable_links": ["a"]}, {"id": "l", "claim_id": "ghost", "executable_links": ["b"]})
    assert found(m.expected_coverage(cl, ca), "paper_id", "claim_count", "mapped_claim_count", "kernel_linked_count") == [("p1", 1, 1, 1), ("p2", 1, 0, 1)]
    assert [r["kernel_linked"] for r in m.linked_claims(cl, ca).collect()] == [False, False]


def test_graph_quality_bounds(spark):
    rows = cards(spark, *[{"id": str(i), "dependency_ids": ["x"] if i < 2 else []} for i in range(6)], *[{"paper_id": "p2", "id": str(i)} for i in range(5)])
    got = m.graph_quality(rows, "paper_id", F.size("dependency_ids"))
    assert sorted((r["paper_id"], r["warning"]) for r in got.collect()) == [("p1", "sparse"), ("p2", None)]
    checked = spark.createDataFrame([("p1",), ("p2",)], "paper_id string")
    assert found(m.graph_bootstrap(rows, checked, "paper_id", F.size("dependency_ids")), "paper_id", "cards") == [("p2", 5)]


def test_declaration_index_order_of_sources(spark):
    fresh = cards(spark, {"id": "1", "lean_decl": "N.a"})
    old = cards(spark, {"id": "2", "lean_decl": "N.old"}, {"paper_id": "p2", "id": "3", "lean_decl": "N.b"})
    manifest = spark.createDataFrame([("p1", ["z"]), ("p3", ["N.c"])], "paper_id string, declaration_index array<string>")
    assert found(m.declaration_index(fresh, old, manifest), "paper_id", "lean_decl") == [("p1", "N.a"), ("p2", "N.b"), ("p3", "N.c")]


def test_file_filter_and_dependencies(spark):
    rows = cards(spark, {"id": "1", "lean_decl": "N.a", "file_path": "formal\\A\\B.lean", "dependency_ids": ["x", "y"]}, {"id": "2", "lean_decl": "N.a", "dependency_ids": ["y", "z"]})
    manifest = spark.createDataFrame([("p1", ["N.m"])], "paper_id string, declaration_index array<string>")
    listed = m.declaration_rows(manifest, rows)
    assert found(m.declarations_in_file(listed, " A/B "), "lean_decl", "source") == [("N.a", "theorem_cards")]
    assert m.declarations_in_file(listed, " ").count() == 3
    deps = m.dependencies_of(rows, rows).orderBy("first_seen")
    assert [r["dependency_id"] for r in deps.collect()] == ["x", "y", "z"]


def test_presence_counts_include_zero(spark):
    files = spark.createDataFrame([("a/p/llm_x.json",), ("b/llm_x.json",), ("c/other.json",)], "path string")
    assert found(m.presence_counts(files, "path", ["llm_x", "none"]), "kind", "files") == [("llm_x", 2), ("none", 0)]


def test_checksum_of_an_ordered_list(spark):
    import hashlib

    from corpusgate.functions import aggregates as agg

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def plain(digests, fan):
        while True:
            digests = [sha(",".join(digests[i : i + fan])) for i in range(0, len(digests), fan)]
            if len(digests) <= 1:
                return digests[0] if digests else sha("")

    rows = [(f"p{i:03d}", sha(str(i))) for i in range(57)]
    df = lambda rs: spark.createDataFrame(rs, "path string, d string")
    for fan in (3, 10, 1000):
        for parts in (1, 7):
            got = agg.ordered_checksum(df(rows[::-1]).repartition(parts), ["path"], "d", fan).first()
            assert tuple(got) == (57, plain([d for _, d in rows], fan))
    swapped = [("p000", rows[1][1]), ("p001", rows[0][1]), *rows[2:]]
    assert agg.ordered_checksum(df(swapped), ["path"], "d", 10).first()[1] != plain([d for _, d in rows], 10)
    assert tuple(agg.ordered_checksum(df(rows[:0]), ["path"], "d").first()) == (0, sha(""))
    assert tuple(agg.ordered_checksum(df([("a", None), (None, "x")]), ["path"], "d").first()) == (2, plain(["x", ""], 1000))


def test_error_and_research_counts(spark):
    docs = spark.createDataFrame([("An Error in the literature",), ("an error",), (None,)], "text string")
    errors = spark.createDataFrame([("p1", "x"), ("p1", "y")], "paper_id string, description string")
    files = spark.createDataFrame([("p1",), ("p2",)], "paper_id string")
    assert tuple(m.error_count(errors, files, docs).first()) == (2, True)
    assert tuple(m.error_count(errors.limit(0), files, docs).first()) == (0, True)
    assert tuple(m.error_count(errors.limit(0), files.limit(0), docs).first()) == (1, False)
    cl = claims(spark, {"id": "a", "linked_assumptions": ["x"], "status": "disputed", "linked_formal_targets": ["t"]}, {"id": "b", "linked_assumptions": [], "status": "disputed"}, {"id": "c", "linked_formal_targets": ["t"]})
    got = m.research_counts(cl, kernels(spark, {"id": "k", "linked_theorem_cards": ["x"]}, {"id": "l"})).first().asDict()
    assert got == {"claims_with_linked_assumptions": 1, "disputed_claims_with_formal_targets": 1, "kernels_with_linked_cards": 1}
