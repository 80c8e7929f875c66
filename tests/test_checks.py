from pyspark.sql import functions as F

import glob
import time

from corpusgate import schemas
from corpusgate.operators import checks as k
from corpusgate.operators import linking
from corpusgate.plans.gates import run_gates
from corpusgate.plans.publication import Corpus, build_fingerprint, first_artifacts, publish
from corpusgate.session import CLEANUP_CONF, durable
from tests.helpers import SPAN, assumptions, cards, claims, found, kernels, manifests, mapping, messages, papers, rows, symbols


def test_conformance_of_claims(spark):
    good = {"id": "c_1", "claim_type": "lemma", "value_kind": "bridge_lemma"}
    df = claims(
        spark,
        good,
        good | {"id": "Bad Id"},
        good | {"id": "c2", "status": "odd", "linked_symbols": ["ok", "No"]},
        good | {"id": "c3", "source_span": {"source_file": "f", "start": {"page": 0, "offset": 0}, "end": None}},
        good | {"id": "c4", "informal_text": "", "value_kind": None},
    )
    got = {}
    for r in k.conformance(df, schemas.RULES["claims"], ["pos"]).collect():
        got.setdefault(r["pos"], set()).add((r["field"], r["rule"]))
    assert got == {
        1: {("id", "pattern")},
        2: {("status", "one_of"), ("linked_symbols", "items_pattern")},
        3: {("source_span.end.page", "required"), ("source_span.end.offset", "required"), ("source_span.start.page", "at_least")},
        4: {("informal_text", "filled"), ("value_kind", "required")},
    }


def test_unknown_fields_are_reported(spark):
    df = spark.createDataFrame([("a", '{"id": "a", "x": 1}'), ("b", '{"id": "b"}')], "id string, raw string")
    got = k.conformance(df, [], ["id"], raw="raw", allowed=["id"])
    assert found(got, "id", "field", "rule") == [("a", "x", "unknown_field")]


def test_every_rule_names_an_existing_field(spark):
    ddls = {**schemas.ARRAY_ENTITIES, **schemas.OBJECT_ENTITIES, "kernels": schemas.KERNEL}
    for entity, rules in {**schemas.RULES, **schemas.SIDECAR_RULES}.items():
        assert k.conformance(spark.createDataFrame([], ddls[entity]), rules, []).count() == 0


def test_lifecycle_and_card_review(spark):
    cl = claims(spark, {"id": "1", "status": "odd"}, {"id": "2", "status": "disputed", "review_notes": " "}, {"id": "3", "status": "disputed", "review_notes": "x"}, {"id": "4", "status": None})
    assert found(k.lifecycle(cl), "row_id", "message") == [("1", "invalid status odd"), ("2", "disputed without review_notes")]
    ca = cards(
        spark, {"id": "1", "reviewer_status": None}, {"id": "2", "reviewer_status": "odd"}, {"id": "3", "reviewer_status": "blocked"},
        {"id": "4", "reviewer_status": "accepted"}, {"id": "5", "reviewer_status": "accepted", "proof_status": "machine_checked"}, {"id": "6", "reviewer_status": "blocked", "notes": "n"},
    )
    assert [r[0] for r in found(k.card_review(ca), "row_id")] == ["1", "2", "3", "4"]


def test_normalization_integrity(spark):
    cl = claims(spark, {"id": "c", "linked_assumptions": ["a1", "ghost"], "linked_symbols": ["s9"]}, {"id": "c"})
    out = k.normalization_integrity(cl, assumptions(spark, {"id": "a1"}), symbols(spark, {"id": "s1"}, {"id": "s1", "paper_id": "p2"}))
    assert messages(out) == ["duplicate claim id", "linked_assumptions references missing ghost", "linked_symbols references missing s9"]


def test_provenance(spark):
    zero = {"kind": "pdf", "path": "x", "sha256": "0" * 64}
    pa = papers(
        spark, {"id": "p1", "source": zero}, {"id": "p2", "source": zero, "tags": ["hardness.primary:units"]},
        {"id": "p3", "source": zero}, {"id": "p4", "source": zero, "tags": ["hardness.primary:x"]}, {"id": "p5"},
    )
    ma = manifests(spark, {"paper_id": "p1"}, {"paper_id": "p2"}, {"paper_id": "p4"}, {"paper_id": "p5", "declaration_index": ["N.S.a", "N.S.b"]})
    cl = claims(spark, {"paper_id": "p4", "id": "c"}, {"paper_id": "p5", "id": "d", "source_span": None})
    mp = mapping(spark, {"paper_id": "p5", "claim_to_decl": {"d": "a"}})
    assert found(k.provenance(pa, cl, ma, mp), "row_id", "message") == [
        ("N.S.b", "declaration without mapped claim"), ("d", "missing source_span"),
        ("p1", "manifest with all-zero source hash"), ("p4", "manifest with all-zero source hash"),
    ]


def test_graph_integrity_pairs(spark):
    cl = claims(spark, {"id": "c1", "linked_assumptions": ["a1", "zz"], "linked_symbols": ["any"]})
    ca = cards(
        spark, {"id": "k1", "claim_id": "c1", "lean_decl": "d", "dependency_ids": ["k1", "nope"], "executable_links": ["kern", "bad"]},
        {"id": "k2", "claim_id": "ghost", "lean_decl": "d", "file_path": " "}, {"id": "k9", "paper_id": "no_claims", "claim_id": "x"},
    )
    ke = kernels(spark, {"id": "kern", "linked_theorem_cards": ["k1", "k9"]})
    ma = manifests(spark, {"kernel_index": ["kern", "missing"]})
    mp = mapping(spark, {"claim_to_decl": {"c1": "d", "c7": "e"}})
    out = k.graph_integrity(cl, assumptions(spark, {"id": "a1"}), symbols(spark), mp, ca, ma, ke)
    assert messages(out) == [
        "card claim is missing: ghost", "card dependency is missing: nope", "card kernel is missing: bad", "card without file_path",
        "claim assumption is missing: zz", "kernel card is missing: k9", "manifest kernel is missing: missing", "mapping claim is missing: c7",
    ]
    none = kernels(spark)
    out = k.graph_integrity(cl, assumptions(spark), symbols(spark), mp, ca, ma, none)
    assert messages(out) == ["card claim is missing: ghost", "card dependency is missing: nope", "card without file_path", "mapping claim is missing: c7"]


def contract(**change):
    base = {
        "units": {"inputs": {"K": "u"}, "outputs": {"y": "w"}}, "domains": {"inputs": {"K": "K >= 0"}, "outputs": {"y": "any"}},
        "witness_type": "numerically_witnessed",
        "obligations": {"expected_linked_theorem_cards": ["a"], "satisfied_linked_theorem_cards": ["a"], "unsatisfied_linked_theorem_cards": []},
    }
    return {
        "id": "k", "test_status": "tested", "linked_theorem_cards": ["a"], "contract_v1": base | change,
        "io_typing": {"inputs": [{"name": "K", "numeric_kind": "nonnegative_float"}], "outputs": [{"name": "y", "numeric_kind": "float"}]},
    }


def test_kernel_contract(spark):
    assert k.kernel_contract(kernels(spark, contract(), {"id": "u", "test_status": "untested", "linked_theorem_cards": ["a"]})).count() == 0
    bad = contract(domains={"inputs": {"K": "real"}, "outputs": {"y": "any"}}, witness_type="guess")
    assert messages(k.kernel_contract(kernels(spark, bad))) == ["domain lacks a sign hint", "witness_type must be numerically_witnessed"]
    unmet = contract(obligations={"expected_linked_theorem_cards": ["a", "b"], "satisfied_linked_theorem_cards": ["a"], "unsatisfied_linked_theorem_cards": ["b"]})
    assert messages(k.kernel_contract(kernels(spark, unmet))) == ["expected obligations must equal linked cards", "unsatisfied obligations remain"]
    assert messages(k.kernel_witness(kernels(spark, {"id": "u", "linked_theorem_cards": ["a"]}))) == ["linked kernel has test_status missing"]


def test_snapshot_quality(spark):
    df = spark.createDataFrame(
        [("v1", "T", "long enough text", ["h"]), ("release-2", "", "short", []), ("draft", "T", "long enough text", None)],
        "baseline_id string, title string, narrative string, highlights array<string>",
    )
    assert messages(k.snapshot_quality(df)) == ["missing or empty title", "narrative too short", "release baseline without highlights"]


def small_corpus(spark, **claim):
    raw = lambda df: df.withColumn("raw", F.to_json(F.struct(*[x for x in df.columns if x != "pos"])))
    base = {"claim_type": "lemma", "value_kind": "bridge_lemma", "linked_formal_targets": ["N.S.one"], "status": "machine_checked"}
    cl = claims(spark, base | {"id": "c1"} | claim, base | {"id": "c2", "linked_formal_targets": ["N.S.two"], "status": "linked_to_kernel"})
    docs = spark.createDataFrame([("formal/N/S.lean", "theorem one : T := by simp\ntheorem two : T := by\n  exact one\n")], "path string, text string")
    mp = mapping(spark, {"claim_to_decl": {"c1": "one", "c2": "two"}})
    pa = papers(spark, {"id": "p1", "source": {"kind": "pdf", "path": "x", "sha256": "a" * 64, "doi": "10/1"}}).withColumn("paper_id", F.col("id"))
    ke = kernels(spark, contract() | {"linked_theorem_cards": ["p1_card_002"], "domain": "d", "semantic_contract": "s", "contract_v1": contract()["contract_v1"] | {"obligations": {
        "expected_linked_theorem_cards": ["p1_card_002"], "satisfied_linked_theorem_cards": ["p1_card_002"], "unsatisfied_linked_theorem_cards": []}}})
    ma = rows(spark, schemas.MANIFEST, {
        "paper_id": "p1", "version": "1", "build_hash": "b" * 64, "generated_pages": [], "declaration_index": ["N.S.one", "N.S.two"],
        "coverage_metrics": {"claim_count": 2, "mapped_claim_count": 2, "machine_checked_count": 1, "kernel_linked_count": 1}, "kernel_index": ["k"]})
    empty = cards(spark)
    return Corpus(raw(pa.drop("paper_id")).withColumn("paper_id", F.col("id")), raw(cl), raw(assumptions(spark)), raw(symbols(spark)), raw(mp), empty, ma, ke, docs,
                  spark.createDataFrame([("p1",)], "paper_id string"))


def test_publication_end_to_end(spark):
    corpus = small_corpus(spark)
    out = publish(corpus, "N")
    assert found(out["dependency_graph"], "src", "dst", "confidence") == [("p1_card_001", "p1_card_002", "medium")]
    assert found(out["theorem_cards"], "id", "executable_links", "reviewer_status") == [("p1_card_001", [], "accepted"), ("p1_card_002", ["k"], "reviewed")]
    cov = out["coverage"].first()
    assert (cov["claim_count"], cov["machine_checked_count"], cov["kernel_linked_count"]) == (2, 1, 1)
    assert found(out["kernel_index"], "paper_id", "kernel_id") == [("p1", "k")]
    assert [r["path"] for r in out["generated_pages"].orderBy("path").collect()] == [
        "/claims/c1", "/claims/c2", "/papers/p1", "/theorem-cards/p1_card_001", "/theorem-cards/p1_card_002"]
    first = out["build_hash"].first()["build_hash"]
    assert first == publish(small_corpus(spark), "N")["build_hash"].first()["build_hash"]
    assert first != publish(small_corpus(spark, informal_text="changed"), "N")["build_hash"].first()["build_hash"]


def test_build_hash_marks_what_is_missing(spark):
    corpus = small_corpus(spark)
    read = lambda: tuple(build_fingerprint(corpus, cards(spark, {"id": "k", "lean_decl": "N.S.one"})).first())
    full = read()
    assert full[0] == "p1" and full[2] == "2"
    corpus.mapping = corpus.mapping.limit(0)
    bare = read()
    assert bare[2] == "2" and bare[1] != full[1]
    corpus.claims = corpus.claims.limit(0)
    legacy = read()
    corpus.symbols = corpus.symbols.unionByName(symbols(spark, {"id": "s"}).withColumn("raw", F.lit("{}")), allowMissingColumns=True)
    assert legacy[2] == "1" and read() == legacy  # version 1 covers id, declarations and files alone


def test_published_papers_keep_their_first_time(spark):
    papers_ = small_corpus(spark).papers
    once = first_artifacts(papers_, F.lit("2024-01-01T00:00:00Z"))
    assert found(first_artifacts(once, F.lit("2025-01-01T00:00:00Z")), "id", "first_artifact_at") == [("p1", "2024-01-01T00:00:00Z")]


def test_first_finding_is_first_in_the_list(spark):
    cl = claims(spark, {"id": "c2", "status": "odd"}, {"id": "c10", "status": "odd"}, {"id": "c1"}, {"id": None, "status": "odd"})
    linked = claims(spark, {"id": "b", "linked_symbols": ["x"]}, {"id": "a", "linked_symbols": ["x"]}).withColumn("paper_id", F.lit("p0"))
    bad = k.union_all([k.lifecycle(cl), k.normalization_integrity(linked, assumptions(spark), symbols(spark))]).repartition(3)
    first = {r["check_id"]: (r["findings"], r["row_id"]) for r in k.gate_report(bad).where("findings > 0").collect()}
    assert first == {"reviewer_lifecycle": (3, "c2"), "normalization_integrity": (2, "b")}


def test_all_gates_pass_then_fail(spark):
    corpus = small_corpus(spark)
    corpus.cards = publish(corpus, "N")["theorem_cards"]
    findings, report = run_gates(corpus)
    assert messages(findings) == []
    assert k.verdict(report).first()["ok"]
    corpus.claims = corpus.claims.withColumn("status", F.when(F.col("id") == "c1", "disputed").otherwise(F.col("status")))
    findings, report = run_gates(corpus)
    final = k.verdict(report).first()
    assert not final["ok"] and final["first_failure"] == "reviewer_lifecycle"
    assert [r["check_id"] for r in report.where("status = 'error'").orderBy("step").collect()] == ["reviewer_lifecycle", "coverage_integrity"]


def test_span_constant_is_complete(spark):
    from corpusgate.functions import columns as c

    df = claims(spark, {"id": "1", "source_span": SPAN}, {"id": "2", "source_span": SPAN | {"source_file": ""}}, {"id": "3", "source_span": None})
    assert [bool(r[0]) for r in df.orderBy("pos").select(c.span_complete("source_span")).collect()] == [True, False, False]


def test_graph_integrity_shuffles_its_rows_once(spark, monkeypatch):
    """Also where neither papers nor keys are broadcast, and counted by message and row."""
    monkeypatch.setattr(k, "BROADCAST_PAPERS", 0)
    monkeypatch.setattr(linking, "BROADCAST_KEYS", 0)
    cl = claims(spark, {"id": "c1", "linked_assumptions": ["a1", "zz"], "linked_symbols": ["s1", "s2"]}, {"paper_id": None, "id": "c2"})
    ca = cards(
        spark, {"id": "k1", "claim_id": "c1", "lean_decl": "d", "file_path": " ", "dependency_ids": ["k1", "nope", "nope", "k9"], "executable_links": ["kern", "bad"]},
        {"id": "k1", "claim_id": "c2", "dependency_ids": ["nope"]}, {"id": "k2", "paper_id": None, "claim_id": "c2", "dependency_ids": ["k1"]},
        {"id": "k9", "paper_id": "no_claims", "claim_id": "x"},
    )
    out = k.graph_integrity(
        cl, assumptions(spark, {"id": "a1"}), symbols(spark, {"id": "s1"}), mapping(spark, {"claim_to_decl": {"c1": "d", "c7": "e"}}), ca,
        manifests(spark, {"kernel_index": ["kern", "missing"]}), kernels(spark, {"id": "kern", "linked_theorem_cards": ["k1", "k9"]}),
    ).groupBy("message", "group_id", "row_id").count()
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert found(out, "message", "group_id", "row_id", "count") == [
        ("card claim is missing: c2", "", "k2", 1), ("card claim is missing: c2", "p1", "k1", 1), ("card dependency is missing: k9", "p1", "k1", 1),
        ("card dependency is missing: nope", "p1", "k1", 3), ("card kernel is missing: bad", "p1", "k1", 1), ("card without file_path", "p1", "k1", 1),
        ("claim assumption is missing: zz", "p1", "c1", 1), ("claim symbol is missing: s2", "p1", "c1", 1), ("kernel card is missing: k9", "", "kern", 1),
        ("manifest kernel is missing: missing", "p1", "p1", 1), ("mapping claim is missing: c7", "p1", "p1", 1),
    ]


def test_released_tables_leave_no_shuffle_files(spark):
    folders = [*spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()]
    shuffles = lambda: {p for d in folders for p in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before, rows = shuffles(), spark.range(1000).repartition(5, "id")
    rows.count()
    assert shuffles() - before  # these stay until garbage is collected
    before = shuffles()
    kept = durable(rows, "kept", "zstd", release=True)
    assert sorted(r[0] for r in kept.collect()) == [*range(1000)]
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(CLEANUP_CONF) == "false"


def test_graph_integrity_reads_each_table_once(spark):
    frames = [claims(spark, {"id": "c"}), assumptions(spark), symbols(spark), mapping(spark, {"claim_to_decl": {}}), cards(spark), manifests(spark), kernels(spark)]
    out = k.graph_integrity(*frames)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 6 and "LogicalRDD" not in plan  # the stored references only
    assert messages(k.coverage_integrity(manifests(spark, {"paper_id": "p9", "coverage_metrics": {
        "claim_count": 0, "mapped_claim_count": 0, "machine_checked_count": 0, "kernel_linked_count": 0}}), frames[0], frames[4])) == ["manifest without claims"]
