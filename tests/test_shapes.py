"""Types, unknown fields and missing fields at every depth of stored JSON."""

import json

import pytest

from corpusgate import schemas
from corpusgate.operators import shapes

SPAN = {"source_file": "a.pdf", "start": {"page": 1, "offset": 0}, "end": {"page": 1, "offset": 9}}
CLAIM = {
    "id": "c1", "paper_id": "p1", "section": "1", "source_span": SPAN, "informal_text": "t", "claim_type": "lemma",
    "status": "parsed", "value_kind": "bridge_lemma", "linked_symbols": ["s"],
}


def findings(spark, entity, *objects):
    rows = [(k, o if isinstance(o, str) or o is None else json.dumps(o)) for k, o in enumerate(objects)]
    got = shapes.shape_findings(spark.createDataFrame(rows, "k int, raw string"), ["k"], "raw", shapes.entity_paths(entity))
    return sorted((r["k"], r["place"], r["rule"], r["found"]) for r in got.collect())


def test_claims_at_every_level(spark):
    loose = SPAN | {"start": {"page": 1.0, "offset": 0, "line": 7}}
    assert findings(spark, "claims", CLAIM, CLAIM | {"source_span": loose}, None) == []
    assert findings(spark, "claims", CLAIM | {"section": 3, "review_notes": None, "linked_symbols": "s1"}) == [
        (0, "linked_symbols", "wrong_type", "string"),
        (0, "review_notes", "wrong_type", "null"),
        (0, "section", "wrong_type", "integer"),
    ]
    bad = {"source_file": "a.pdf", "start": {"page": "1", "offset": 0.5}, "end": [], "extra": {"deep": {"er": 1}}}
    assert findings(spark, "claims", CLAIM | {"source_span": bad, "linked_symbols": ["a", 5, None]}) == [
        (0, "linked_symbols[1]", "wrong_type", "integer"),
        (0, "linked_symbols[2]", "wrong_type", "null"),
        (0, "source_span.end", "wrong_type", "array"),
        (0, "source_span.extra", "unknown_field", "object"),
        (0, "source_span.start.offset", "wrong_type", "number"),
        (0, "source_span.start.page", "wrong_type", "string"),
    ]
    short = {k: v for k, v in CLAIM.items() if k not in ("id", "source_span")} | {"source_span": {"start": {"page": 1}}}
    assert findings(spark, "claims", short) == [
        (0, "", "missing_field", "id"),
        (0, "source_span", "missing_field", "end"),
        (0, "source_span", "missing_field", "source_file"),
        (0, "source_span.start", "missing_field", "offset"),
    ]


def test_texts_that_are_no_object(spark):
    assert findings(spark, "symbols", "{", "[1]", "7", '{"id": "a", "id": "b"}') == [
        (0, "", "unparsable", None), (1, "", "wrong_type", "array"), (2, "", "wrong_type", "integer"), (3, "", "unparsable", None),
    ]


def test_names_that_look_like_paths(spark):
    ok = {"paper_id": "p", "namespace": "N", "claim_to_decl": {"a.b": "x", "c[]": "y", "*": "z"}}
    assert findings(spark, "mapping", ok) == []
    assert findings(spark, "mapping", ok | {"claim_to_decl": {"a.b": 1}, "claim_to_decl.x": "u"}) == [
        (0, "claim_to_decl.a\\.b", "wrong_type", "integer"),
        (0, "claim_to_decl\\.x", "unknown_field", "string"),
    ]


def test_kernels_manifests_and_sidecars(spark):
    manifest = {"paper_id": "p", "version": "1", "build_hash": "0", "coverage_metrics": {"claim_count": 1, "mapped_claim_count": 1, "machine_checked_count": True, "other": 1}, "generated_pages": [], "dependency_graph": [{"from": "a", "to": "b"}, {"from": "a", "via": "x"}]}
    assert findings(spark, "manifest", manifest) == [
        (0, "coverage_metrics", "missing_field", "kernel_linked_count"),
        (0, "coverage_metrics.machine_checked_count", "wrong_type", "boolean"),
        (0, "coverage_metrics.other", "unknown_field", "integer"),
        (0, "dependency_graph[1]", "missing_field", "to"),
        (0, "dependency_graph[1].via", "unknown_field", "string"),
    ]
    port = {"name": "x", "numeric_kind": "float"}
    kernel = {"id": "k", "domain": "d", "semantic_contract": "s", "linked_theorem_cards": [], "io_typing": {"inputs": [port, {"name": "y", "unit": "m"}], "outputs": port}}
    assert findings(spark, "kernels", kernel) == [
        (0, "io_typing.inputs[1]", "missing_field", "numeric_kind"),
        (0, "io_typing.inputs[1].unit", "unknown_field", "string"),
        (0, "io_typing.outputs", "wrong_type", "object"),
    ]
    bundle = {"paper_id": "p", "schema_version": "0.1.0", "verification_boundary": "human_review_only", "metadata": {"provider": "x", "seed": 1.5, "who": "y", "input_artifact_sha256": {"f": "0", "g": 1}}}
    claims = bundle | {"proposals": [{"claim": CLAIM, "confidence": 1}, {"claim": CLAIM | {"odd": 1}, "confidence": "high"}, {"rationale": "r"}]}
    assert findings(spark, "llm_claim_proposals", claims) == [
        (0, "metadata.input_artifact_sha256.g", "wrong_type", "integer"),
        (0, "metadata.seed", "wrong_type", "number"),
        (0, "metadata.who", "unknown_field", "string"),
        (0, "proposals[1].claim.odd", "unknown_field", "integer"),
        (0, "proposals[1].confidence", "wrong_type", "string"),
        (0, "proposals[2]", "missing_field", "claim"),
    ]
    edits = bundle | {"metadata": {}, "proposals": [{"proposal_id": "1", "paper_id": "p", "target_file": "f", "edit_kind": "k", "replacements": [{"find": "a"}]}]}
    assert findings(spark, "llm_lean_proposals", edits) == [(0, "proposals[0].replacements[0]", "missing_field", "replace")]


@pytest.mark.parametrize("entity", sorted(schemas.SHAPES))
def test_every_entity_has_paths_for_what_it_needs(spark, entity):
    known = {p.path: p for p in shapes.entity_paths(entity)}
    for path, names in schemas.needed(entity).items():
        assert known[path].kinds == ("object",)
        assert all((f"{path}.{n}" if path else n) in known for n in names)
    assert [r[2] for r in findings(spark, entity, {"nobody": 1}) if r[2] != "missing_field"] == ["unknown_field"]


def test_violation_rows(spark):
    df = spark.createDataFrame([("p", "s1", '{"id": "s1", "paper_id": "p", "raw_latex": 1, "normalized_name": "x"}')], "paper_id string, id string, raw string")
    got = shapes.shape_violations("symbols", df, "paper_id", "id").first()
    assert (got["group_id"], got["row_id"], got["message"]) == ("p", "s1", "symbols.raw_latex breaks wrong_type: integer")
