"""Entity types and the conformance rules checked on them.

Readers use these types explicitly, never inference. The rules are plain rows so that a table can be
checked in one pass; see :func:`corpusgate.operators.checks.conformance`.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from corpusgate.functions import columns as c

SPAN = (
    "struct<source_file:string,start:struct<page:int,offset:int>,end:struct<page:int,offset:int>>"
)
METADATA = (
    "struct<model:string,created_at:string,latency_seconds:double,"
    "reviewer_time_seconds:double,reviewer_decision:string>"
)

# The fields of each entity as stored in its JSON file.
CLAIM = (
    f"id string, paper_id string, section string, source_span {SPAN}, informal_text string, "
    "claim_type string, mathematical_density string, status string, value_kind string, "
    "linked_symbols array<string>, linked_assumptions array<string>, "
    "linked_symbols_unresolved array<string>, linked_assumptions_unresolved array<string>, "
    "linked_formal_targets array<string>, review_notes string"
)
ASSUMPTION = (
    f"id string, paper_id string, source_span {SPAN}, text string, kind string, "
    "explicit_or_implicit string, normalization_status string"
)
SYMBOL = (
    "id string, paper_id string, raw_latex string, normalized_name string, type_hint string, "
    "dimensional_metadata struct<kind:string,unit:string,dimension:string>, ambiguity_flags array<string>"
)
CARD = (
    "id string, claim_id string, lean_decl string, file_path string, proof_status string, "
    "verification_boundary string, reviewer_status string, dependency_ids array<string>, "
    "dependency_extraction_method string, executable_links array<string>, notes string"
)
LITERATURE_ERROR = "claim_id string, description string, severity string, source string"
PAPER = (
    "id string, title string, authors array<string>, year int, domain string, abstract string, "
    "tags array<string>, "
    "source struct<kind:string,path:string,sha256:string,doi:string,arxiv_id:string>, "
    "artifact_status string, ingestion_status string, first_artifact_at string"
)
MAPPING = "paper_id string, namespace string, target_file string, claim_to_decl map<string,string>"
MANIFEST = (
    "paper_id string, version string, build_hash string, build_hash_version string, "
    "coverage_metrics struct<claim_count:bigint,mapped_claim_count:bigint,"
    "machine_checked_count:bigint,kernel_linked_count:bigint>, "
    "generated_pages array<string>, declaration_index array<string>, "
    "dependency_graph array<struct<from:string,to:string,confidence:string>>, kernel_index array<string>"
)
EXTRACTION_RUN = (
    "paper_id string, recorded_at string, claim_count bigint, claims_with_source_span bigint, "
    "assumption_count bigint, extraction_mode string, placeholder_claim_written boolean"
)
INTAKE_REPORT = "paper_id string, created_at string, source_files_found array<string>"
IO = "array<struct<name:string,numeric_kind:string>>"
SIDES = "struct<inputs:map<string,string>,outputs:map<string,string>>"
KERNEL = (
    "id string, domain string, input_schema string, output_schema string, semantic_contract string, "
    "unit_constraints array<string>, linked_theorem_cards array<string>, test_status string, "
    f"io_typing struct<inputs:{IO},outputs:{IO}>, "
    f"contract_v1 struct<units:{SIDES},domains:{SIDES},exceptional_cases:array<string>,"
    "approximation_regimes:array<string>,tolerances:struct<absolute_error:double,relative_error:double>,"
    "witness_type:string,obligations:struct<expected_linked_theorem_cards:array<string>,"
    "satisfied_linked_theorem_cards:array<string>,unsatisfied_linked_theorem_cards:array<string>>>"
)
GOLD_SPAN = f"claim_id string, source_span {SPAN}"


def _bundle(entry: str) -> str:
    return (
        "paper_id string, schema_version string, verification_boundary string, "
        f"metadata {METADATA}, proposals array<struct<{entry}>>"
    )


def _top_level(ddl: str) -> list[str]:
    """The comma-separated parts of a DDL string outside any angle bracket."""
    out, depth, word = [], 0, ""
    for ch in ddl + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(word.strip())
            word = ""
        else:
            word += ch
    return out


def _fields(ddl: str) -> str:
    """Top-level DDL columns as struct fields."""
    return ",".join(":".join(part.split(" ", 1)) for part in _top_level(ddl))


def field_names(ddl: str) -> list[str]:
    return [part.split(" ", 1)[0] for part in _top_level(ddl)]


CLAIM_PROPOSALS = _bundle(
    f"claim:struct<{_fields(CLAIM)}>,rationale:string,confidence:double,evidence_quote:string"
)
MAPPING_PROPOSALS = _bundle(
    "claim_id:string,lean_declaration_short_name:string,rationale:string,confidence:double"
)
EDIT_PROPOSALS = _bundle(
    "proposal_id:string,paper_id:string,claim_id:string,target_file:string,target_decl:string,"
    "edit_kind:string,replacements:array<struct<find:string,replace:string>>,patch_text:string,"
    "rationale:string,confidence:double,safety_flags:array<string>"
)
ASSUMPTION_PROPOSALS = _bundle(f"assumption:struct<{_fields(ASSUMPTION)}>,rationale:string,confidence:double")
SYMBOL_PROPOSALS = _bundle(f"symbol:struct<{_fields(SYMBOL)}>,rationale:string,confidence:double")

ARRAY_ENTITIES = {
    "claims": CLAIM,
    "assumptions": ASSUMPTION,
    "symbols": SYMBOL,
    "theorem_cards": CARD,
    "literature_errors": LITERATURE_ERROR,
    "source_spans": GOLD_SPAN,
}
OBJECT_ENTITIES = {
    "metadata": PAPER,
    "mapping": MAPPING,
    "manifest": MANIFEST,
    "extraction_run": EXTRACTION_RUN,
    "intake_report": INTAKE_REPORT,
    "llm_claim_proposals": CLAIM_PROPOSALS,
    "llm_mapping_proposals": MAPPING_PROPOSALS,
    "llm_lean_proposals": EDIT_PROPOSALS,
    "suggested_assumptions": ASSUMPTION_PROPOSALS,
    "suggested_symbols": SYMBOL_PROPOSALS,
    "suggested_mapping": MAPPING_PROPOSALS,
}


@dataclass(frozen=True)
class Rule:
    """One conformance rule on a (possibly nested) field.

    ``kind`` is required, filled, pattern, one_of, at_least, at_most, min_items, items_pattern,
    items_one_of or items_filled. Rules other than ``required`` pass on a missing value.
    """

    field: str
    kind: str
    arg: Any = None


# Formats of ids and digests, closed vocabularies and bounds.
ID = r"^[a-z0-9_\-\.]+$"
DIGEST = "^[a-f0-9]{64}$"
NAME = "^[A-Za-z][A-Za-z0-9_]*$"
DECL = "^[a-zA-Z_][a-zA-Z0-9_']*$"
CLAIM_TYPES = (
    "definition",
    "theorem",
    "lemma",
    "proposition",
    "corollary",
    "estimator",
    "identity",
    "conservation_law",
    "control_rule",
    "dimensional_constraint",
    "algorithmic_step",
    "acceptance_criterion",
    "editorial_exposition",
)
VALUE_KINDS = (
    "foundational_law",
    "bridge_lemma",
    "executable_contract",
    "experimental_invariant",
    "cross_paper_anchor",
)
ASSUMPTION_KINDS = (
    "physical_regime",
    "domain_restriction",
    "smoothness",
    "boundedness",
    "measurement_assumption",
    "unit_convention",
    "approximation",
    "editorial",
    "other",
)


def _required(*fields: str) -> list[Rule]:
    return [Rule(f, "required") for f in fields]


SPAN_RULES = [
    *_required(
        "source_span.source_file", "source_span.start.page", "source_span.start.offset",
        "source_span.end.page", "source_span.end.offset",
    ),
    Rule("source_span.start.page", "at_least", 1),
    Rule("source_span.start.offset", "at_least", 0),
    Rule("source_span.end.page", "at_least", 1),
    Rule("source_span.end.offset", "at_least", 0),
]

RULES: dict[str, list[Rule]] = {
    "metadata": [
        *_required("id", "title", "authors", "year", "domain", "source", "artifact_status"),
        *_required("source.kind", "source.path", "source.sha256"),
        Rule("id", "pattern", ID),
        Rule("title", "filled"),
        Rule("authors", "min_items", 1),
        Rule("authors", "items_filled"),
        Rule("year", "at_least", 1500),
        Rule("year", "at_most", 3000),
        Rule("domain", "one_of", c.PAPER_DOMAINS),
        Rule("source.kind", "one_of", ("pdf", "latex", "arxiv_bundle", "other")),
        Rule("source.sha256", "pattern", DIGEST),
        Rule("artifact_status", "one_of", ("admitted", "in_progress", "published", "archived")),
        Rule("ingestion_status", "one_of", ("pending", "ingested", "failed")),
    ],
    "claims": [
        *_required(
            "id", "paper_id", "section", "source_span", "informal_text", "claim_type", "status", "value_kind"
        ),
        *SPAN_RULES,
        Rule("id", "pattern", ID),
        Rule("paper_id", "pattern", ID),
        Rule("informal_text", "filled"),
        Rule("claim_type", "one_of", CLAIM_TYPES),
        Rule("mathematical_density", "one_of", ("low", "medium", "high")),
        Rule("status", "one_of", c.CLAIM_STATUSES),
        Rule("value_kind", "one_of", VALUE_KINDS),
        Rule("linked_symbols", "items_pattern", ID),
        Rule("linked_assumptions", "items_pattern", ID),
        Rule("linked_symbols_unresolved", "items_filled"),
        Rule("linked_assumptions_unresolved", "items_filled"),
    ],
    "assumptions": [
        *_required("id", "paper_id", "source_span", "text", "kind"),
        *SPAN_RULES,
        Rule("id", "pattern", ID),
        Rule("paper_id", "pattern", ID),
        Rule("text", "filled"),
        Rule("kind", "one_of", ASSUMPTION_KINDS),
        Rule("explicit_or_implicit", "one_of", ("explicit", "implicit")),
        Rule("normalization_status", "one_of", ("raw", "normalized", "disputed")),
    ],
    "symbols": [
        *_required("id", "paper_id", "raw_latex", "normalized_name"),
        Rule("id", "pattern", ID),
        Rule("paper_id", "pattern", ID),
        Rule("ambiguity_flags", "items_one_of", c.AMBIGUITY_FLAGS),
    ],
    "mapping": [
        *_required("paper_id", "namespace", "claim_to_decl"),
        Rule("paper_id", "pattern", ID),
        Rule("namespace", "filled"),
    ],
    "theorem_cards": [
        *_required(
            "id", "claim_id", "lean_decl", "file_path", "proof_status", "verification_boundary",
            "reviewer_status",
        ),
        Rule("id", "pattern", ID),
        Rule("claim_id", "pattern", ID),
        Rule("lean_decl", "filled"),
        Rule("proof_status", "one_of", c.CLAIM_STATUSES),
        Rule("verification_boundary", "one_of", c.VERIFICATION_BOUNDARIES),
        Rule("reviewer_status", "one_of", c.REVIEWER_STATUSES),
        Rule("dependency_ids", "items_pattern", ID),
        Rule("executable_links", "items_pattern", ID),
    ],
    "manifest": [
        *_required("paper_id", "version", "build_hash", "coverage_metrics", "generated_pages"),
        *_required(
            "coverage_metrics.claim_count", "coverage_metrics.mapped_claim_count",
            "coverage_metrics.machine_checked_count", "coverage_metrics.kernel_linked_count",
        ),
        Rule("paper_id", "pattern", ID),
        Rule("build_hash", "pattern", DIGEST),
        Rule("coverage_metrics.claim_count", "at_least", 0),
        Rule("coverage_metrics.mapped_claim_count", "at_least", 0),
        Rule("coverage_metrics.machine_checked_count", "at_least", 0),
        Rule("coverage_metrics.kernel_linked_count", "at_least", 0),
        Rule("kernel_index", "items_pattern", ID),
        Rule("dependency_graph.from", "items_pattern", ID),
        Rule("dependency_graph.to", "items_pattern", ID),
        Rule("dependency_graph.confidence", "items_one_of", ("high", "medium", "low")),
    ],
    "kernels": [
        *_required("id", "domain", "io_typing", "semantic_contract", "linked_theorem_cards"),
        Rule("id", "pattern", ID),
        Rule("io_typing.inputs", "min_items", 1),
        Rule("io_typing.outputs", "min_items", 1),
        Rule("io_typing.inputs.name", "items_pattern", NAME),
        Rule("io_typing.outputs.name", "items_pattern", NAME),
        Rule("io_typing.inputs.numeric_kind", "items_one_of", ("float", "int", "nonnegative_float", "positive_float")),
        Rule("io_typing.outputs.numeric_kind", "items_one_of", ("float", "int", "nonnegative_float", "positive_float")),
        Rule("contract_v1.witness_type", "one_of", ("numerically_witnessed",)),
        Rule("contract_v1.tolerances.absolute_error", "at_least", 0),
        Rule("contract_v1.tolerances.relative_error", "at_least", 0),
        Rule("linked_theorem_cards", "items_pattern", ID),
        Rule("test_status", "one_of", ("untested", "tested", "failing")),
    ],
}
BUNDLE_RULES = [
    *_required("paper_id", "schema_version", "verification_boundary", "proposals"),
    Rule("paper_id", "pattern", ID),
    Rule("schema_version", "one_of", ("0.1.0",)),
    Rule("verification_boundary", "one_of", ("human_review_only",)),
    Rule("metadata.reviewer_time_seconds", "at_least", 0),
    Rule("metadata.reviewer_decision", "one_of", ("pending", "accepted", "rejected", "edited")),
]
SIDECAR_RULES: dict[str, list[Rule]] = {
    "llm_claim_proposals": [*BUNDLE_RULES, Rule("proposals.claim.id", "items_pattern", ID)],
    "llm_mapping_proposals": [
        *BUNDLE_RULES,
        Rule("proposals.claim_id", "items_pattern", ID),
        Rule("proposals.lean_declaration_short_name", "items_pattern", DECL),
    ],
    "llm_lean_proposals": [
        *BUNDLE_RULES,
        Rule("proposals.proposal_id", "items_filled"),
        Rule("proposals.target_file", "items_pattern", r"^formal/(?!.*\.\.).*"),
        Rule("proposals.edit_kind", "items_one_of", ("new_theorem", "proof_repair", "lemma_extraction")),
    ],
    "suggested_assumptions": [*BUNDLE_RULES, Rule("proposals.assumption.id", "items_pattern", ID)],
    "suggested_symbols": [*BUNDLE_RULES, Rule("proposals.symbol.id", "items_pattern", ID)],
    "suggested_mapping": [
        *BUNDLE_RULES,
        Rule("proposals.claim_id", "items_pattern", ID),
        Rule("proposals.lean_declaration_short_name", "items_pattern", DECL),
    ],
}

# --- shapes of the stored JSON ------------------------------------------------------------------

# What a proposal bundle may say of the run that made it.
PROVENANCE = (
    "struct<provider:string,model:string,model_version:string,created_at:string,latency_seconds:double,"
    "temperature:double,top_p:double,max_tokens:bigint,seed:bigint,prompt_template_id:string,"
    "prompt_template_sha256:string,input_artifact_sha256:map<string,string>,prompt_tokens:bigint,"
    "completion_tokens:bigint,total_tokens:bigint,estimated_cost_usd:double,reviewer_time_seconds:double,"
    "reviewer_decision:string,promotion_outcome:string,notes:string>"
)
#: Stored type of one object of each entity and sidecar.
SHAPES: dict[str, str] = {
    "metadata": PAPER,
    "claims": CLAIM,
    "assumptions": ASSUMPTION,
    "symbols": SYMBOL,
    "theorem_cards": CARD,
    "mapping": MAPPING,
    "manifest": MANIFEST,
    "kernels": KERNEL,
    "literature_errors": LITERATURE_ERROR,
    **{
        name: OBJECT_ENTITIES[name].replace(METADATA, PROVENANCE)
        for name in (
            "llm_claim_proposals", "llm_mapping_proposals", "llm_lean_proposals",
            "suggested_assumptions", "suggested_symbols", "suggested_mapping",
        )
    },
}
# Fields that an object at a path must have, where RULES does not say so, and objects that may
# have fields beyond their type.
_PORT = ("name", "numeric_kind")
_SIDES = ("inputs", "outputs")
NEEDED: dict[str, dict[str, tuple[str, ...]]] = {
    "manifest": {"dependency_graph[]": ("from", "to")},
    "literature_errors": {"": ("description",)},
    "kernels": {
        "io_typing": _SIDES,
        "io_typing.inputs[]": _PORT,
        "io_typing.outputs[]": _PORT,
        "contract_v1": (
            "units", "domains", "exceptional_cases", "approximation_regimes", "tolerances", "witness_type", "obligations",
        ),
        "contract_v1.units": _SIDES,
        "contract_v1.domains": _SIDES,
        "contract_v1.tolerances": ("absolute_error", "relative_error"),
        "contract_v1.obligations": (
            "expected_linked_theorem_cards", "satisfied_linked_theorem_cards", "unsatisfied_linked_theorem_cards",
        ),
    },
    "llm_claim_proposals": {"proposals[]": ("claim",)},
    "llm_mapping_proposals": {"proposals[]": ("claim_id", "lean_declaration_short_name")},
    "llm_lean_proposals": {
        "proposals[]": ("proposal_id", "paper_id", "target_file", "edit_kind"),
        "proposals[].replacements[]": ("find", "replace"),
    },
    "suggested_assumptions": {"proposals[]": ("assumption",)},
    "suggested_symbols": {"proposals[]": ("symbol",)},
    "suggested_mapping": {"proposals[]": ("claim_id", "lean_declaration_short_name")},
}
#: Entities whose objects stand inside another entity's.
NESTED = {
    "llm_claim_proposals": {"proposals[].claim": "claims"},
    "suggested_assumptions": {"proposals[].assumption": "assumptions"},
    "suggested_symbols": {"proposals[].symbol": "symbols"},
}
OPEN_OBJECTS = ("source_span.start", "source_span.end")


def needed(entity: str) -> dict[str, set[str]]:
    """Fields that the objects of an entity must have, by path."""
    out: dict[str, set[str]] = {path: set(names) for path, names in NEEDED.get(entity, {}).items()}
    for rule in [*RULES.get(entity, ()), *SIDECAR_RULES.get(entity, ())]:
        if rule.kind == "required":
            steps = rule.field.split(".")
            for k, step in enumerate(steps):  # a nested field's objects are needed only where they are listed
                if k == len(steps) - 1:
                    out.setdefault(".".join(steps[:k]), set()).add(step)
    for path, other in NESTED.get(entity, {}).items():
        for inner, names in needed(other).items():
            out.setdefault(f"{path}.{inner}" if inner else path, set()).update(names)
    if any(path.endswith("source_span.start") for path in out):
        for path in [p for p in out if p.endswith("source_span")]:
            out[path].update(("start", "end"))
    return out
