"""All checks over a corpus: every violation as a row, and a report with the first one per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgate import schemas
from corpusgate.operators import checks, shapes
from corpusgate.plans.publication import Corpus


def schema_violations(corpus: Corpus) -> DataFrame:
    """Conformance of the eight stored entities, with kernel witness and contract rules.

    Where a table has the stored JSON (``raw``), types and unknown or missing fields are checked at every depth.
    """
    tables = {
        "metadata": (corpus.papers, "paper_id", "id"),
        "claims": (corpus.claims, "paper_id", "id"),
        "assumptions": (corpus.assumptions, "paper_id", "id"),
        "symbols": (corpus.symbols, "paper_id", "id"),
        "mapping": (corpus.mapping, "paper_id", "paper_id"),
        "theorem_cards": (corpus.cards, "paper_id", "id"),
        "manifest": (corpus.manifests, "paper_id", "paper_id"),
    }
    found = [x for entity, (df, group, row) in tables.items() for x in _stored(entity, df, group, row, schemas.RULES[entity])]
    kernels = corpus.kernels.withColumn("corpus", F.lit(""))
    found += _stored("kernels", kernels, "corpus", "id", schemas.RULES["kernels"])
    found.append(checks.kernel_witness(corpus.kernels))
    found.append(checks.kernel_contract(corpus.kernels))
    return checks.union_all(found)


def _stored(entity: str, df: DataFrame, group: str, row: str, rules: list[schemas.Rule], **kw: str) -> list[DataFrame]:
    """Value rules on the typed fields and, where the stored JSON is at hand, its shape."""
    if "raw" not in df.columns:
        return [checks.conformance_violations(entity, df, rules, group, row, **kw)]
    typed = [r for r in rules if r.kind != "required"]  # the shape tells which fields are missing
    return [shapes.shape_violations(entity, df, group, row, **kw), checks.conformance_violations(entity, df, typed, group, row, **kw)]


def all_violations(
    corpus: Corpus,
    snapshots: DataFrame | None = None,
    sidecars: dict[str, DataFrame] | None = None,
    year_now: Column | None = None,
) -> DataFrame:
    """Every finding of every check."""
    k = corpus
    found = [
        schema_violations(k),
        checks.normalization_integrity(k.claims, k.assumptions, k.symbols),
        checks.provenance(k.papers, k.claims, k.manifests, k.mapping),
        checks.graph_integrity(k.claims, k.assumptions, k.symbols, k.mapping, k.cards, k.manifests, k.kernels),
        checks.claim_value_policy(k.claims),
        checks.lifecycle(k.claims),
        checks.card_review(k.cards),
        checks.coverage_integrity(k.manifests, k.claims, k.cards),
        checks.graph_bootstrap_warning(k.cards, k.claims),
        checks.graph_quality_warning(k.cards),
        checks.missing_identifier(k.papers, F.year(F.current_date()) if year_now is None else year_now),
    ]
    if k.runs is not None:
        found.append(checks.extraction_run_required(k.claims, k.runs))
    if snapshots is not None:
        found.append(checks.snapshot_quality(snapshots))
    for kind, df in (sidecars or {}).items():
        found += _stored(kind, df, "paper_id", "paper_id", schemas.SIDECAR_RULES[kind], severity="warn", check_id="suggestion_sidecars")
    return checks.union_all(found)


def run_gates(corpus: Corpus, **kwargs) -> tuple[DataFrame, DataFrame]:
    """``(violations, report)``; feed the report to :func:`checks.verdict` for the overall answer."""
    found = all_violations(corpus, **kwargs)
    return found, checks.gate_report(found)
