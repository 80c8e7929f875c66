"""Benchmark scorers over a corpus and the regression check on their metrics.

A scorer is a function from :class:`EvalInputs` to ``(task, metric, value)`` rows; register another by
adding it to ``SCORERS`` or passing a dictionary of your own.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.functions import aggregates as agg
from corpusgate.functions import columns as c
from corpusgate.operators import documents, linking, metrics
from corpusgate.plans.publication import Corpus
from corpusgate.session import constant_rows


@dataclass
class EvalInputs:
    """A corpus, its gold tables and the exploded entries of reviewed proposal bundles.

    ``claim_proposals`` is ``(paper_id, id)``, ``mapping_proposals`` ``(paper_id, claim_id, short_decl)``,
    ``edit_proposals`` ``(paper_id, proposal_id, target_file, edit_kind, replacements)`` and ``bundles``
    ``(kind, paper_id, decision, reviewer_seconds)``.
    """

    corpus: Corpus
    gold_claims: DataFrame
    gold_assumptions: DataFrame
    gold_spans: DataFrame
    claim_proposals: DataFrame
    mapping_proposals: DataFrame
    edit_proposals: DataFrame
    bundles: DataFrame


Scorer = Callable[[EvalInputs], DataFrame]


def _count(df: DataFrame) -> F.Column:
    return df.agg(F.count(F.lit(1))).scalar()


def extraction(x: EvalInputs) -> DataFrame:
    """Papers, claims, claims with any span and assumptions."""
    out = x.corpus.claims.agg(
        F.count(F.lit(1)).alias("claim_count"),
        F.count_if(F.col("source_span").isNotNull()).alias("claims_with_source_span"),
    )
    out = out.withColumn("paper_count", _count(x.corpus.papers)).withColumn("assumption_count", _count(x.corpus.assumptions))
    return metrics.metric_rows(out, "extraction", out.columns)


def mapping(x: EvalInputs) -> DataFrame:
    """Papers with a mapping, mapped entries and claims of those papers."""
    mapped = x.corpus.mapping.select("paper_id", F.size("claim_to_decl").alias("n"))
    out = mapped.agg(F.count(F.lit(1)).alias("paper_count"), F.sum("n").alias("mapped_claims"))
    claims = x.corpus.claims.join(mapped, "paper_id", "left_semi")
    out = out.withColumn("total_claims", _count(claims))
    return metrics.metric_rows(out, "mapping", out.columns)


def theorem_cards(x: EvalInputs) -> DataFrame:
    """Papers with cards, declarations and checked declarations."""
    out = metrics.checked_fraction(x.corpus.cards, "proof_status")
    out = out.withColumn("paper_count", x.corpus.cards.agg(F.count_distinct("paper_id")).scalar())
    return metrics.metric_rows(out, "theorem_cards", out.columns)


def gold(x: EvalInputs) -> DataFrame:
    """Precision, recall and F1 of claims and assumptions by id, and span alignment."""
    scored = x.gold_claims.select("paper_id").distinct()
    found = []
    for name, pred, ref in (
        ("claim", x.corpus.claims, x.gold_claims),
        ("assumption", x.corpus.assumptions, x.gold_assumptions),
    ):
        # Papers without gold claims are not scored at all; scored ones keep their false positives.
        counts = metrics.match_gold(pred, ref, ["paper_id"], "id", scored)
        prf = metrics.prf_micro(counts).select(
            *[F.col(m).alias(f"gold_{name}_{m}") for m in ("precision", "recall", "f1")]
        )
        found.append(metrics.metric_rows(prf, "gold", prf.columns))
    spans = linking.align_spans(
        x.corpus.claims.withColumn("claim_id", F.col("id")), x.gold_spans, ["paper_id", "claim_id"]
    ).select(
        F.col("total_compared").alias("source_span_total_compared"),
        F.col("alignment_error_count").alias("source_span_alignment_error_count"),
        F.col("alignment_error_rate").alias("source_span_alignment_error_rate"),
    )
    papers = scored.agg(F.count(F.lit(1)).alias("papers_with_gold"))
    found += [metrics.metric_rows(spans, "gold", spans.columns), metrics.metric_rows(papers, "gold", papers.columns)]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.where("value is not null")


def suggestions(x: EvalInputs) -> DataFrame:
    """Links of claims that are still unresolved."""
    out = x.corpus.claims.agg(
        F.coalesce(F.sum(c.count_items("linked_assumptions_unresolved")), F.lit(0)).alias("unresolved_assumption_links"),
        F.coalesce(F.sum(c.count_items("linked_symbols_unresolved")), F.lit(0)).alias("unresolved_symbol_links"),
    )
    return metrics.metric_rows(out, "suggestions", out.columns)


def edit_suggestions(x: EvalInputs) -> DataFrame:
    """Edit proposals in all, with replacements and ready by the path rule."""
    per = metrics.proposal_footprint(x.edit_proposals, "edit_kind", F.size("replacements"), "target_file")
    names = ["proposals", "with_replacements", "conversion_ready"]
    out = per.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return metrics.metric_rows(out, "edit_suggestions", out.columns)


def reference_eval(x: EvalInputs) -> DataFrame:
    """Reviewed bundles against gold claims, stored mappings and source texts; decisions and time.

    Measures with nothing to compare stay at 1. Reviewing time counts claim bundles only. The gold of a
    paper counts when it has a bundle, with or without proposals in it.
    """
    def offered_in(kind: str, proposals: DataFrame) -> DataFrame:
        own = x.bundles.where(F.col("kind") == kind).select("paper_id")
        return own.unionByName(proposals.select("paper_id")).distinct()

    with_gold = x.gold_claims.select("paper_id").distinct()
    offered = x.claim_proposals.join(with_gold, "paper_id", "left_semi")
    asked = x.gold_claims.join(offered_in("claim", x.claim_proposals), "paper_id", "left_semi")
    counts = metrics.match_gold(offered, asked, ["paper_id"], "id")
    total = counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("tp", "n_pred", "n_gold")])
    claims = total.select(
        F.col("tp").alias("gold_claim_id_hits"),
        c.ratio("tp", "n_gold", 1.0).alias("gold_claim_id_recall_micro"),
        c.ratio("tp", "n_pred", 1.0).alias("gold_claim_id_precision_micro"),
        c.f1(c.ratio("tp", "n_pred", 1.0), c.ratio("tp", "n_gold", 1.0)).alias("gold_claim_id_f1_micro"),
    )
    stored = x.corpus.mapping.select("paper_id", F.explode("claim_to_decl").alias("claim_id", "short_decl"))
    entries = metrics.evaluate_entries(
        x.mapping_proposals, stored, ["paper_id", "claim_id"], "short_decl", "paper_id", offered_in("mapping", x.mapping_proposals)
    ).select(
        F.col("tp").alias("mapping_tp"),
        *[F.col(m).alias(f"mapping_keys_{m}_micro") for m in ("precision", "recall", "f1")],
        F.col("disagreement").alias("mapping_disagreement_rate_micro"),
    )
    ready = documents.edit_ready(x.edit_proposals, x.corpus.docs).agg(F.count(F.lit(1)).alias("edit_conversion_ready"))
    timed = x.bundles.withColumn("__s", F.when(F.col("kind") == "claim", F.col("reviewer_seconds")))
    review = metrics.decision_counts(timed, "decision", "__s")
    out = None
    for frame in (claims, entries, ready, review):
        rows = metrics.metric_rows(frame, "reference_eval", frame.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


SCORERS: dict[str, Scorer] = {
    "extraction": extraction,
    "mapping": mapping,
    "theorem_cards": theorem_cards,
    "gold": gold,
    "suggestions": suggestions,
    "edit_suggestions": edit_suggestions,
    "reference_eval": reference_eval,
}


def run_scorers(x: EvalInputs, scorers: Mapping[str, Scorer] | None = None) -> tuple[DataFrame, DataFrame]:
    """Metric rows of all scorers and the seconds each took; a scorer that fails leaves an ``error`` row.

    Each scorer's result is a handful of metrics, so they are brought together as constants.
    """
    spark = x.corpus.claims.sparkSession
    rows, times = [], []
    for task, scorer in (scorers or SCORERS).items():
        start = time.perf_counter()
        try:
            rows += [(r["task"], r["metric"], r["value"], None) for r in scorer(x).collect()]
        except Exception as e:  # noqa: BLE001  whatever a scorer raises is a row of the result
            rows.append((task, "error", None, str(e)))
        times.append((task, round(time.perf_counter() - start, 2)))
    actuals = constant_rows(spark, rows, task="string", metric="string", value="double", note="string")
    return actuals, constant_rows(spark, times, task="string", value="double")


def release_delta(corpus: Corpus) -> DataFrame:
    """Papers, claims, listed declarations, tested kernels and one checksum over all manifests in order of their paper."""
    digests = corpus.manifests.select("paper_id", agg.row_digest("paper_id", F.to_json(F.struct("*"))).alias("d"))
    bundle = corpus.manifests.agg(F.sum(c.count_items("declaration_index")).alias("declarations"))
    return (
        bundle.withColumn("bundle_sha256", agg.ordered_checksum(digests, ["paper_id"], "d").select("checksum").scalar())
        .withColumn("papers", _count(corpus.papers))
        .withColumn("claims", _count(corpus.claims))
        .withColumn("kernels", _count(corpus.kernels))
        .withColumn("tested_kernels", _count(corpus.kernels.where("test_status = 'tested'")))
    )


def manifest_overview(manifests: DataFrame) -> DataFrame:
    """Checked claims, hash version and edges per paper, with a total row."""
    per = manifests.select(
        "paper_id",
        F.coalesce("coverage_metrics.machine_checked_count", F.lit(0)).alias("machine_checked"),
        c.count_items("dependency_graph").alias("edges"),
        F.coalesce("build_hash_version", F.lit("")).alias("build_hash_version"),
    )
    totals = metrics.with_totals(per, "paper_id", ["machine_checked", "edges"])
    return totals.join(per.select("paper_id", "build_hash_version"), "paper_id", "left")
