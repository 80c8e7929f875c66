from pyspark.sql import functions as F

from corpusgate.operators import metrics
from corpusgate.plans import evaluation as ev
from corpusgate.plans.publication import publish
from tests.helpers import assumptions, claims, found
from tests.test_checks import small_corpus

SPAN = "struct<source_file:string,start:struct<page:int,offset:int>,end:struct<page:int,offset:int>>"
REPL = "array<struct<find:string,replace:string>>"


def inputs(spark):
    corpus = small_corpus(spark)
    corpus.cards = publish(corpus, "N")["theorem_cards"]
    gold = claims(spark, {"id": "c1"}, {"id": "c3"}, {"id": "z", "paper_id": "p9"})
    spans = gold.where("id = 'c1'").select("paper_id", F.col("id").alias("claim_id"), "source_span")
    return ev.EvalInputs(
        corpus, gold, assumptions(spark, {"id": "a"}), spans,
        spark.createDataFrame([("p1", "c1"), ("p1", "c2"), ("p7", "x")], "paper_id string, id string"),
        spark.createDataFrame([("p1", "c1", "one"), ("p1", "c1", "wrong"), ("p8", "c1", "one")], "paper_id string, claim_id string, short_decl string"),
        spark.createDataFrame(
            [("p1", "e1", "formal/N/S.lean", "proof_repair", [("theorem one", "lemma one")]), ("p1", "e2", "formal/N/S.lean", "proof_repair", [("theorem", "x")]),
             ("p1", "e3", "other/x", "new_theorem", [("a", "b")]), ("p1", "e4", "formal/N/S.lean", "new_theorem", [])],
            f"paper_id string, proposal_id string, target_file string, edit_kind string, replacements {REPL}",
        ),
        spark.createDataFrame(
            [("claim", "p1", "accepted", 40.0), ("mapping", "p1", "rejected", 99.0), ("edit", "p1", None, None)],
            "kind string, paper_id string, decision string, reviewer_seconds double",
        ),
    )


def test_scorers_and_thresholds(spark):
    actuals, times = ev.run_scorers(inputs(spark))
    got = {(r["task"], r["metric"]): r["value"] for r in actuals.collect()}
    want = {
        ("extraction", "claim_count"): 2, ("extraction", "claims_with_source_span"): 2, ("extraction", "paper_count"): 1, ("extraction", "assumption_count"): 0,
        ("mapping", "mapped_claims"): 2, ("mapping", "total_claims"): 2, ("mapping", "paper_count"): 1,
        ("theorem_cards", "declaration_count"): 2, ("theorem_cards", "machine_checked_count"): 1, ("theorem_cards", "paper_count"): 1,
        ("gold", "papers_with_gold"): 2, ("gold", "gold_claim_precision"): 0.5, ("gold", "gold_claim_recall"): 1 / 3, ("gold", "gold_claim_f1"): 0.4,
        ("gold", "source_span_total_compared"): 1, ("gold", "source_span_alignment_error_count"): 0,
        ("edit_suggestions", "proposals"): 4, ("edit_suggestions", "with_replacements"): 3, ("edit_suggestions", "conversion_ready"): 2,
        ("reference_eval", "gold_claim_id_recall_micro"): 0.5, ("reference_eval", "gold_claim_id_precision_micro"): 0.5,
        ("reference_eval", "mapping_tp"): 1, ("reference_eval", "mapping_keys_precision_micro"): 0.5, ("reference_eval", "mapping_keys_recall_micro"): 0.5,
        ("reference_eval", "edit_conversion_ready"): 1, ("reference_eval", "acceptance_rate"): 0.5, ("reference_eval", "reviewer_seconds"): 40, ("reference_eval", "reviewer_observations"): 1,
    }
    for key, value in want.items():
        assert abs(got[key] - value) < 1e-9, key
    limits = metrics.threshold_table(spark, {"gold": {"gold_claim_recall": 0.9}, "mapping": {"mapped_claims": 2}}, {"gold": {"source_span_alignment_error_rate": 0}})
    assert found(metrics.regression_check(actuals, limits, times, 1000.0), "task", "metric") == [("gold", "gold_claim_recall")]


def test_empty_bundles_and_empty_gold_lists_count(spark):
    x = inputs(spark)
    x.bundles = x.bundles.unionByName(spark.createDataFrame([("claim", "p9", None, None)], x.bundles.schema))
    got = {r["metric"]: r["value"] for r in ev.reference_eval(x).collect()}
    assert abs(got["gold_claim_id_recall_micro"] - 1 / 3) < 1e-9  # the gold of p9 was asked for
    x.corpus.assumptions = assumptions(spark, {"id": "a"}, {"id": "b", "paper_id": "p9"}, {"id": "c", "paper_id": "p0"})
    got = {r["metric"]: r["value"] for r in ev.gold(x).collect()}
    assert got["gold_assumption_precision"] == 0.5  # b is false, c belongs to a paper that is not scored


def test_a_failing_scorer_is_reported(spark):
    def broken(x):
        return x.corpus.claims.select("no_such_column")

    actuals, _ = ev.run_scorers(inputs(spark), {"broken": broken, "mapping": ev.mapping})
    rows = {(r["task"], r["metric"]) for r in actuals.collect()}
    assert ("broken", "error") in rows and ("mapping", "paper_count") in rows


def test_release_and_overview(spark):
    corpus = small_corpus(spark)
    row = ev.release_delta(corpus).first()
    assert (row["papers"], row["claims"], row["declarations"], row["tested_kernels"]) == (1, 2, 2, 1)
    got = ev.manifest_overview(corpus.manifests)
    assert sorted((r["paper_id"] or "", r["is_total"], r["machine_checked"], r["edges"]) for r in got.collect()) == [("", 1, 1, 0), ("p1", 0, 1, 0)]
