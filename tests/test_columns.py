import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusgate.functions import columns as c


def one(spark, expr, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text,want",
    [("  Théta--2 ", "th_ta_2"), ("___", "symbol"), ("", "symbol"), ("Ab C", "ab_c")],
)
def test_canonical_name(spark, text, want):
    assert one(spark, c.canonical_name("t"), t=text) == want


@pytest.mark.parametrize("text,want", [("3 x", "c_3_x"), ("--", "unnamed"), ("Good Name", "good_name")])
def test_identifier(spark, text, want):
    assert one(spark, c.identifier("t"), t=text) == want


def test_namespace_forms(spark):
    plain = c.default_namespace("t", "Corpus.Papers", "adsorption", "Corpus.Chem")
    assert one(spark, plain, t="some-paper.v1") == "Corpus.Papers.some_paper_v1"
    assert one(spark, plain, t="big_gas_1918_adsorption") == "Corpus.Chem.BigGas19181918"
    assert one(spark, plain, t="gas_adsorption") == "Corpus.Chem.GasPaper"


def test_target_path(spark):
    assert one(spark, c.target_path("n", "e"), n="A.B", e=" ") == "formal/A/B.lean"
    assert one(spark, c.target_path("n", "e"), n="A.B", e="x/y.lean") == "x/y.lean"
    assert one(spark, c.target_path("n"), n=" ") == ""


def test_short_name_preference(spark):
    df = spark.createDataFrame(
        [
            ([" ", "N.S.foo.bar"], "N.S", "p_claim_1"),
            (["Other.x.y"], "N.S", "p_claim_1"),
            (["plain"], "N.S", "p_claim_1"),
            ([], "N.S", "p_claim_1"),
            (None, "", "weird id"),
        ],
        "t array<string>, ns string, id string",
    )
    got = [r[0] for r in df.select(c.infer_short_name("t", "ns", "id")).collect()]
    assert got == ["foo.bar", "y", "plain", "claim_c_1", "claim_weird_id"]


def test_actions_in_order(spark):
    df = spark.createDataFrame(
        [("stubbed", "human_review_only"), ("mapped", "human_review_only"), ("machine_checked", "machine_checked_plus_axioms"),
         ("mapped", "x"), ("machine_checked", "fully_machine_checked")],
        "s string, b string",
    )
    got = [r[0] for r in df.select(c.suggested_action("s", "b")).collect()]
    assert got == [
        "consider_completing_proof", "consider_machine_verification", "consider_axiom_reduction",
        "consider_completing_proof", "consider_review",
    ]
    assert [r[0] for r in df.select(c.needs_repair("s", "b")).collect()] == [True, True, True, True, False]


def test_empty_and_missing_links_are_equal(spark):
    df = spark.createDataFrame([(None,), ([],), (["a"],)], "l array<string>")
    assert [r[0] for r in df.select(c.has_items("l")).collect()] == [False, False, True]


def test_unit_from_text(spark):
    assert one(spark, c.unit_from_text("t"), t="K in [1/Pa] units") == "1/Pa"
    assert one(spark, c.unit_from_text("t"), t="K and P non-negative in x") is None
    assert one(spark, c.unit_from_text("t"), t="coverage dimensionless") is None


def test_json_object_text(spark):
    assert one(spark, c.json_object_text("t"), t='say ```json\n{"a": {"b": 1}}\n``` bye }') == '{"a": {"b": 1}}'
    assert one(spark, c.json_object_text("t"), t='x {"a": 1} y') == '{"a": 1}'
    assert one(spark, c.json_object_text("t"), t="} {") is None


def test_digests(spark):
    assert one(spark, c.fnv1a_hex("t"), t="abc") == "1a47e90b"
    assert one(spark, c.fnv1a_hex("t"), t="") == "811c9dc5"
    assert one(spark, c.sha256("t"), t="é") == hashlib.sha256("é".encode()).hexdigest()


def test_numbers(spark):
    assert one(spark, c.saturating_ratio("k", "p"), k=-1.0, p=1.0) == 0.0
    assert one(spark, c.saturating_ratio("k", "p"), k=1.25, p=4.0) == pytest.approx(5 / 6)
    assert one(spark, c.power_law("k", "c", "n"), k=1.1, c=4.0, n=2.0) == pytest.approx(2.2)
    for bad in ((1.0, 0.0, 2.0), (1.0, 1.0, 0.0), (float("inf"), 1.0, 1.0)):
        assert math.isnan(one(spark, c.power_law("k", "c", "n"), k=bad[0], c=bad[1], n=bad[2]))
    assert one(spark, c.is_close("a", "b"), a=1.0, b=1.0 + 1e-10)
    assert not one(spark, c.is_close("a", "b"), a=1.0, b=1.001)


def test_jaccard_of_empty_sets_is_zero(spark):
    df = spark.createDataFrame([([], []), (["a", "a"], ["a", "b"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(c.jaccard("a", "b")).collect()] == [0.0, 0.5]


def test_rank_of_unknown_status_is_lowest(spark):
    df = spark.createDataFrame([("linked_to_kernel",), ("disputed",), ("odd",), (None,)], "s string")
    assert [r[0] for r in df.select(c.status_rank("s")).collect()] == [6, -1, -2, -2]


def test_seconds_between_skips_unreadable_instants(spark):
    df = spark.createDataFrame([("2020-01-01T00:00:00Z", "2020-01-01T00:01:00Z"), ("soon", "2020-01-01T00:01:00Z")], "a string, b string")
    assert [r[0] for r in df.select(c.seconds_between("a", "b")).collect()] == [60.0, None]
