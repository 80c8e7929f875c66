from pyspark.sql import functions as F

from corpusgate.operators import documents as d
from corpusgate.operators import symbols as sy
from tests.helpers import found, rows
from corpusgate import schemas

SOURCE = """/- block theorem fake : T := by x -/
@[simp]
theorem first : T := by
  simp
-- theorem commented : T := by first
lemma second (h : A)
    : T := by ring
def shape : N → N
| 0 => 1
noncomputable def third' := Core
theorem fourth : T := by
  unfold sec
  exact Core + first + Root.Ns.second
end Root
trailing first
"""


def docs(spark, text=SOURCE, path="formal/A.lean"):
    return spark.createDataFrame([(path, text)], "path string, text string")


def test_segments_follow_the_source(spark):
    clean = docs(spark).select("path", d.strip_comments(F.col("text")).alias("text"))
    got = {r["name"]: r for r in d.segments(clean, "path", "text").collect()}
    assert list(sorted(got, key=lambda n: got[n]["pos"])) == ["first", "second", "shape", "third'", "fourth"]
    assert got["first"]["body"].strip() == "by\n  simp"
    assert got["second"]["body"].strip() == "by ring" and got["second"]["previous"] == "first"
    assert got["shape"]["body"].strip() == "Core"
    assert "trailing" not in got["fourth"]["body"] and got["fourth"]["previous"] == "third'"


def test_dependencies_by_kind(spark):
    names = ["first", "second", "third'", "fourth"]
    cards = spark.createDataFrame(
        [("p", i, f"c{i}", f"Root.Ns.{n}", "formal/A.lean") for i, n in enumerate(names)], "paper_id string, pos int, id string, lean_decl string, file_path string"
    )
    got = found(d.dependency_edges(cards, docs(spark), "Root"), "card_id", "dependency_id", "tier")
    assert got == [("c1", "c0", 0), ("c3", "c0", 0), ("c3", "c1", 1), ("c3", "c2", 1)]
    full = d.with_dependencies(cards, d.dependency_edges(cards, docs(spark), "Root"))
    assert found(full, "id", "dependency_ids", "dependency_extraction_method") == [
        ("c0", [], "lean_source_regex_tier0"), ("c1", ["c0"], "lean_source_regex_tier0"),
        ("c2", [], "lean_source_regex_tier0"), ("c3", ["c0", "c1", "c2"], "lean_source_regex_tier1"),
    ]


def test_ambiguous_names_are_not_resolved(spark):
    text = "theorem a : T := by\n  exact b\ntheorem b : T := by simp\n"
    cards = spark.createDataFrame(
        [("p", 0, "c0", "N.a", "f"), ("p", 1, "c1", "N.b", "f"), ("p", 2, "c2", "M.b", "g")], "paper_id string, pos int, id string, lean_decl string, file_path string"
    )
    assert d.dependency_edges(cards, docs(spark, text, "f"), "Root").count() == 0


def test_macros_first_definition_wins(spark):
    text = r"\newcommand{\foo}[2]{a{b}c} \newcommand{ \foo }{later} \def\bar{x} \def\foo{y}"
    assert found(d.macro_definitions(docs(spark, text), "path", "text"), "name", "definition") == [("bar", "x"), ("foo", "a{b}c")]


def test_markdown_rows(spark):
    text = "| Claim ID | decl |\n|---|---|\n| c1 | `a_b` |\n|c2|x|y|\n| only |\ntext | c3 | z |\n| c1 | `last` |"
    assert found(d.markdown_pairs(docs(spark, text), "path", "text"), "key", "value") == [("c1", "last"), ("c2", "x")]


def test_headings_keep_their_number(spark):
    html = "<h1>One <b>x</b></h1><p>a</p><h2> </h2><h3 class='q'>Three</h3>$x_1 + \\alpha$ tail"
    sections = d.headings(docs(spark, html), "path", "text")
    assert found(sections, "section", "informal_text") == [(1, "One x"), (3, "Three")]
    got = d.section_formulas(sections, ["section"], "body").where("section = 3").first()
    assert got["candidate_equations"] == ["x_1 + \\alpha"] and got["candidate_symbols"] == ["alpha"]


def test_formula_symbols_order_and_cap(spark):
    df = spark.createDataFrame([(r"\theta = K P / (1 + K P) \theta",)], "f string")
    assert df.select(d.formula_symbols(F.col("f"))).first()[0] == ["theta", "theta", "K", "P", "K", "P"][:0] + ["theta", "theta", "K", "P"]
    assert df.select(d.formula_symbols(F.col("f"), 1)).first()[0] == ["theta"]


def test_replacements_need_one_match(spark):
    texts = spark.createDataFrame([("formal/a", "one two two"), ("formal/b", "x"), ("formal/c", "k")], "path string, text string")
    patches = spark.createDataFrame(
        [("formal/a", 0, "one", "two"), ("formal/a", 1, "two two two", "three"), ("formal/b", 0, "y", ""), ("formal/c", 0, "k", "k")],
        "path string, seq int, find string, replace string",
    )
    got = {r["path"]: (r["new_text"], r["rejected"], r["modified"]) for r in d.apply_replacements(texts, "path", "text", patches).collect()}
    assert got == {"formal/a": ("three", False, True), "formal/b": ("x", True, False), "formal/c": ("k", False, False)}
    more = patches.unionByName(
        spark.createDataFrame([("formal/../x", 0, "a", "b"), ("other", 0, "a", "b"), ("formal/zz", 0, "a", "b"), ("formal/a", 2, "two", ""), ("formal/a", 3, "", "")], patches.schema)
    )
    got = found(d.replacement_issues(texts, "path", "text", more, root="formal/"), "path", "seq", "issue")
    assert got == [
        ("formal/../x", 0, "unsafe_path"), ("formal/a", 1, "not_found"), ("formal/a", 2, "not_unique"), ("formal/a", 3, "empty_find"),
        ("formal/b", 0, "not_found"), ("formal/zz", 0, "missing_document"), ("other", 0, "unsafe_path"),
    ]


def test_replacements_of_odd_rows(spark):
    texts = spark.createDataFrame([(1, "ab"), (2, None), (3, ""), (4, "aaa"), (4, "xaa"), (None, "ab"), (5, "ab"), (6, "a")], "k long, text string")
    patches = spark.createDataFrame(
        [(1, 1, "b", "c"), (1, 1, "a", None), (2, 0, "a", "b"), (3, 0, "a", "b"), (4, 0, "aa", "b"), (None, 0, "a", "z"), (5, 0, None, "z"), (9, 0, "a", "z"), (5, 1, "a", "z")],
        "k long, seq int, find string, replace string",
    )
    got = found(d.apply_replacements(texts, "k", "text", patches).fillna("null"), "k", "new_text", "rejected", "modified")
    assert got == [(1, "c", False, True), (2, "null", True, False), (3, "", True, False), (4, "ba", False, True), (4, "xb", False, True), (5, "ab", True, False)]
    assert d.apply_replacements(texts, "k", "text", patches.limit(0)).count() == 0


def test_a_document_takes_any_number_of_replacements(spark):
    n = 20_000
    patches = spark.range(n).selectExpr("'d' AS doc", "id AS seq", "concat('<', id, '>') AS find", "concat('(', id, ')') AS replace")
    texts = spark.createDataFrame([("d", "".join(f"<{i}>" for i in range(n))), ("e", "<1>")], "doc string, text string")
    out = d.apply_replacements(texts, "doc", "text", patches.repartition(7)).collect()
    assert [r["doc"] for r in out] == ["d"] and not out[0]["rejected"]
    assert out[0]["new_text"] == "".join(f"({i})" for i in range(n))


def test_keywords_are_whole_words(spark):
    df = spark.createDataFrame([("a", "sorry, sorry_x xsorry sorry"), ("b", "none"), ("c", "axiom")], "f string, t string")
    assert found(d.keyword_counts(df, "f", "t", ["axiom", "sorry"]), "f", "axiom", "sorry") == [("a", 0, 2), ("c", 1, 0)]
    total = d.keyword_totals(df, "t", ["axiom", "sorry"]).first()
    assert (total["files_scanned"], total["axiom"], total["sorry"]) == (3, 1, 2)


def symbols(spark, *items):
    return rows(spark, "pos int, " + schemas.SYMBOL, *[{"paper_id": "p1", "pos": i} | x for i, x in enumerate(items)])


def test_symbol_normalization_flags_later_holders(spark):
    df = symbols(
        spark, {"id": "a", "normalized_name": "Theta"}, {"id": "b", "raw_latex": "theta", "ambiguity_flags": ["role_unclear", ""]},
        {"id": "c", "dimensional_metadata": {"kind": None, "unit": "m", "dimension": None}}, {"id": ""},
    )
    out = sy.normalize_symbols(df)
    assert found(out, "id", "normalized_name", "ambiguity_flags") == [("a", "theta", []), ("b", "theta", ["overloaded_symbol", "role_unclear"]), ("c", "c", [])]
    assert found(out.select("id", "dimensional_metadata.*"), "id", "kind", "unit") == [("a", "unknown", ""), ("b", "unknown", ""), ("c", "unknown", "m")]


def test_ambiguity_suggested_and_applied(spark):
    dim = {"kind": None, "unit": "", "dimension": "length"}
    df = symbols(
        spark, {"id": "a", "normalized_name": "x", "ambiguity_flags": ["bogus", "scope_unclear"]}, {"id": "b", "normalized_name": "x", "dimensional_metadata": dim},
        {"id": "c", "normalized_name": "y", "ambiguity_flags": ["role_unclear"]}, {"id": "d", "normalized_name": ""}, {"id": "e", "normalized_name": ""},
    )
    assert found(sy.suggest_ambiguity(df), "id", "suggested_flags") == [
        ("a", ["scope_unclear", "overloaded_symbol"]), ("b", ["overloaded_symbol", "unit_unclear"]), ("c", ["role_unclear"])
    ]
    applied = sy.apply_ambiguity(df)
    assert found(applied.where("changed"), "id", "ambiguity_flags") == [("a", ["overloaded_symbol", "scope_unclear"]), ("b", ["overloaded_symbol", "unit_unclear"])]


def test_vocabulary_only_for_papers_without_symbols(spark):
    cl = spark.createDataFrame([("p-1", 0, "Gas law"), ("p-2", 0, "other words")], "paper_id string, pos int, informal_text string")
    have = spark.createDataFrame([("p-2",)], "paper_id string")
    assert found(sy.extract_symbols(cl, have), "paper_id", "pos", "id", "raw_latex") == [("p-1", 0, "p_1_sym_gas", "Gas"), ("p-1", 1, "p_1_sym_law", "law")]


def test_dimension_suggestions_in_constraint_order(spark):
    df = symbols(spark, {"id": "a", "normalized_name": "K"}, {"id": "b", "normalized_name": "al_pha"}, {"id": "c", "normalized_name": "cov"}, {"id": "d", "normalized_name": "zz"},
                 {"id": "e", "normalized_name": "K", "dimensional_metadata": {"kind": "x", "unit": "", "dimension": ""}})
    texts = spark.createDataFrame([(0, "K and P non-negative"), (1, "k measured in [1/Pa]"), (2, "cov dimensionless"), (3, "cov in m")], "pos int, text string")
    assert found(sy.dimension_suggestions(df, texts), "id", "suggested", "source") == [
        ("a", "unit=1/Pa", "kernel"), ("b", "dimension=dimensionless,kind=dimensionless", "heuristic"), ("c", "dimension=dimensionless", "kernel")
    ]


def test_a_reference_to_itself_counts_for_the_method_only(spark):
    text = "theorem a : T := by simp\ntheorem b : T := by\n  have := N.b\n  exact a\n"
    cards = spark.createDataFrame(
        [("p", 0, "c0", "N.a", "f"), ("p", 1, "c1", "N.b", "f")], "paper_id string, pos int, id string, lean_decl string, file_path string"
    )
    assert found(d.dependency_edges(cards, docs(spark, text, "f"), "N"), "card_id", "dependency_id", "tier") == [("c1", "c0", 0)]
    full = d.with_dependencies(cards, d.dependency_edges(cards, docs(spark, text, "f"), "N", keep_self=True))
    assert found(full, "id", "dependency_ids", "dependency_extraction_method") == [
        ("c0", [], "lean_source_regex_tier0"), ("c1", ["c0"], "lean_source_regex_tier1"),
    ]


def test_no_table_of_cards_is_broadcast(spark, monkeypatch, tmp_path):
    # stored steps would hide their joins from the plan
    monkeypatch.setattr(d, "durable", lambda df, name: df)
    cards = spark.createDataFrame(
        [("p", 0, "c0", "N.a", "f"), ("p", 1, "c1", "N.b", "f")], "paper_id string, pos int, id string, lean_decl string, file_path string"
    )
    cards.write.parquet(f"{tmp_path}/cards")
    docs(spark, "theorem a : T := by simp\ntheorem b : T := by\n  unfold a\n", "f").write.parquet(f"{tmp_path}/docs")
    cards, texts = spark.read.parquet(f"{tmp_path}/cards"), spark.read.parquet(f"{tmp_path}/docs")
    full = d.with_dependencies(cards, d.dependency_edges(cards, texts, "N"))
    assert found(full, "id", "dependency_ids") == [("c0", []), ("c1", ["c0"])]
    plan = full._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan
