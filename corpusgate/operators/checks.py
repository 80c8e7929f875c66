"""Declarative checks. Each returns violation rows instead of stopping at the first one.

Columns: ``gate, check_id, severity, group_id, row_id, message, at``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgate.functions import columns as c
from corpusgate.operators import linking, metrics, similarity
from corpusgate.schemas import Rule
from corpusgate.session import constant_rows, durable

VIOLATION = ["gate", "check_id", "severity", "group_id", "row_id", "message", "at"]

# The checks in the order they are judged.
GATE_ORDER = [
    ("gate2", "json_schemas_and_kernels", "error"),
    ("gate2", "normalization_integrity", "error"),
    ("gate3", "provenance_integrity", "error"),
    ("gate2", "extraction_run_required", "error"),
    ("gate2", "graph_integrity", "error"),
    ("gate2", "claim_value_policy", "error"),
    ("gate2", "reviewer_lifecycle", "error"),
    ("gate2", "theorem_card_reviewer", "error"),
    ("gate4", "coverage_integrity", "error"),
    ("gate2", "snapshot_quality", "warn"),
    ("gate2", "dependency_graph_bootstrap", "warn"),
    ("gate2", "dependency_graph_quality", "warn"),
    ("gate2", "suggestion_sidecars", "warn"),
    ("gate2", "missing_identifier_hint", "hint"),
]


def violations(
    rows: DataFrame, check_id: str, group: Column | str, row: Column | str, message: Column | str,
    gate: str = "gate2", severity: str = "error",
) -> DataFrame:
    """Failing rows in the common violation shape.

    ``at`` is the list position of the row in its group where ``rows`` carries one as ``pos``, else null.
    """
    at = F.col("pos").cast("long") if listed_at(rows) else F.lit(None).cast("long")
    as_col = lambda x: F.col(x) if isinstance(x, str) else x
    return rows.select(
        F.lit(gate).alias("gate"),
        F.lit(check_id).alias("check_id"),
        F.lit(severity).alias("severity"),
        F.coalesce(as_col(group).cast("string"), F.lit("")).alias("group_id"),
        F.coalesce(as_col(row).cast("string"), F.lit("?")).alias("row_id"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
        at.alias("at"),
    )


def listed_at(df: DataFrame) -> list[str]:
    """The column of the list position, if there is one: ``pos`` of a whole number type."""
    return [x for x, kind in df.dtypes if x == "pos" and kind in ("tinyint", "smallint", "int", "bigint")]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- conformance ------------------------------------------------------------------------------


def _broken(rule: Rule) -> Column:
    f = F.col(rule.field)
    kind, arg = rule.kind, rule.arg
    if kind == "required":
        bad = f.isNull()
    elif kind == "filled":
        bad = f == ""
    elif kind == "pattern":
        bad = ~f.rlike(arg)
    elif kind == "one_of":
        bad = ~f.isin(list(arg))
    elif kind == "at_least":
        bad = f < arg
    elif kind == "at_most":
        bad = f > arg
    elif kind == "min_items":
        bad = F.size(f) < arg
    elif kind == "items_pattern":
        bad = F.exists(f, lambda x: ~F.coalesce(x, F.lit("")).rlike(arg))
    elif kind == "items_one_of":
        bad = F.exists(f, lambda x: x.isNotNull() & ~x.isin(list(arg)))
    elif kind == "items_filled":
        bad = F.exists(f, lambda x: F.coalesce(x, F.lit("")) == "")
    else:
        raise ValueError(f"unknown rule kind {kind!r}")
    return F.coalesce(bad, F.lit(False))


def conformance(
    df: DataFrame, rules: Sequence[Rule], keep: Sequence[str], raw: str | None = None, allowed: Sequence[str] = ()
) -> DataFrame:
    """Broken rules as ``(keep…, field, rule)`` rows, found in one pass without a shuffle.

    With ``raw`` (the row's JSON text) and ``allowed`` field names, unknown fields are reported too.
    """
    hits = [
        F.when(_broken(r), F.struct(F.lit(r.field).alias("field"), F.lit(r.kind).alias("rule"))) for r in rules
    ]
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    if raw:
        extra = F.array_except(F.json_object_keys(raw), F.array(*[F.lit(a) for a in allowed]))
        unknown = F.transform(extra, lambda k: F.struct(k.alias("field"), F.lit("unknown_field").alias("rule")))
        empty = F.array().cast("array<struct<field:string,rule:string>>")
        found = F.concat(found, F.coalesce(unknown, empty))
    return df.select(*keep, F.inline(found))


def conformance_violations(entity: str, df: DataFrame, rules: Sequence[Rule], group: str, row: str, severity: str = "error", check_id: str = "json_schemas_and_kernels", **kw) -> DataFrame:
    keep = [*dict.fromkeys([group, row]), *listed_at(df)]
    rows = conformance(df, rules, keep, **kw)
    return violations(
        rows, check_id, group, row, F.concat(F.lit(f"{entity}."), "field", F.lit(" breaks "), "rule"), severity=severity
    )


# --- row rules --------------------------------------------------------------------------------


def lifecycle(claims: DataFrame) -> DataFrame:
    """Claim status must be known; a disputed claim needs notes."""
    s = c.filled(c.strip("status"), "unparsed")
    issue = F.when(~s.isin(list(c.CLAIM_STATUSES)), F.concat(F.lit("invalid status "), s)).when(
        (s == "disputed") & ~c.not_blank("review_notes"), "disputed without review_notes"
    )
    rows = claims.withColumn("issue", issue).where("issue is not null")
    return violations(rows, "reviewer_lifecycle", "paper_id", "id", F.col("issue"))


def card_review(cards: DataFrame) -> DataFrame:
    """Reviewer status required and known; blocked needs notes; accepted needs a checked proof."""
    s = F.col("reviewer_status")
    issue = (
        F.when(s.isNull(), "reviewer_status is required")
        .when(~s.isin(list(c.REVIEWER_STATUSES)), F.concat(F.lit("invalid reviewer_status "), s))
        .when((s == "blocked") & ~c.not_blank("notes"), "blocked without notes")
        .when((s == "accepted") & ~F.coalesce(F.col("proof_status") == "machine_checked", F.lit(False)), "accepted but not machine_checked")
    )
    rows = cards.withColumn("issue", issue).where("issue is not null")
    return violations(rows, "theorem_card_reviewer", "paper_id", "id", F.col("issue"))


def kernel_witness(kernels: DataFrame) -> DataFrame:
    """A kernel that links cards must be tested."""
    status = F.coalesce(c.strip("test_status"), F.lit(""))
    rows = kernels.where(c.has_items("linked_theorem_cards") & (status != "tested"))
    return violations(
        rows, "json_schemas_and_kernels", F.lit(""), "id",
        F.concat(F.lit("linked kernel has test_status "), c.filled(status, "missing")),
    )


def kernel_contract(kernels: DataFrame) -> DataFrame:
    """Completeness of the contract of every tested, linked kernel; one row per broken rule."""
    io, con = F.col("io_typing"), F.col("contract_v1")
    none = F.array().cast("array<string>")

    def keys(side: Column) -> Column:
        return F.coalesce(F.map_keys(side), none)

    def names(side: Column) -> Column:
        return F.filter(F.coalesce(side["name"], none), lambda x: x != "")

    def same(a: Column, b: Column) -> Column:
        return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)

    units, domains, duty = con["units"], con["domains"], con["obligations"]
    linked = F.col("linked_theorem_cards")
    expected = F.coalesce(duty["expected_linked_theorem_cards"], none)
    satisfied = F.coalesce(duty["satisfied_linked_theorem_cards"], none)
    unsatisfied = F.coalesce(duty["unsatisfied_linked_theorem_cards"], none)

    def lacks_hint(b: Column) -> Column:
        dom = F.lower(F.coalesce(F.try_element_at(domains["inputs"], b["name"]), F.lit("")))
        nonneg = (b["numeric_kind"] == "nonnegative_float") & ~F.contains(dom, F.lit(">=")) & ~F.contains(dom, F.lit("≥"))
        pos = (b["numeric_kind"] == "positive_float") & ~F.contains(dom, F.lit(">"))
        return F.coalesce(nonneg | pos, F.lit(False))

    has_io = io.isNotNull() & io["inputs"].isNotNull() & io["outputs"].isNotNull()
    has_con = con.isNotNull()
    tests = {
        "missing io_typing": ~has_io,
        "missing contract_v1": ~has_con,
        "witness_type must be numerically_witnessed": has_con & ~F.coalesce(con["witness_type"] == "numerically_witnessed", F.lit(False)),
        "units must be non-empty": has_con & ((F.size(keys(units["inputs"])) == 0) | (F.size(keys(units["outputs"])) == 0)),
        "io names must match unit names": has_con & has_io & ~(same(names(io["inputs"]), keys(units["inputs"])) & same(names(io["outputs"]), keys(units["outputs"]))),
        "domain lacks a sign hint": has_con & has_io & F.exists(io["inputs"], lacks_hint),
        "domains must be non-empty": has_con & ((F.size(keys(domains["inputs"])) == 0) | (F.size(keys(domains["outputs"])) == 0)),
        "expected obligations must be non-empty": has_con & (F.size(expected) == 0),
        "expected obligations must equal linked cards": has_con & ~same(expected, linked),
        "satisfied obligations must equal linked cards": has_con & ~same(satisfied, linked),
        "unsatisfied obligations remain": has_con & (F.size(unsatisfied) > 0),
    }
    issues = F.filter(
        F.array(*[F.when(cond, text) for text, cond in tests.items()]), lambda x: x.isNotNull()
    )
    tested = kernels.where((c.strip("test_status") == "tested") & c.has_items("linked_theorem_cards"))
    rows = tested.select("id", *listed_at(kernels), F.explode(issues).alias("issue"))
    return violations(rows, "json_schemas_and_kernels", F.lit(""), "id", F.col("issue"))


def snapshot_quality(snapshots: DataFrame) -> DataFrame:
    """Baselines need a title and a narrative of ten characters; release baselines need highlights."""
    name = F.col("baseline_id")
    release = F.startswith(name, F.lit("release-")) | F.startswith(name, F.lit("v")) | (name == "last-release")
    issues = F.filter(
        F.array(
            F.when(~c.not_blank("title"), "missing or empty title"),
            F.when(F.length(F.coalesce(c.strip("narrative"), F.lit(""))) < 10, "narrative too short"),
            F.when(release & ~c.has_items("highlights"), "release baseline without highlights"),
        ),
        lambda x: x.isNotNull(),
    )
    rows = snapshots.select("baseline_id", F.explode(issues).alias("issue"))
    return violations(rows, "snapshot_quality", "baseline_id", "baseline_id", F.col("issue"), severity="warn")


def missing_identifier(papers: DataFrame, year_now: Column) -> DataFrame:
    """Hint for published papers without DOI or arXiv id."""
    rows = papers.where(
        (F.col("year") <= year_now) & ~c.not_blank("source.doi") & ~c.not_blank("source.arxiv_id")
    )
    return violations(rows, "missing_identifier_hint", "id", "id", "no DOI or arXiv id", severity="hint")


def disputed(claims: DataFrame, width: int = 80) -> DataFrame:
    """Disputed claims with the start of their text."""
    return claims.where("status = 'disputed'").select(
        "paper_id", "id", F.substring("informal_text", 1, width).alias("snippet")
    )


# --- cross-table checks -----------------------------------------------------------------------


#: Papers with claims that may be broadcast, counted first.
BROADCAST_PAPERS = 1_000_000


def _facts(df: DataFrame, group: Column, row: Column, targets: Sequence[tuple], refs: Sequence[tuple] = ()) -> DataFrame:
    """Ids and references of one table, in one scan, in the shape of :func:`linking.key_states`.

    ``targets``: (sort, scope, id); ``refs``: (kind, sort, scope, array of ids).
    """
    empty, text = F.array().cast("array<string>"), lambda x: x.cast("string")

    def fact(kind: str | None, sort: str, scope: Column, ref: Column) -> Column:
        return F.struct(
            F.lit(sort).alias("target"), text(scope).alias("scope"), text(ref).alias("ref"), F.lit(kind).cast("string").alias("kind")
        )

    entries = [F.array(*[fact(None, sort, scope, ref) for sort, scope, ref in targets])] if targets else []
    many = lambda kind, sort, scope, ids: F.transform(F.coalesce(ids, empty), lambda r: fact(kind, sort, scope, r))
    entries += [many(*ref) for ref in refs]
    at = F.col("pos").cast("long") if listed_at(df) else F.lit(None).cast("long")
    return df.select(
        F.coalesce(text(group), F.lit("")).alias("group_id"), text(row).alias("row_id"), at.alias("pos"),
        F.inline(F.concat(*entries)),
    )


#: Sorts of ids in the graph of a corpus, and the kinds of references to them.
GRAPH_SORTS = ["claim", "assumption", "symbol", "named mapping", "card", "kernel"]
GRAPH_KINDS = [
    ("claim assumption", "assumption"), ("claim symbol", "symbol"), ("card claim", "claim"), ("card dependency", "card"), ("card kernel", "kernel"),
    ("card path", "named mapping"), ("mapping claim", "claim"), ("manifest kernel", "kernel"), ("kernel card", "card"),
]


def _linked(df: DataFrame, group: Column, row: Column, sort: str | None, known: Column | None, refs: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Rows of one table with their references, in the shape of :func:`linking.lost_links`.

    ``sort``: what ``row`` is an id of, where ``known`` holds; ``refs``: (kind, array of ids).
    """
    kinds = [kind for kind, _ in GRAPH_KINDS]
    place = F.lit(GRAPH_SORTS.index(sort) if sort else None).cast("tinyint")
    place = place if known is None else F.when(known, place)
    none = F.array().cast("array<string>")
    lists = [(kinds.index(kind), F.coalesce(ids.cast("array<string>"), none)) for kind, ids in refs]
    numbers = [F.array_repeat(F.lit(kind).cast("tinyint"), F.size(ids)) for kind, ids in lists]
    at = F.col("pos").cast("long") if listed_at(df) else F.lit(None).cast("long")
    return df.select(
        F.coalesce(group.cast("string"), F.lit("")).alias("group_id"), row.cast("string").alias("row_id"), at.alias("pos"),
        place.alias("sort"), F.concat(F.array().cast("array<tinyint>"), *numbers).alias("link_kinds"), F.concat(none, *[ids for _, ids in lists]).alias("links"),
    )


def normalization_integrity(claims: DataFrame, assumptions: DataFrame, symbols: DataFrame) -> DataFrame:
    """Ids unique per paper and every assumption and symbol link resolved; each table is read once."""
    paper, own = F.col("paper_id"), F.col("id")
    scope = F.coalesce(paper, F.lit(""))
    links = [("assumption", "assumption", scope, F.col("linked_assumptions")), ("symbol", "symbol", scope, F.col("linked_symbols"))]
    facts = durable(
        union_all(
            [
                _facts(claims, paper, own, [("claim", paper, own)], links),
                _facts(assumptions, paper, own, [("assumption", paper, own)]),
                _facts(symbols, paper, own, [("symbol", paper, own)]),
            ]
        ),
        "links",
    )
    dup = linking.key_states(facts.where("scope is not null and ref is not null")).where("n_targets > 1")
    lost = linking.dangling(facts)
    name = "normalization_integrity"
    found = F.concat(F.lit("duplicate "), "target", F.lit(" id"))
    missing = F.concat(F.lit("linked_"), "kind", F.lit("s references missing "), "ref")
    return violations(dup, name, "scope", "ref", found).unionByName(
        violations(lost, name, "group_id", "row_id", missing)
    )


def provenance(papers: DataFrame, claims: DataFrame, manifests: DataFrame, mapping: DataFrame, exempt_tag: str = "hardness.primary:") -> DataFrame:
    """Every claim has a span, published papers a real source hash, declarations a mapped claim.

    Papers tagged ``exempt_tag…`` without claims may keep the all-zero hash.
    """
    with_manifest = papers.join(manifests.select(F.col("paper_id").alias("id")), "id", "left_semi")
    tagged = F.exists(F.coalesce("tags", F.array().cast("array<string>")), lambda t: F.startswith(t, F.lit(exempt_tag)))
    claimed = claims.select(F.col("paper_id").alias("id")).distinct().withColumn("__has", F.lit(True))
    zero = (
        with_manifest.where(c.strip("source.sha256") == c.ZERO_DIGEST)
        .join(claimed, "id", "left")
        .where(~(F.coalesce(tagged, F.lit(False)) & F.col("__has").isNull()))
    )
    known = papers.select(F.col("id").alias("paper_id"))
    spanless = claims.join(known, "paper_id", "left_semi").where(F.col("source_span").isNull())
    declared = mapping.select(
        "paper_id", "namespace", F.explode(F.map_values("claim_to_decl")).alias("short")
    ).select("paper_id", c.qualified("namespace", "short").alias("decl"))
    listed = manifests.join(known, "paper_id", "left_semi").select("paper_id", F.posexplode("declaration_index").alias("pos", "decl"))
    unmapped = listed.join(declared, ["paper_id", "decl"], "left_anti")
    args = {"gate": "gate3"}
    return union_all(
        [
            violations(zero, "provenance_integrity", "id", "id", "manifest with all-zero source hash", **args),
            violations(spanless, "provenance_integrity", "paper_id", "id", "missing source_span", **args),
            violations(unmapped, "provenance_integrity", "paper_id", "decl", "declaration without mapped claim", **args),
        ]
    )


def extraction_run_required(claims: DataFrame, runs: DataFrame) -> DataFrame:
    rows = claims.select("paper_id").distinct().join(runs.select("paper_id"), "paper_id", "left_anti")
    return violations(rows, "extraction_run_required", "paper_id", "paper_id", "claims without extraction run")


def graph_integrity(
    claims: DataFrame, assumptions: DataFrame, symbols: DataFrame, mapping: DataFrame,
    cards: DataFrame, manifests: DataFrame, kernels: DataFrame,
) -> DataFrame:
    """References between claims, cards, mapping, manifests and kernels.

    Link checks against an empty parent set are skipped, as the strict form is part of
    :func:`normalization_integrity`. Only papers with claims are judged, and only their cards can be
    depended upon: the papers are counted and broadcast up to ``BROADCAST_PAPERS``, and other rows go before they
    are stored. Each table is read once, claims twice: its rows with their references become rows of one stored
    table. Ids of cards and kernels are known everywhere and aggregated by key; all others are looked up in their
    paper, by which the stored rows are shuffled once. What is grouped by ``group_id`` and more needs no other shuffle.
    """
    paper, own, everywhere = F.col("paper_id"), F.col("id"), F.lit("")
    scope = F.coalesce(paper, F.lit(""))
    with_claims = durable(claims.select(scope.cast("string").alias("__paper")).distinct(), "papers")
    known = F.broadcast(with_claims) if with_claims.count() <= BROADCAST_PAPERS else with_claims
    judged = lambda df: df.join(known, scope.cast("string") == F.col("__paper"), "left_semi")
    path = F.when(c.not_blank("lean_decl") & ~c.not_blank("file_path"), F.array(scope))
    rows = union_all(
        [
            _linked(claims, paper, own, "claim", paper.isNotNull(), [("claim assumption", F.col("linked_assumptions")), ("claim symbol", F.col("linked_symbols"))]),
            _linked(
                judged(cards), paper, own, "card", None,
                [
                    ("card claim", F.array("claim_id")), ("card dependency", F.col("dependency_ids")),
                    ("card kernel", F.col("executable_links")), ("card path", path),
                ],
            ),
            _linked(judged(mapping), paper, paper, "named mapping", c.not_blank("namespace"), [("mapping claim", F.map_keys("claim_to_decl"))]),
            _linked(judged(manifests), paper, paper, None, None, [("manifest kernel", F.col("kernel_index"))]),
            _linked(kernels, everywhere, own, "kernel", None, [("kernel card", F.col("linked_theorem_cards"))]),
            _linked(assumptions, paper, own, "assumption", paper.isNotNull()),
            _linked(symbols, paper, own, "symbol", paper.isNotNull()),
        ]
    )
    rows = durable(rows, "references", "zstd", release=True)
    lost = linking.lost_links(rows, GRAPH_SORTS, GRAPH_KINDS, ["card", "kernel"], ["kernel", "assumption", "symbol"], ["named mapping"])
    message = F.when(F.col("kind") == "card path", F.lit("card without file_path")).otherwise(F.concat("kind", F.lit(" is missing: "), "ref"))
    return violations(lost, "graph_integrity", "group_id", "row_id", message)


def claim_value_policy(claims: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Near-duplicate claims whose kinds are both stated and neither a reuse kind."""
    keyed = similarity.claim_signature(claims).withColumn("row_key", F.struct("paper_id", "pos", "id"))
    found = similarity.unreused_near_duplicates(keyed, "row_key", threshold=threshold).withColumn("pos", F.col("row_key.pos"))
    msg = F.concat(F.lit("near-duplicate of "), F.col("first_partner.id"), F.lit(" and others, "), F.col("partners").cast("string"), F.lit(" in all"))
    return violations(found, "claim_value_policy", F.col("row_key.paper_id"), F.col("row_key.id"), msg)


def coverage_integrity(manifests: DataFrame, claims: DataFrame, cards: DataFrame) -> DataFrame:
    """Stored coverage counters must equal recomputed ones, and a paper with counters must have claims."""
    names = ["claim_count", "mapped_claim_count", "machine_checked_count", "kernel_linked_count"]
    stored = manifests.where("coverage_metrics is not null").select("paper_id", "coverage_metrics.*")
    base = stored.select("paper_id").join(metrics.expected_coverage(claims, cards), "paper_id", "left").fillna(0, names)
    diff = linking.compare_recomputed(stored, base, ["paper_id"], names)
    show = lambda x: F.coalesce(F.col(x).cast("long").cast("string"), F.lit("null"))
    msg = F.concat(F.col("metric"), F.lit(" is "), show("stored"), F.lit(", expected "), show("expected"))
    claimless = stored.join(claims.select("paper_id"), "paper_id", "left_anti")
    return violations(diff, "coverage_integrity", "paper_id", "paper_id", msg, gate="gate4").unionByName(
        violations(claimless, "coverage_integrity", "paper_id", "paper_id", "manifest without claims", gate="gate4")
    )


def graph_bootstrap_warning(cards: DataFrame, claims: DataFrame) -> DataFrame:
    checked = claims.where("status = 'machine_checked'")
    rows = metrics.graph_bootstrap(cards, checked, "paper_id", F.size("dependency_ids"))
    return violations(
        rows, "dependency_graph_bootstrap", "paper_id", "paper_id",
        F.concat(F.col("cards").cast("string"), F.lit(" cards but no dependency")), severity="warn",
    )


def graph_quality_warning(cards: DataFrame) -> DataFrame:
    rows = metrics.graph_quality(cards, "paper_id", F.size("dependency_ids")).where("warning is not null")
    return violations(rows, "dependency_graph_quality", "paper_id", "paper_id", F.col("warning"), severity="warn")


def duplicate_violations(df: DataFrame, keys: Sequence[str], check_id: str, group: str, row: str) -> DataFrame:
    return violations(linking.duplicate_keys(df, keys), check_id, group, row, "duplicate key")


# --- report -----------------------------------------------------------------------------------


def gate_report(found: DataFrame, order: Sequence[tuple[str, str, str]] = tuple(GATE_ORDER)) -> DataFrame:
    """One row per check: status ok, warn or error, number of findings and the first of them.

    First is by group, then by list position, findings without one last, then by row id and message.
    """
    spark = found.sparkSession
    steps = [(i, g, k, s) for i, (g, k, s) in enumerate(order)]
    plan = constant_rows(spark, steps, step="int", gate="string", check_id="string", kind="string")
    first = F.min_by(F.struct("group_id", "row_id", "message"), F.struct("group_id", F.col("at").isNull(), "at", "row_id", "message"))
    per = found.groupBy("check_id").agg(F.count(F.lit(1)).alias("findings"), first.alias("first"))
    status = F.when(F.col("findings") == 0, "ok").when(F.col("kind") == "error", "error").otherwise("warn")
    return (
        plan.join(per, "check_id", "left")
        .fillna(0, ["findings"])
        .select("step", "gate", "check_id", status.alias("status"), "findings", "first.group_id", "first.row_id", "first.message")
    )


def verdict(report: DataFrame) -> DataFrame:
    """Whether any hard check failed, and which failed first."""
    bad = F.when(F.col("status") == "error", F.struct("step", "check_id"))
    return report.agg(
        (F.count(bad) == 0).alias("ok"), F.min(bad)["check_id"].alias("first_failure"), F.sum("findings").alias("findings")
    )
