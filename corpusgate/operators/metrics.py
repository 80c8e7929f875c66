"""Coverage, quality, review and scoring metrics. Every metric is a mergeable aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgate.functions import columns as c
from corpusgate.session import constant_rows

N = "*"


def with_totals(per_group: DataFrame, group: str, measures: Sequence[str], level: str = "is_total") -> DataFrame:
    """Per-group rows plus one total row (group null, ``is_total`` 1) from an existing aggregate.

    Rolling up the aggregate instead of the rows keeps the doubling of rows off the large input.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    return per_group.rollup(group).agg(*sums, F.grouping(group).cast("int").alias(level))


# --- coverage ---------------------------------------------------------------------------------


def coverage(
    claims: DataFrame,
    group: Sequence[str],
    mapped: Column,
    checked: Column,
    linked: Column,
    totals: bool = False,
) -> DataFrame:
    """Row, mapped, checked and linked counts with the four shares built on them."""
    out = claims.groupBy(*group).agg(
        F.count(N).alias("claim_count"),
        F.count_if(mapped).alias("mapped_claim_count"),
        F.count_if(checked).alias("machine_checked_count"),
        F.count_if(linked).alias("kernel_linked_count"),
    )
    if totals:
        counts = ["claim_count", "mapped_claim_count", "machine_checked_count", "kernel_linked_count"]
        out = with_totals(out, group[0], counts)
    return coverage_shares(out)


def coverage_shares(counts: DataFrame) -> DataFrame:
    n = F.col("claim_count")
    return (
        counts.withColumn("mapped_share", c.ratio("mapped_claim_count", n))
        .withColumn("machine_checked_share", c.ratio("machine_checked_count", n))
        .withColumn("kernel_linked_share", c.ratio("kernel_linked_count", n))
        .withColumn("completion_share", c.ratio("machine_checked_count", "mapped_claim_count"))
    )


def linked_claims(claims: DataFrame, cards: DataFrame) -> DataFrame:
    """Claims with a flag for cards that carry executable links (both sides ``paper_id``, ``id``)."""
    ids = (
        cards.where(c.has_items("executable_links") & c.not_blank("claim_id"))
        .select("paper_id", F.col("claim_id").alias("id"), F.lit(True).alias("kernel_linked"))
        .distinct()
    )
    return claims.join(ids, ["paper_id", "id"], "left").withColumn(
        "kernel_linked", F.coalesce("kernel_linked", F.lit(False))
    )


def expected_coverage(claims: DataFrame, cards: DataFrame) -> DataFrame:
    """Counters a manifest must hold; papers without any card count claims marked as linked."""
    base = claims.groupBy("paper_id").agg(
        F.count(N).alias("claim_count"),
        F.count_if(c.has_items("linked_formal_targets")).alias("mapped_claim_count"),
        F.count_if(F.col("status") == "machine_checked").alias("machine_checked_count"),
        F.count_if(F.col("status") == "linked_to_kernel").alias("__marked"),
    )
    linked = cards.groupBy("paper_id").agg(
        F.count_distinct(
            F.when(c.has_items("executable_links") & c.not_blank("claim_id"), F.col("claim_id"))
        ).alias("__linked")
    )
    return (
        base.join(linked, "paper_id", "left")
        .withColumn("kernel_linked_count", F.coalesce("__linked", "__marked"))
        .drop("__linked", "__marked")
    )


def completion_rate(
    counts: DataFrame, group: str, checked: str, mapped: str, target: int | None = None
) -> DataFrame:
    """Checked share of mapped per group and overall, with progress to a target on the total."""
    out = with_totals(counts, group, [mapped, checked]).withColumn("rate", c.ratio(checked, mapped))
    if target:
        out = out.withColumn("progress", F.when(F.col("is_total") == 1, F.col(checked) / F.lit(float(target))))
    return out


def extraction_run(claims: DataFrame, assumptions: DataFrame, papers: DataFrame, recorded_at: Column, mode: str | None = None) -> DataFrame:
    """Per paper: claims, claims with a complete span, assumptions and when that was recorded."""
    cl = claims.groupBy("paper_id").agg(
        F.count(N).alias("claim_count"),
        F.count_if(c.span_complete("source_span")).alias("claims_with_source_span"),
    )
    asm = assumptions.groupBy("paper_id").agg(F.count(N).alias("assumption_count"))
    zero = {"claim_count": 0, "claims_with_source_span": 0, "assumption_count": 0}
    return (
        papers.select("paper_id")
        .join(cl, "paper_id", "left")
        .join(asm, "paper_id", "left")
        .fillna(zero)
        .withColumn("recorded_at", c.instant_text(recorded_at))
        .withColumn("extraction_mode", F.lit(mode))
    )


# --- graphs -----------------------------------------------------------------------------------


def edges_from_cards(cards: DataFrame, group: Sequence[str] = ("paper_id",)) -> DataFrame:
    """One edge per dependency, from the dependency to the card, with a confidence."""
    method = F.coalesce("dependency_extraction_method", F.lit(""))
    rows = cards.where(c.not_blank("id")).select(
        *group,
        F.col("id").alias("dst"),
        F.when(F.contains(method, F.lit("tier1")), "high").otherwise("medium").alias("confidence"),
        F.explode("dependency_ids").alias("src"),
    )
    return rows.where(c.not_blank("src")).select(*group, c.strip("src").alias("src"), "dst", "confidence")


def graph_or_cards(manifest_edges: DataFrame, has_graph: DataFrame, card_edges: DataFrame, group: str = "paper_id") -> DataFrame:
    """Manifest edges where a group states a graph, else edges derived from its cards.

    ``has_graph`` lists the groups with a non-empty stated graph, valid or not.
    """
    stated = manifest_edges.where(c.not_blank("src") & c.not_blank("dst"))
    derived = card_edges.join(has_graph.select(group).distinct(), group, "left_anti")
    cols = [group, "src", "dst"]
    return stated.select(*cols).unionByName(derived.select(*cols))


def degree_metrics(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Reuse ratio and fan-in / fan-out over all nodes; duplicate edges count, no edges give zeros."""
    def end(col: str, fan_out: int, fan_in: int) -> Column:
        return F.struct(F.col(col).alias("node"), F.lit(fan_out).alias("o"), F.lit(fan_in).alias("i"))

    ends = edges.select(F.inline(F.array(end(src, 1, 0), end(dst, 0, 1))))
    nodes = ends.groupBy("node").agg(F.sum("i").alias("fan_in"), F.sum("o").alias("fan_out"))
    zero = F.lit(0)
    out = nodes.agg(
        F.coalesce(F.sum("fan_in"), zero).alias("total_edges"),
        F.coalesce(F.sum(F.when(F.col("fan_in") > 1, F.col("fan_in"))), zero).alias("__reused"),
        F.count(N).alias("__nodes"),
        F.coalesce(F.sum("fan_out"), zero).alias("__out"),
        F.count_if(F.col("fan_in") > 0).alias("declarations_with_in_degree"),
        F.coalesce(F.max("fan_in"), zero).alias("max_fan_in"),
        F.coalesce(F.max("fan_out"), zero).alias("max_fan_out"),
        F.count_if(F.col("fan_in") > 1).alias("shared_targets_count"),
    )
    return out.select(
        c.ratio("__reused", "total_edges").alias("dependency_reuse_ratio"),
        "total_edges",
        "declarations_with_in_degree",
        c.ratio("total_edges", "__nodes").alias("average_fan_in"),
        c.ratio("__out", "__nodes").alias("average_fan_out"),
        "max_fan_in",
        "max_fan_out",
        "shared_targets_count",
    )


def shared_names(df: DataFrame, name: str, group: str) -> DataFrame:
    """Names held by more than one group. Comparing the smallest and largest group avoids a distinct count."""
    return (
        df.where(c.not_blank(F.col(name).cast("string")))
        .groupBy(name)
        .agg(F.min(group).alias("__lo"), F.max(group).alias("__hi"), F.count(N).alias("n_rows"))
        .where("__lo <> __hi")
        .select(name, "n_rows")
    )


def cross_group_duplicates(df: DataFrame, name: str, group: str, row_id: str, pos: str | None = None) -> DataFrame:
    """Every location of a name held by several groups, one row per location."""
    dup = shared_names(df, name, group).select(name)
    found = df.join(dup, name, "left_semi")
    loc = F.col(row_id).cast("string")
    if pos:
        loc = F.coalesce(F.nullif(loc, F.lit("")), F.concat(F.lit("index_"), F.col(pos).cast("string")))
    return found.select(name, group, loc.alias("location"))


def reused_targets(edges: DataFrame, target: str, group: str, limit: int = 100) -> DataFrame:
    """The first ``limit`` targets, by name, that edges of more than one group point to."""
    return shared_names(edges, target, group).select(target).orderBy(target).limit(limit)


def distinct_nodes(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return edges.select(F.explode(F.array(src, dst)).alias("node")).distinct()


def incident_edges(edges: DataFrame, nodes: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges touching any of ``nodes`` (column ``node``), as two semi joins instead of an OR join."""
    keys = nodes.select("node").distinct()
    out_edges = edges.join(keys, F.col(src) == F.col("node"), "left_semi")
    in_only = edges.join(keys, F.col(dst) == F.col("node"), "left_semi").join(
        keys, F.col(src) == F.col("node"), "left_anti"
    )
    return out_edges.unionByName(in_only)


def graph_quality(cards: DataFrame, group: str, deps: Column) -> DataFrame:
    """Edge density and share of cards without dependencies; ``warning`` says why a group is flagged."""
    n = F.coalesce(deps, F.lit(0)).cast("long")
    out = cards.groupBy(group).agg(
        F.count(N).alias("cards"),
        (F.sum(n) / F.count(N)).alias("edge_density"),
        (F.count_if(n == 0) / F.count(N)).alias("sparse_ratio"),
    )
    big = F.col("cards") >= 6
    return out.withColumn(
        "warning",
        F.when(big & (F.col("sparse_ratio") >= 0.60), "sparse").when(
            big & (F.col("edge_density") <= 0.25) & (F.col("sparse_ratio") >= 0.40), "low_density"
        ),
    )


def graph_bootstrap(cards: DataFrame, checked: DataFrame, group: str, deps: Column) -> DataFrame:
    """Groups with three or more cards, no dependency at all and some checked claim."""
    empty = (
        cards.groupBy(group)
        .agg(F.count(N).alias("cards"), F.max(F.coalesce(deps, F.lit(0))).alias("__deps"))
        .where("cards >= 3 AND __deps = 0")
        .drop("__deps")
    )
    return empty.join(checked.select(group), group, "left_semi")


# --- symbols ----------------------------------------------------------------------------------


def symbol_conflicts(symbols: DataFrame, group: str, name: str, flagged: Column) -> DataFrame:
    """Flagged and overloaded symbols per group and in total with the conflict rate.

    A symbol both flagged and overloaded counts twice, so the rate can exceed one.
    """
    per_name = symbols.groupBy(group, name).agg(F.count(N).alias("n"), F.count_if(flagged).alias("flagged"))
    named = c.not_blank(F.col(name).cast("string")) & (F.col("n") > 1)
    per_group = per_name.groupBy(group).agg(
        F.sum("n").alias("symbol_count"),
        F.sum("flagged").alias("with_flags"),
        F.coalesce(F.sum(F.when(named, F.col("n"))), F.lit(0)).alias("overloaded"),
    )
    return with_totals(per_group, group, ["symbol_count", "with_flags", "overloaded"]).withColumn(
        "conflict_rate", c.ratio(F.col("with_flags") + F.col("overloaded"), "symbol_count")
    )


def normalization_report(symbols: DataFrame, group: str, name: str) -> DataFrame:
    """Symbols and names used more than once per group."""
    per_name = symbols.groupBy(group, name).agg(F.count(N).alias("n"))
    return per_name.groupBy(group).agg(
        F.sum("n").alias("symbol_count"), F.count_if(F.col("n") > 1).alias("duplicate_name_count")
    )


def unlinked_rows(claims: DataFrame, links: Column, parents: DataFrame, group: str) -> DataFrame:
    """Rows without links in groups that have something to link to."""
    return claims.where(~links).join(parents.select(group).distinct(), group, "left_semi")


def dimension_visibility(symbols: DataFrame, kind: str, unit: str, dimension: str, group: str | None = None) -> DataFrame:
    """Symbols with and without any dimensional metadata."""
    has = c.not_blank(kind) | c.not_blank(unit) | c.not_blank(dimension)
    aggs = [F.count_if(has).alias("with_count"), F.count_if(~has).alias("without_count")]
    return symbols.groupBy(group).agg(*aggs) if group else symbols.agg(*aggs)


def error_count(
    errors: DataFrame, files: DataFrame, documents: DataFrame, text: str = "text", words: Sequence[str] = ("literature", "error")
) -> DataFrame:
    """One row ``(error_count, from_files)``: recorded errors, or documents with all the words where nobody records any.

    ``errors`` has a row per recorded error, ``files`` one per paper that has a record, be it an empty one.
    """
    low = F.lower(F.col(text))
    named = reduce(Column.__and__, [F.contains(low, F.lit(w)) for w in words])
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    noted = documents.agg(F.count_if(named).alias("__named"))
    return noted.withColumn("from_files", count(files) > 0).select(
        F.when(F.col("from_files"), count(errors)).otherwise(F.col("__named")).alias("error_count"), "from_files"
    )


def research_counts(claims: DataFrame, kernels: DataFrame) -> DataFrame:
    """One row: claims with assumptions, disputed claims that still have formal targets, kernels with cards."""
    found = claims.agg(
        F.count_if(c.has_items("linked_assumptions")).alias("claims_with_linked_assumptions"),
        F.count_if((F.col("status") == "disputed") & c.has_items("linked_formal_targets")).alias("disputed_claims_with_formal_targets"),
    )
    linked = kernels.agg(F.count_if(c.has_items("linked_theorem_cards"))).scalar()
    return found.withColumn("kernels_with_linked_cards", linked)


def policy_report(
    duplicates: DataFrame,
    name: str,
    unlinked: DataFrame,
    without_dimension: DataFrame,
    waivers: Sequence[str] = (),
    max_unlinked: int | None = None,
    max_without: int | None = None,
) -> DataFrame:
    """Policy findings as rows ``(rule, subject, observed, allowed, ok)``."""
    waived = F.col(name).cast("string").isin(list(waivers)) if waivers else F.lit(False)
    dup = duplicates.select(
        F.lit("duplicate_name").alias("rule"),
        F.col(name).cast("string").alias("subject"),
        F.lit(1).cast("long").alias("observed"),
        F.when(waived, 1).otherwise(0).cast("long").alias("allowed"),
        waived.alias("ok"),
    )

    def limit(df: DataFrame, rule: str, cap: int | None) -> DataFrame:
        seen = df.agg(F.count(N).alias("observed"))
        allowed = F.lit(cap).cast("long")
        ok = F.lit(True) if cap is None else F.col("observed") <= allowed
        return seen.select(F.lit(rule).alias("rule"), F.lit("").alias("subject"), "observed", allowed.alias("allowed"), ok.alias("ok"))

    return dup.unionByName(limit(unlinked, "unlinked_rows", max_unlinked)).unionByName(
        limit(without_dimension, "without_dimension", max_without)
    )


# --- review -----------------------------------------------------------------------------------


def reviewer_status(cards: DataFrame, group: str, status: str, notes: str, proof: str) -> DataFrame:
    """Reviewer states per group and in total; rule counts look only at valid states."""
    s = F.coalesce(F.col(status), F.lit(""))
    valid = s.isin(list(c.REVIEWER_STATUSES))
    checked = F.coalesce(F.col(proof) == "machine_checked", F.lit(False))
    counts = {
        "total_cards": F.count(N),
        **{v: F.count_if(s == v) for v in sorted(c.REVIEWER_STATUSES)},
        "missing_status": F.count_if(s == ""),
        "invalid_status": F.count_if((s != "") & ~valid),
        "blocked_without_notes": F.count_if((s == "blocked") & ~c.not_blank(notes)),
        "accepted_not_checked": F.count_if((s == "accepted") & ~checked),
        "checked_but_unreviewed": F.count_if((s == "unreviewed") & checked),
    }
    per_group = cards.groupBy(group).agg(*[v.alias(k) for k, v in counts.items()])
    return with_totals(per_group, group, list(counts))


def reviewer_report(claims: DataFrame, status: str, notes: str, kind: str) -> DataFrame:
    """Claim counts as rows ``(section, key, n)``: by status, by dispute notes, by value kind."""
    s = c.filled(c.strip(status), "unparsed")
    noted = F.when(c.not_blank(notes), "with_notes").otherwise("without_notes")
    def entry(section: str, key: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), key.alias("key"))

    entries = F.array(
        entry("status", s),
        entry("disputed", F.when(s == "disputed", noted)),
        entry("invalid_status", F.when(~s.isin(list(c.CLAIM_STATUSES)), s)),
        entry("value_kind", c.blank_to_null(kind)),
    )
    rows = claims.select(F.inline(entries))
    return rows.where("key is not null").groupBy("section", "key").agg(F.count(N).alias("n"))


def dashboard(cards: DataFrame, coverage_counts: DataFrame, group: str, status: str) -> DataFrame:
    """Coverage counters beside reviewer buckets, per group and in total.

    A state that is not blocked, reviewed or accepted counts as unreviewed here.
    """
    s = F.coalesce(F.col(status), F.lit("unreviewed"))
    buckets = cards.groupBy(group).agg(
        *[F.count_if(s == v).alias(v) for v in ("blocked", "reviewed", "accepted")],
        F.count_if(~s.isin("blocked", "reviewed", "accepted")).alias("unreviewed"),
    )
    measures = [x for x in coverage_counts.columns if x != group]
    names = ["blocked", "reviewed", "accepted", "unreviewed"]
    joined = coverage_counts.join(buckets, group, "left").fillna(0, names)
    return with_totals(joined, group, [*measures, *names])


# --- scoring ----------------------------------------------------------------------------------


def match_gold(
    pred: DataFrame, gold: DataFrame, group: Sequence[str], key: str, scored: DataFrame | None = None
) -> DataFrame:
    """Per-group true positives, predictions and gold ids (distinct ids).

    Groups without gold ids are not scored, gold groups without predictions are; ``scored`` names the
    groups to score instead, so that a group whose gold list is empty keeps its false positives.
    """
    p = pred.select(*group, key).distinct().withColumn("__p", F.lit(1))
    g = gold.select(*group, key).distinct().withColumn("__g", F.lit(1))
    both = p.join(g, [*group, key], "full_outer")
    out = both.groupBy(*group).agg(
        F.count(F.when(F.col("__p").isNotNull() & F.col("__g").isNotNull(), 1)).alias("tp"),
        F.count("__p").alias("n_pred"),
        F.count("__g").alias("n_gold"),
    )
    return out.where("n_gold > 0") if scored is None else out.join(scored, list(group), "left_semi")


def prf_micro(counts: DataFrame, empty: float = 0.0) -> DataFrame:
    """Micro precision, recall and F1 of ``tp``, ``n_pred``, ``n_gold``; nothing when all are zero."""
    total = counts.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("tp", "n_pred", "n_gold")])
    return (
        total.where("n_pred + n_gold > 0")
        .withColumn("precision", c.ratio("tp", "n_pred", empty))
        .withColumn("recall", c.ratio("tp", "n_gold", empty))
        .withColumn("f1", c.f1("precision", "recall"))
    )


def entity_totals(**frames: DataFrame) -> DataFrame:
    """Row counts of several tables as ``(metric, value)`` rows."""
    out = None
    for name, df in frames.items():
        row = df.agg(F.count(N).cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")
        out = row if out is None else out.unionByName(row)
    return out


def presence_counts(files: DataFrame, path: str, kinds: Sequence[str]) -> DataFrame:
    """How many files of each kind exist, zero included."""
    name = F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1)
    wanted = constant_rows(files.sparkSession, [(k,) for k in kinds], kind="string")
    seen = files.select(name.alias("kind"), F.lit(1).alias("__one"))
    return wanted.join(seen, "kind", "left").groupBy("kind").agg(F.count("__one").alias("files"))


def proposal_footprint(proposals: DataFrame, kind: str, replacements: Column, path: str, root: str = "formal/") -> DataFrame:
    """Proposals per edit kind: all, with replacements and ready for conversion by the path rule."""
    p = F.replace(c.strip(path), F.lit("\\"), F.lit("/"))
    safe = F.startswith(p, F.lit(root)) & ~F.contains(p, F.lit(".."))
    has = F.coalesce(replacements, F.lit(0)) > 0
    return proposals.groupBy(kind).agg(
        F.count(N).alias("proposals"),
        F.count_if(has).alias("with_replacements"),
        F.count_if(has & F.coalesce(safe, F.lit(False))).alias("conversion_ready"),
    )


def decision_counts(bundles: DataFrame, decision: str, seconds: str) -> DataFrame:
    """Reviewer decisions, acceptance rate and reviewing time over proposal bundles."""
    d = F.coalesce(F.col(decision), F.lit(""))
    out = bundles.agg(
        F.count(N).alias("bundles"),
        F.count_if(d != "").alias("decided"),
        *[F.count_if(d == v).alias(v) for v in ("accepted", "rejected", "edited", "pending")],
        F.coalesce(F.sum(seconds), F.lit(0.0)).alias("reviewer_seconds"),
        F.count(seconds).alias("reviewer_observations"),
    )
    return out.withColumn("acceptance_rate", c.ratio("accepted", "decided"))


def evaluate_entries(
    proposed: DataFrame, gold: DataFrame, keys: Sequence[str], value: str, group: str, offered: DataFrame | None = None
) -> DataFrame:
    """Precision, recall, F1 and disagreement of proposed key-value entries against a gold mapping.

    Proposals are a list (repeats count); groups without gold entries are not compared, and a
    measure with nothing to compare stays at 1 (disagreement at 0). ``offered`` names the groups with
    a proposal list, which may be empty; else these are the groups of ``proposed``.
    """
    ref = gold.select(*keys, F.col(value).alias("__gold"))
    scored = proposed.join(gold.select(group).distinct(), group, "left_semi").join(ref, list(keys), "left")
    hit = F.coalesce(F.col(value) == F.col("__gold"), F.lit(False))
    props = scored.agg(F.count_if(hit).alias("tp"), F.count(N).alias("n_pred"))
    golds = gold.join((proposed if offered is None else offered).select(group).distinct(), group, "left_semi").agg(F.count(N).alias("n_gold"))
    out = props.withColumn("n_gold", golds.scalar())
    return (
        out.withColumn("precision", c.ratio("tp", "n_pred", 1.0))
        .withColumn("recall", c.ratio("tp", "n_gold", 1.0))
        .withColumn("f1", c.f1("precision", "recall"))
        .withColumn("disagreement", 1.0 - F.col("precision"))
    )


def metric_rows(frame: DataFrame, task: str, metrics: Sequence[str]) -> DataFrame:
    """One wide metric row as long ``(task, metric, value)`` rows."""
    cast = frame.select(*[F.col(m).cast("double").alias(m) for m in metrics])
    return cast.unpivot([], list(metrics), "metric", "value").select(F.lit(task).alias("task"), "metric", "value")


def threshold_table(spark, floors: Mapping[str, Mapping[str, float]], ceilings: Mapping[str, Mapping[str, float]] = {}) -> DataFrame:
    """Thresholds as rows ``(task, metric, bound, limit_value)``; names starting with ``_`` are notes."""
    rows = [
        (task, metric, bound, float(v))
        for bound, table in (("floor", floors), ("ceiling", ceilings))
        for task, metrics in table.items()
        for metric, v in metrics.items()
        if not metric.startswith("_")
    ]
    return constant_rows(spark, rows, task="string", metric="string", bound="string", limit_value="double")


def regression_check(
    actuals: DataFrame, thresholds: DataFrame, runtimes: DataFrame | None = None, budget: float | None = None
) -> DataFrame:
    """Broken thresholds in the order they are judged: runtime, floors, ceilings.

    A task with floors but no actuals fails; a missing metric is skipped, and so is a missing task
    under a ceiling.
    """
    tasks = actuals.select("task").distinct()
    floors = thresholds.where("bound = 'floor'")
    absent = floors.select("task").distinct().join(tasks, "task", "left_anti")
    cols = ["phase", "task", "metric", "value", "limit_value"]
    null_num = F.lit(None).cast("double")
    missing = absent.select(
        F.lit(2).alias("phase"), "task", F.lit("").alias("metric"), null_num.alias("value"), null_num.alias("limit_value")
    )
    judged = actuals.join(thresholds, ["task", "metric"])
    low = judged.where((F.col("bound") == "floor") & (F.col("value") < F.col("limit_value")))
    high = judged.where((F.col("bound") == "ceiling") & (F.col("value") > F.col("limit_value")))
    out = (
        missing.unionByName(low.withColumn("phase", F.lit(2)).select(*cols))
        .unionByName(high.withColumn("phase", F.lit(3)).select(*cols))
    )
    if runtimes is not None and budget and budget > 0:
        slow = runtimes.where(F.col("value") > budget).select(
            F.lit(1).alias("phase"), "task", F.lit("_runtime_seconds").alias("metric"), "value", F.lit(float(budget)).alias("limit_value")
        )
        out = slow.unionByName(out)
    return out


def checked_fraction(cards: DataFrame, proof: str) -> DataFrame:
    """Declarations, checked declarations and their share (one trend entry)."""
    out = cards.agg(
        F.count(N).alias("declaration_count"),
        F.count_if(F.col(proof) == "machine_checked").alias("machine_checked_count"),
    )
    return out.withColumn("fraction_machine_checked", c.ratio("machine_checked_count", "declaration_count"))


# --- indices ----------------------------------------------------------------------------------


def reverse_index(rows: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Distinct ``(key, value)`` pairs with the place each was first seen, one row per pair.

    The long form keeps a key with very many values from becoming one oversized row.
    """
    return rows.where(c.not_blank(F.col(key).cast("string"))).groupBy(key, value).agg(
        F.min(F.struct(*order)).alias("first_seen")
    )


def route_ids(cards: DataFrame) -> DataFrame:
    """Every id under which a card can be reached: its id and its declaration."""
    ids = cards.select(F.col("id").alias("route")).union(cards.select(F.col("lean_decl").alias("route")))
    return ids.where(c.not_blank("route")).distinct()


def pages_index(papers: DataFrame, claims: DataFrame, cards: DataFrame) -> DataFrame:
    """Page paths: one per paper, per claim and per card."""
    def page(df: DataFrame, folder: str, key: str) -> DataFrame:
        kept = df.where(c.not_blank(F.col(key).cast("string")))
        return kept.select("paper_id", F.concat(F.lit(f"/{folder}/"), F.col(key).cast("string")).alias("path"))

    return page(papers, "papers", "paper_id").unionByName(page(claims, "claims", "id")).unionByName(
        page(cards, "theorem-cards", "id")
    )


def declaration_rows(manifest: DataFrame, cards: DataFrame) -> DataFrame:
    """Declarations from manifests and cards side by side, tagged with their source."""
    listed = manifest.select(
        "paper_id", F.explode("declaration_index").alias("lean_decl"), F.lit("manifest").alias("source")
    )
    held = cards.select(
        "paper_id", "lean_decl", "file_path", "proof_status", "claim_id", F.lit("theorem_cards").alias("source")
    )
    return listed.unionByName(held, allowMissingColumns=True)


def declarations_in_file(rows: DataFrame, path: str | None) -> DataFrame:
    """Rows whose file path contains ``path``; all rows for a blank path."""
    if not path or not path.strip():
        return rows
    wanted = path.strip().replace("\\", "/")
    return rows.where(F.contains(F.replace(F.col("file_path"), F.lit("\\"), F.lit("/")), F.lit(wanted)))


def dependencies_of(cards: DataFrame, decls: DataFrame) -> DataFrame:
    """Distinct dependency ids of the named declarations with the place each was first seen."""
    rows = cards.join(decls.select("paper_id", "lean_decl").distinct(), ["paper_id", "lean_decl"], "left_semi")
    deps = rows.select("paper_id", "lean_decl", "pos", F.posexplode("dependency_ids").alias("at", "dependency_id"))
    return deps.groupBy("paper_id", "lean_decl", "dependency_id").agg(F.min(F.struct("pos", "at")).alias("first_seen"))


def declaration_index(cards: DataFrame, old_cards: DataFrame, manifest: DataFrame) -> DataFrame:
    """Declarations per paper in order: fresh cards, else stored cards, else the stored manifest."""
    def rows(df: DataFrame) -> DataFrame:
        return df.where(c.not_blank("lean_decl")).select("paper_id", "pos", "lean_decl")

    fresh = rows(cards)
    stored = rows(old_cards).join(fresh.select("paper_id").distinct(), "paper_id", "left_anti")
    kept = fresh.unionByName(stored)
    listed = manifest.select("paper_id", F.posexplode("declaration_index").alias("pos", "lean_decl"))
    listed = listed.join(kept.select("paper_id").distinct(), "paper_id", "left_anti")
    return kept.unionByName(listed)
