"""Referential operators: orphan checks, link resolution, derivation, merges and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgate.functions import columns as c
from corpusgate.operators import ordering
from corpusgate.session import durable


def _present(col: str, dtype: str) -> Column:
    base = F.col(col).isNotNull()
    return base & (F.col(col) != "") if dtype == "string" else base


def orphans(
    child: DataFrame,
    parent: DataFrame,
    on: Mapping[str, str],
    skip_if_parent_empty: bool = False,
    parent_group: Sequence[str] = (),
) -> DataFrame:
    """Child rows whose key has no parent. Null and blank keys are not references.

    With ``skip_if_parent_empty`` a missing parent set silences the check: for the whole table, or
    per group when ``parent_group`` names the parent columns (out of ``on``) that form the group.
    """
    types = dict(child.dtypes)
    for col in on:
        child = child.where(_present(col, types[col]))
    keys = parent.select(*[F.col(p).alias(f"__p_{p}") for p in on.values()])
    cond = [F.col(ch) == F.col(f"__p_{p}") for ch, p in on.items()]
    if skip_if_parent_empty and not parent_group:
        child = child.where(keys.exists())
    elif skip_if_parent_empty:
        groups = keys.select(*[F.col(f"__p_{p}") for p in parent_group]).distinct()
        group_on = [F.col(ch) == F.col(f"__p_{p}") for ch, p in on.items() if p in parent_group]
        child = child.join(groups, group_on, "left_semi")
    return child.join(keys, cond, "left_anti")


def array_orphans(
    child: DataFrame,
    array_col: str,
    parent: DataFrame,
    parent_id: str,
    group: Sequence[str] = (),
    item: str = "ref",
    **kwargs,
) -> DataFrame:
    """Exploded form of :func:`orphans` for an array of references; ``group`` scopes both sides."""
    rows = child.withColumn(item, F.explode(array_col))
    on = {g: g for g in group} | {item: parent_id}
    return orphans(rows, parent, on, parent_group=tuple(group), **kwargs)


def reference_orphans(refs: DataFrame, targets: DataFrame, optional: Sequence[str] = ()) -> DataFrame:
    """Dangling references of many kinds at once, with one join.

    ``refs`` and ``targets`` share ``kind``, ``scope`` and ``ref`` (blank scope for corpus-wide ids).
    References whose kind is in ``optional`` are not judged where their scope has no target at all.
    """
    refs = refs.where(c.not_blank("ref"))
    keys = targets.where(c.not_blank("ref")).select("ref", "scope", "kind").distinct()
    # An outer join, as an anti join would be pushed below the union of reference kinds and read the
    # targets once per kind. The most selective key comes first, so a sort-merge join sorts cheaply.
    marked = refs.join(keys.withColumn("__hit", F.lit(True)), ["ref", "scope", "kind"], "left")
    lost = marked.where(F.col("__hit").isNull()).drop("__hit")
    if not optional:
        return lost
    stocked = keys.where(F.col("kind").isin(list(optional))).select("kind", "scope").distinct()
    must = lost.join(stocked.withColumn("__stocked", F.lit(True)), ["kind", "scope"], "left")
    return must.where(~F.col("kind").isin(list(optional)) | F.col("__stocked")).drop("__stocked")


def key_states(facts: DataFrame) -> DataFrame:
    """What is known of each key: ``(target, scope, ref, n_targets, n_refs)`` by one pre-aggregated shuffle.

    ``facts`` holds ids and references of any number of tables as rows ``(target, scope, ref, kind,
    group_id, row_id)``: ``target`` names the sort of id, ``kind`` the sort of reference and is null for
    the id itself. A key that a third of all rows hold is one row a task before it is shuffled.
    """
    return facts.groupBy("target", "scope", "ref").agg(
        F.count_if(F.col("kind").isNull()).alias("n_targets"), F.count("kind").alias("n_refs")
    )


def referring(facts: DataFrame, keys: DataFrame) -> DataFrame:
    """The references of ``facts`` whose key is in ``keys``, which are distinct.

    Few keys are broadcast by Spark's own measure at run time; beyond it the rows of a much used key are one
    side of a semi join that adaptive execution splits.
    """
    return facts.where(F.col("kind").isNotNull()).join(keys, ["ref", "scope", "target"], "left_semi")


#: Keys that may be broadcast to their references, the most used ones first.
BROADCAST_KEYS = 1_000_000


def dangling(facts: DataFrame, optional: Sequence[str] = (), unwanted: Sequence[str] = ()) -> DataFrame:
    """References whose key has no id, for many sorts of ids at once.

    A sort in ``optional`` is not judged in a scope that has no id of it; of a sort in ``unwanted`` the
    references are returned that do have one. ``facts`` is read a few times: store it. The keys are stored; the
    most used ones, ``BROADCAST_KEYS`` at most, are broadcast, so only references of other keys are shuffled.
    """
    keys = key_states(facts.where(c.not_blank("ref"))).where("n_refs > 0")
    wrong = (F.col("n_targets") == 0) != F.col("target").isin(*unwanted)
    keys = keys.where(wrong)
    if optional:
        stocked = facts.where(F.col("kind").isNull() & F.col("target").isin(*optional) & c.not_blank("ref"))
        stocked = stocked.select("target", "scope").distinct().withColumn("__stocked", F.lit(True))
        keys = keys.join(stocked, ["target", "scope"], "left").where(~F.col("target").isin(*optional) | F.col("__stocked"))
    on = ["ref", "scope", "target"]
    keys = durable(keys.select(*on, "n_refs"), "wrong-keys", "zstd")
    many, rest = _most_used(keys)
    if rest is None:
        return referring(facts, many)
    return referring(facts, many).unionByName(referring(facts.join(many, on, "left_anti"), rest))


def _most_used(keys: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``keys`` split by ``n_refs``: the most used ones, to be broadcast, and the others if there are any.

    Whole powers of two of ``n_refs`` are broadcast, ``BROADCAST_KEYS`` in all at most. ``keys`` is stored.
    """
    used = keys.groupBy(F.floor(F.log2("n_refs")).cast("int").alias("power")).count().collect()  # a row a power of two
    power, held = 62, 0
    for row in sorted(used, reverse=True):
        held += row["count"]
        if held > BROADCAST_KEYS:
            break
        power = row["power"]
    least = F.lit(2**power).cast("long")
    many = F.broadcast(keys.where(F.col("n_refs") >= least))
    return many, None if held <= BROADCAST_KEYS else keys.where(F.col("n_refs") < least)


def lost_links(
    rows: DataFrame, sorts: Sequence[str], kinds: Sequence[tuple[str, str]], everywhere: Sequence[str],
    optional: Sequence[str] = (), unwanted: Sequence[str] = (),
) -> DataFrame:
    """What :func:`dangling` finds, for rows of groups whose references mostly stay in their group.

    ``rows`` is stored: ``(group_id, row_id, pos, sort, link_kinds, links)``, a row of a table with the sort of id
    that its ``row_id`` is (its place in ``sorts``, null for none) and its references, two arrays of one length:
    the place of each in ``kinds``, which pairs a kind's name with the sort it names, and the id. Ids of the sorts
    in ``everywhere`` are known to all rows, others to their group. Returns ``(group_id, row_id, pos, kind, ref)``,
    dealt by ``group_id``: rows are shuffled once, packed, and what is then grouped by ``group_id`` and more is not
    shuffled again.

    Keys of the sorts in ``everywhere`` are aggregated first. The most used ones without an id are broadcast, the
    others are sent to the groups that refer to them, once a group, as if an id of the group marked them.
    """
    places = lambda names: [sorts.index(x) for x in names]
    named = F.array(*[F.lit(sorts.index(x)) for _, x in kinds])
    wide = F.col("sort").isin(*places(everywhere))

    def entries(df: DataFrame) -> DataFrame:
        """A line for each reference, and with a null ``kind`` for each id, each with its ``sort``."""
        both = F.arrays_zip(F.concat(F.array((-1 - F.col("sort")).cast("tinyint")), "link_kinds"), F.concat(F.array("row_id"), "links"))
        lines = df.select("group_id", "row_id", "pos", F.inline(both).alias("kind", "ref")).where(F.col("kind").isNotNull() & c.not_blank("ref"))
        sort = F.when(F.col("kind") < 0, -1 - F.col("kind")).otherwise(F.get(named, F.col("kind")))
        return lines.withColumn("sort", sort).withColumn("kind", F.when(F.col("kind") >= 0, F.col("kind")))

    held = rows.where(F.col("sort").isin(*places(x for x in optional if x in everywhere)) & c.not_blank("row_id"))
    unknown = set(places(everywhere)) & set(places(optional)) - {r["sort"] for r in held.select("sort").distinct().collect()}
    links = entries(rows).where(wide & ~F.col("sort").isin(*unknown))
    keys = links.groupBy("ref", "sort").agg(F.max(F.col("kind").isNull()).alias("known"), F.count("kind").alias("n_refs"))
    keys = keys.where((F.col("n_refs") > 0) & (F.col("known") == F.col("sort").isin(*places(unwanted))))
    many, rest = _most_used(durable(keys.select("ref", "sort", "n_refs"), "wrong-keys", "zstd", release=True))

    # non-null, so that later expressions over the group leave it the column that it is dealt by
    group = F.coalesce("group_id", F.lit("")).alias("group_id")
    dealt = rows.select(group, "row_id", "pos", F.when(~wide, F.col("sort")).alias("sort"), "link_kinds", "links")
    if rest is not None:
        asked = links.where(F.col("kind").isNotNull()).join(many, ["ref", "sort"], "left_anti").select("ref", "sort", "group_id")
        marks = durable(asked.join(rest, ["ref", "sort"], "left_semi").distinct(), "wrong-places", "zstd", release=True)
        empty = lambda x: F.array().cast(dict(dealt.dtypes)[x]).alias(x)
        dealt = dealt.unionByName(
            marks.select(group, F.col("ref").alias("row_id"), F.lit(None).cast("long").alias("pos"), "sort", empty("link_kinds"), empty("links"))
        )
    lines = entries(dealt.repartition("group_id"))
    own = F.max(F.col("kind").isNull())
    # the finer window first: its order serves the other
    lines = lines.withColumn("found", own.over(Window.partitionBy("group_id", "sort", "ref")))
    lines = lines.withColumn("stocked", own.over(Window.partitionBy("group_id", "sort"))).where(F.col("kind").isNotNull())
    lines = lines.join(many.select("ref", "sort", F.lit(True).alias("often")), ["ref", "sort"], "left")
    needless = F.col("sort").isin(*places(optional)) & ~F.col("stocked")
    lost = F.when(wide, F.col("found") | F.col("often").isNotNull()).otherwise((F.col("found") == F.col("sort").isin(*places(unwanted))) & ~needless)
    name = F.get(F.array(*[F.lit(x) for x, _ in kinds]), F.col("kind"))
    return lines.where(lost).select("group_id", "row_id", "pos", name.alias("kind"), "ref")


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Keys held by more than one row."""
    present = df.where(ordering._all_present(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def resolve_links(
    child: DataFrame,
    key: Sequence[str],
    group: Sequence[str],
    links: str,
    parent: DataFrame,
    parent_id: str,
    unresolved: str | None = None,
) -> DataFrame:
    """Split each row's links into resolved (order kept) and unresolved (sorted) by the parent table.

    Returns ``key``, ``group``, ``links`` and ``<links>_unresolved`` (null when none) with counts.
    Rows are regrouped by their own key, so a list is never longer than the row it came from.
    """
    both = F.coalesce(F.col(links), F.array().cast("array<string>"))
    if unresolved:
        both = F.concat(both, F.coalesce(F.col(unresolved), F.array().cast("array<string>")))
    ids = list(dict.fromkeys([*group, *key]))
    rows = child.select(*ids, F.posexplode_outer(F.array_distinct(both)).alias("__at", "__ref"))
    known = parent.select(
        *[F.col(g).alias(f"__g_{g}") for g in group], F.col(parent_id).alias("__pid")
    ).distinct()
    cond = [F.col(g) == F.col(f"__g_{g}") for g in group] + [F.col("__ref") == F.col("__pid")]
    hit = rows.join(known, cond, "left")
    slot = F.struct(F.col("__at"), F.col("__ref"))
    found = F.collect_list(F.when(F.col("__pid").isNotNull(), slot))
    lost = F.collect_set(F.when(F.col("__pid").isNull() & F.col("__ref").isNotNull(), F.col("__ref")))
    out = hit.groupBy(*ids).agg(found.alias("__found"), lost.alias("__lost"))
    return out.select(
        *ids,
        F.transform(F.sort_array("__found"), lambda s: s["__ref"]).alias(links),
        F.when(F.size("__lost") > 0, F.sort_array("__lost")).alias(f"{links}_unresolved"),
        F.size("__found").cast("long").alias(f"{links}_count"),
        F.size("__lost").cast("long").alias(f"{links}_unresolved_count"),
    )


def link_pairs(
    cards: DataFrame, card_id: str, own: str, sources: DataFrame, source_id: str, source_links: str
) -> DataFrame:
    """Distinct ``(card_id, link)`` rows: a card's own links and every source row that names it.

    The long form has no limit on how many sources name one card.
    """
    named = sources.where(c.not_blank(F.col(source_id).cast("string"))).select(
        F.explode(source_links).alias(card_id), F.col(source_id).alias("link")
    )
    mine = cards.select(card_id, F.explode(own).alias("link")).where(c.not_blank("link"))
    known = named.join(cards.select(card_id), card_id, "left_semi")
    return mine.unionByName(known).distinct()


def enrich_links(
    cards: DataFrame, card_id: str, own: str, sources: DataFrame, source_id: str, source_links: str
) -> DataFrame:
    """Cards with :func:`link_pairs` as a sorted list, for lists that fit in a card's row."""
    merged = (
        link_pairs(cards, card_id, own, sources, source_id, source_links)
        .groupBy(F.col(card_id).alias("__cid"))
        .agg(F.sort_array(F.collect_list("link")).alias("__links"))
    )
    empty = F.array().cast(dict(cards.dtypes)[own])
    return (
        cards.join(merged, F.col(card_id) == F.col("__cid"), "left")
        .withColumn(own, F.coalesce("__links", empty))
        .drop("__cid", "__links")
    )


def linking_sources(
    sources: DataFrame, source_links: str, cards: DataFrame, card_id: str, group: Sequence[str]
) -> DataFrame:
    """Per group the source rows that link at least one of its cards (kernel index)."""
    named = sources.withColumn("__cid", F.explode(source_links))
    pairs = cards.select(*group, F.col(card_id).alias("__cid"))
    return named.join(pairs, "__cid").drop("__cid", source_links).distinct()


def carry_over(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    keep_if_set: Sequence[str] = (),
    keep_if_filled: Sequence[str] = (),
    old_order: Sequence[str] = (),
) -> DataFrame:
    """Keep reviewed columns from the previous version of a row, matched by ``keys``.

    ``keep_if_set`` columns win when not null, ``keep_if_filled`` when not blank; of several old
    rows with one key the last one wins. Null and empty keys match each other.
    """
    cols = [*keep_if_set, *keep_if_filled]
    key_exprs = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    named = [e.alias(f"__k{i}") for i, e in enumerate(key_exprs)]
    packed = F.struct(*[F.col(x).alias(f"__o_{x}") for x in cols])
    order = F.struct(*old_order) if old_order else F.lit(0)
    last = (
        old.select(*named, packed.alias("__old"), order.alias("__ord"))
        .groupBy(*[f"__k{i}" for i in range(len(keys))])
        .agg(F.max_by("__old", "__ord").alias("__old"))
    )
    out = new.select("*", *named).join(last, [f"__k{i}" for i in range(len(keys))], "left")
    for col in cols:
        previous = F.col("__old")[f"__o_{col}"]
        if col in keep_if_filled:
            previous = F.nullif(previous, F.lit(""))
        current = F.col(col) if col in new.columns else F.lit(None)
        out = out.withColumn(col, F.coalesce(previous, current))
    return out.drop("__old", *[f"__k{i}" for i in range(len(keys))])


def align_spans(
    corpus: DataFrame, reference: DataFrame, keys: Sequence[str], span: str = "source_span"
) -> DataFrame:
    """Compared rows, differing rows and the error rate (null when nothing is compared)."""
    ref = reference.select(*keys, F.col(span).alias("__ref"))
    joined = corpus.select(*keys, F.col(span).alias("__got")).join(ref, list(keys))
    return joined.agg(
        F.count(F.lit(1)).alias("total_compared"),
        F.count_if(~F.col("__got").eqNullSafe(F.col("__ref"))).alias("alignment_error_count"),
    ).withColumn(
        "alignment_error_rate",
        F.try_divide(F.col("alignment_error_count").cast("double"), F.col("total_compared")),
    )


def missing_routes(expected: DataFrame, actual: DataFrame, path: str = "path") -> DataFrame:
    """Expected pages that were not built."""
    return expected.select(path).distinct().join(actual.select(path), path, "left_anti")


def plan_differences(
    plan: DataFrame, mapping: DataFrame, keys: Sequence[str], value: str, group: str | None = None
) -> DataFrame:
    """Plan rows that the mapping lacks or contradicts.

    With ``group``, a group without any mapping row yields one ``no_mapping`` row instead.
    """
    actual = mapping.select(*keys, F.col(value).alias("actual"))
    joined = plan.select(*keys, F.col(value).alias("expected")).join(actual, list(keys), "left")
    kind = F.when(F.col("actual").isNull(), "missing").when(
        F.col("actual") != F.col("expected"), "mismatch"
    )
    issues = joined.withColumn("kind", kind).where(F.col("kind").isNotNull())
    if group is None:
        return issues
    unmapped = plan.select(group).distinct().join(mapping.select(group), group, "left_anti")
    rows = issues.join(unmapped, group, "left_anti")
    return rows.unionByName(unmapped.withColumn("kind", F.lit("no_mapping")), allowMissingColumns=True)


def upsert(
    existing: DataFrame,
    proposals: DataFrame,
    key: Sequence[str],
    pos: str,
    expect: tuple[str, str] | None = None,
) -> DataFrame:
    """Merge proposals into a keyed list: replaced in place, new rows appended, last value wins.

    ``pos`` is the list position on both sides. With ``expect`` (column, expected column) proposals
    whose two columns differ are left out; :func:`rejected_proposals` returns them.
    """
    if expect:
        proposals = proposals.where(F.col(expect[0]).eqNullSafe(F.col(expect[1])))
    cols = existing.columns
    fields = [x for x in cols if x not in (*key, pos)]
    both = existing.select(*cols, F.lit(0).alias("__side")).unionByName(
        proposals.select(*cols, F.lit(1).alias("__side"))
    )
    place = F.struct("__side", pos)
    out = both.groupBy(*key).agg(
        F.min(place).alias("__place"), F.max_by(F.struct(*fields), place).alias("__row")
    )
    return out.select(
        *key, F.col("__place.__side").alias("appended"), F.col(f"__place.{pos}").alias(pos), "__row.*"
    )


def rejected_proposals(proposals: DataFrame, col: str, expected: str) -> DataFrame:
    return proposals.where(~F.col(col).eqNullSafe(F.col(expected)))


def upsert_preview(existing: DataFrame, merged: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Before and after of every row the merge adds or changes."""
    before = existing.select(*key, F.struct(*cols).alias("before"))
    after = merged.select(*key, F.struct(*cols).alias("after"))
    both = before.join(after, list(key), "full_outer")
    return both.where(~F.col("before").eqNullSafe(F.col("after")))


def merge_entries(existing: DataFrame, updates: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Key-wise override of long-form map entries: updates win, other entries stay."""
    new = updates.select(*keys, F.col(value).alias("__new"))
    return existing.join(new, list(keys), "full_outer").select(
        *keys, F.coalesce("__new", value).alias(value)
    )


def derive_cards(mapping: DataFrame, claims: DataFrame) -> DataFrame:
    """One card per mapped claim, status and reviewer state taken from the claim.

    ``mapping`` has ``paper_id``, ``namespace``, ``target_file`` and the map ``claim_to_decl``; a
    map entry's place gives the card number, so no ordering shuffle is needed.
    """
    entries = mapping.select(
        "paper_id",
        F.coalesce(c.strip("namespace"), F.lit("")).alias("namespace"),
        c.target_path("namespace", "target_file").alias("file_path"),
        F.size("claim_to_decl").alias("__size"),
        F.posexplode("claim_to_decl").alias("__at", "claim_id", "short_decl"),
    )
    status = ordering.last_wins(
        claims.where(c.not_blank("id")).select("paper_id", "pos", F.col("id").alias("claim_id"), "status"),
        ["paper_id", "claim_id"],
        "status",
        ["pos"],
    ).withColumn("__claim", F.lit(True))
    joined = entries.join(status, ["paper_id", "claim_id"], "left")
    proof = F.when(F.col("__claim"), F.coalesce("status", F.lit("mapped"))).otherwise("mapped")
    empty = F.array().cast("array<string>")
    return joined.withColumn("proof_status", proof).select(
        "paper_id",
        F.col("__at").alias("pos"),
        ordering.numbered_key(F.col("paper_id"), F.col("__at") + 1, F.col("__size")).alias("id"),
        "claim_id",
        c.qualified("namespace", "short_decl").alias("lean_decl"),
        "file_path",
        "proof_status",
        c.status_to_boundary("proof_status").alias("verification_boundary"),
        c.derive_reviewer_status("proof_status").alias("reviewer_status"),
        empty.alias("dependency_ids"),
        empty.alias("executable_links"),
    )


def fill_mapping(
    claims: DataFrame, existing: DataFrame, namespaces: DataFrame, target_col: str = "linked_formal_targets"
) -> DataFrame:
    """Complete long-form mapping rows ``(paper_id, claim_id, short_decl)``.

    Non-blank entries stay, missing ones are inferred from the claim's targets or id, and entries
    for claims that no longer exist are kept. ``namespaces`` is ``(paper_id, namespace)``.
    """
    named = claims.where(c.not_blank("id")).join(namespaces, "paper_id", "left")
    inferred = named.groupBy("paper_id", F.col("id").alias("claim_id")).agg(
        F.min_by(c.infer_short_name(target_col, "namespace", "id"), "pos").alias("__inferred")
    )
    kept = existing.select("paper_id", "claim_id", F.col("short_decl").alias("__kept"))
    return kept.join(inferred, ["paper_id", "claim_id"], "full_outer").select(
        "paper_id",
        "claim_id",
        F.coalesce(F.when(c.not_blank("__kept"), F.col("__kept")), "__inferred", "__kept").alias("short_decl"),
    )


def rows_with_links(rows: DataFrame, key: Sequence[str], group: Sequence[str], links: str, parent: DataFrame, parent_id: str) -> DataFrame:
    """Each row beside the parent rows its links name, one output row per link (order in ``link_pos``)."""
    ids = list(dict.fromkeys([*group, *key]))
    refs = rows.select(*ids, F.posexplode(links).alias("link_pos", "__ref"))
    target = parent.withColumnRenamed(parent_id, "__ref")
    joined = refs.join(target, [*group, "__ref"], "inner")
    return joined.withColumnRenamed("__ref", "linked_id")


def card_lookup(keys: DataFrame, cards: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Resolve lookup keys to cards: by card id, else declaration, else claim id or short name.

    ``keys`` has one column ``lookup``; of several matches the strongest kind and then the first
    card (paper, position) wins.
    """
    def index(kind: int, expr: Column, source: DataFrame) -> DataFrame:
        return source.select(
            expr.alias("lookup"),
            F.struct(F.lit(kind).alias("kind"), "paper_id", "pos").alias("__by"),
            F.col("id").alias("card_id"),
        ).where(c.not_blank("lookup"))

    entries = index(0, F.col("id"), cards)
    entries = entries.unionByName(index(1, F.col("lean_decl"), cards))
    entries = entries.unionByName(index(2, F.col("claim_id"), cards))
    entries = entries.unionByName(index(3, c.last_part("lean_decl"), cards))
    hits = keys.select("lookup").distinct().join(entries, "lookup")
    return hits.groupBy("lookup").agg(
        F.min_by(F.struct("card_id", F.col("__by.paper_id").alias("paper_id"), F.col("__by.kind").alias("kind")), "__by").alias("m")
    ).select("lookup", "m.*")


def kernel_lookup(kernels: DataFrame, references: DataFrame) -> DataFrame:
    """Kernels and the papers that reference them; a kernel only referenced becomes a placeholder.

    ``references`` is ``(paper_id, kernel_id)``; one output row per kernel and paper.
    """
    refs = references.where(c.not_blank("kernel_id")).select("kernel_id", "paper_id").distinct()
    own = kernels.withColumnRenamed("id", "kernel_id").withColumn("__known", F.lit(True))
    out = own.join(refs, "kernel_id", "full_outer")
    return out.withColumn(
        "domain", F.when(F.col("__known"), F.col("domain")).otherwise("unknown")
    ).withColumn("placeholder", F.col("__known").isNull()).drop("__known")


def compare_recomputed(
    stored: DataFrame, recomputed: DataFrame, keys: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Stored counters that differ from recomputed ones, one row per metric; null counts as different."""
    def wide(df: DataFrame, name: str) -> DataFrame:
        packed = F.struct(*[F.col(m).cast("double").alias(m) for m in metrics])
        return df.select(*keys, packed.alias(name))

    joined = wide(stored, "__s").join(wide(recomputed, "__r"), list(keys), "left")
    pairs = [
        F.struct(F.lit(m).alias("metric"), F.col(f"__s.{m}").alias("stored"), F.col(f"__r.{m}").alias("expected"))
        for m in metrics
    ]
    differing = F.filter(F.array(*pairs), lambda p: ~p["stored"].eqNullSafe(p["expected"]))
    return joined.select(*keys, F.inline(differing))


def parameter_grid(spark_df: DataFrame, **axes: Sequence[float]) -> DataFrame:
    """Every combination of literal axis values beside each row, by exploding constant arrays."""
    out = spark_df
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(float(v)) for v in values])))
    return out
