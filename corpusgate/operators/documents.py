"""Text-table operators: segmentation, mentions, dependency edges, replacements."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusgate.functions import columns as c
from corpusgate.operators import metrics, similarity
from corpusgate.session import durable

# The source-text patterns that decide what counts as a declaration or an alias.
BLOCK_COMMENT = r"(?s)/-.*?-/"
LINE_COMMENT = r"(?m)--.*?$"
DECLARATION_START = (
    r"(?m)^(?:\s*@\[[^\n]*\]\s*)*(?:theorem|lemma|def|noncomputable\s+def)\s+([a-zA-Z][a-zA-Z0-9_']*)"
)
NAMESPACE_END = r"(?m)^\s*end\s+"
ALIAS = (
    r"(?m)(?:noncomputable\s+def|def)\s+([a-zA-Z][a-zA-Z0-9_']*)\s*:=\s*([a-zA-Z][a-zA-Z0-9_']*)\s*(?:\n|$)"
)
UNFOLD = r"\bunfold\s+([a-zA-Z][a-zA-Z0-9_']*)"
RING_ONLY = r"(?s)^by\s+ring\s*$"
MACRO = (
    r"\\newcommand\s*\{\s*\\?([a-zA-Z]+)\s*\}(?:\[[^\]]*\])?\s*\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}"
)
SHORT_MACRO = r"\\def\s*\\?([a-zA-Z]+)\s*\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}"
MARK = "\u0001"
NAME_END = "\u0002"


def strip_comments(text: Column) -> Column:
    """Text without block comments, then without line comments."""
    return F.regexp_replace(F.regexp_replace(text, BLOCK_COMMENT, ""), LINE_COMMENT, "")


def segments(docs: DataFrame, doc_id: str, text: str, start: str = DECLARATION_START, end: str = NAMESPACE_END) -> DataFrame:
    """Split each document into ``(pos, name, body)`` at the starts matched by ``start``.

    A body runs from the first ``:=`` after the name to the next start or ``end`` line. A start
    without its own ``:=`` takes the body of the next start that has one. The name before it is
    carried as ``previous``.
    """
    marked = F.regexp_replace(F.col(text), start, MARK + "$1" + NAME_END)
    pieces = F.filter(F.split(marked, MARK), lambda p, i: i > 0)
    named = F.transform(
        pieces,
        lambda p: F.struct(
            F.substring_index(p, NAME_END, 1).alias("name"),
            F.substring(p, F.instr(p, F.lit(NAME_END)) + 1, F.length(p)).alias("rest"),
        ),
    )
    has_body = F.filter(
        F.transform("__named", lambda s, i: F.when(F.contains(s["rest"], F.lit(":=")), i)),
        lambda i: i.isNotNull(),
    )
    starts = F.filter(
        F.transform(
            "__named",
            lambda s, i: F.struct(
                s["name"].alias("name"),
                F.when(F.contains(s["rest"], F.lit(":=")), i)
                .otherwise(F.array_min(F.filter("__open", lambda j: j >= i)))
                .alias("at"),
            ),
        ),
        lambda s: s["at"].isNotNull(),
    )
    bodies = F.transform(
        "__starts",
        lambda s, i: F.struct(
            i.alias("pos"),
            s["name"].alias("name"),
            _body(F.get(F.col("__named"), s["at"])["rest"], end).alias("body"),
            F.when(i > 0, F.get(F.col("__starts"), i - 1)["name"]).alias("previous"),
        ),
    )
    # Separate steps keep each array computed once per document.
    return (
        docs.select(doc_id, named.alias("__named"))
        .withColumn("__open", has_body)
        .withColumn("__starts", starts)
        .select(doc_id, F.inline(bodies))
    )


def _body(rest: Column, end: str) -> Column:
    after = F.substring(rest, F.instr(rest, F.lit(":=")) + 2, F.length(rest))
    return F.get(F.split(after, end), F.lit(0))


def _alias_pairs(text: str) -> Column:
    return F.arrays_zip(
        F.regexp_extract_all(text, F.lit(ALIAS), F.lit(2)).alias("symbol"),
        F.regexp_extract_all(text, F.lit(ALIAS), F.lit(1)).alias("local_name"),
    )


def aliases(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``def a := B`` pairs as ``(doc, symbol, local_name)``."""
    return docs.select(doc_id, F.inline(_alias_pairs(text))).distinct()


def dependency_edges(cards: DataFrame, docs: DataFrame, namespace_root: str, keep_self: bool = False) -> DataFrame:
    """Dependency edges of cards read from their source text.

    ``cards`` is ``(paper_id, pos, id, lean_decl, file_path)``, ``docs`` is ``(path, text)``. Returns
    ``(paper_id, card_id, dependency_id, tier)``: tier 1 for qualified, alias and unfold references,
    tier 0 for plain mentions and the previous-declaration rule. Only short names that belong to one
    card of the paper are resolved. A body that names its own card gives no edge; ``keep_self`` keeps
    those rows, as they count for the card's extraction method.

    Rows made by exploding a well-compressed file are many more than its size tells, so every join is
    asked to merge: no side of a row per card goes through the driver as a broadcast.
    """
    held = cards.where(c.not_blank("id") & c.not_blank("lean_decl")).select(
        "paper_id", "pos", F.col("id").alias("card_id"), c.strip("lean_decl").alias("decl"),
        c.last_part(c.strip("lean_decl")).alias("short"), c.strip("file_path").alias("path"),
    )
    unique = (
        held.groupBy("paper_id", "short")
        .agg(F.min("card_id").alias("dep"), F.max("card_id").alias("__hi"), F.min("pos").alias("npos"))
        .where(F.col("dep") == F.col("__hi"))
        .drop("__hi")
    )
    stripped = docs.select("path", strip_comments(F.col("text")).alias("text"))
    segs = segments(stripped, "path", "text")
    last = segs.groupBy("path", "name").agg(F.max_by(F.struct("body", "previous"), "pos").alias("s"))
    alias_lists = stripped.select("path", _alias_pairs("text").alias("aliases"))
    pattern = rf"\b{namespace_root}\.(?:[A-Za-z0-9_][A-Za-z0-9_.']*)\b"
    body = F.col("s.body")
    bodies = (
        held.where(F.col("path") != "")
        .join(last.withColumnRenamed("name", "short").hint("merge"), ["path", "short"])
        .join(alias_lists.hint("merge"), "path")
        .select(
            "paper_id", "card_id", F.col("short").alias("own"), body.alias("body"), F.col("s.previous").alias("previous"),
            F.array_distinct(F.regexp_extract_all(body, F.lit("[a-zA-Z0-9_']+"), F.lit(0))).alias("tokens"),
            F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("decls"),
            "aliases",
        )
    )
    # Only the aliases a body mentions stay with it, so a row never holds more than its own text names.
    hit = F.filter(
        "aliases", lambda al: F.array_contains("tokens", al["symbol"]) & (al["local_name"] != F.col("own"))
    )
    bodies = bodies.withColumn("locals", F.array_distinct(F.transform(hit, lambda al: al["local_name"]))).drop("aliases")
    # Read by several kinds of reference below; segmenting the sources once is what costs here.
    bodies = durable(bodies, "bodies")

    def named(names: Column, kind: str, tier: int) -> Column:
        return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(kind).alias("kind"), F.lit(tier).alias("tier")))

    others = F.filter("tokens", lambda w: w != F.col("own"))
    refs = bodies.select(
        "paper_id", "card_id",
        F.inline(F.concat(named(others, "short", 0), named(F.col("locals"), "short", 1), named(F.col("decls"), "decl", 1))),
    )
    by_decl = held.where(F.col("path") != "").groupBy("paper_id", "decl").agg(F.max_by("card_id", "pos").alias("dep"))
    targets = unique.select("paper_id", F.col("short").alias("name"), F.lit("short").alias("kind"), "dep").unionByName(
        by_decl.select("paper_id", F.col("decl").alias("name"), F.lit("decl").alias("kind"), "dep")
    )
    direct = refs.join(targets.hint("merge"), ["paper_id", "name", "kind"]).select("paper_id", "card_id", "dep", "tier")
    unfolds = bodies.select(
        "paper_id", "card_id", "own", F.explode(F.regexp_extract_all("body", F.lit(UNFOLD), F.lit(1))).alias("u")
    ).distinct()
    shorts = unique.select("paper_id", "short", "npos")
    matched = similarity.prefix_join(unfolds, "u", shorts, "short", "npos", self_name="own", group=["paper_id"])
    by_unfold = matched.join(
        unique.select("paper_id", F.col("short").alias("match"), "dep").hint("merge"), ["paper_id", "match"]
    ).select("paper_id", "card_id", "dep", F.lit(1).alias("tier"))
    found = direct.unionByName(by_unfold)
    hits = durable(found, "references")
    found = hits.where(F.col("dep") != F.col("card_id"))
    lonely = bodies.join(found.select("paper_id", "card_id").distinct().hint("merge"), ["paper_id", "card_id"], "left_anti")
    ring = (
        lonely.where(c.strip("body").rlike(RING_ONLY))
        .join(unique.select("paper_id", F.col("short").alias("previous"), "dep").hint("merge"), ["paper_id", "previous"])
        .where(F.col("dep") != F.col("card_id"))
        .select("paper_id", "card_id", "dep", F.lit(0).alias("tier"))
    )
    return (hits if keep_self else found).unionByName(ring).groupBy("paper_id", "card_id", F.col("dep").alias("dependency_id")).agg(
        F.max("tier").alias("tier")
    )


def with_dependencies(cards: DataFrame, edges: DataFrame) -> DataFrame:
    """Cards with sorted ``dependency_ids`` and the extraction method of their strongest edge.

    Edges of a card to itself count for the method and are no dependency.
    """
    other = F.when(F.col("dependency_id") != F.col("card_id"), F.col("dependency_id"))
    per_card = edges.groupBy("paper_id", F.col("card_id").alias("id")).agg(
        F.sort_array(F.collect_set(other)).alias("__deps"), F.max("tier").alias("__tier")
    )
    tier = F.coalesce("__tier", F.lit(0)).cast("string")
    return (
        cards.drop("dependency_extraction_method")
        .join(per_card.hint("merge"), ["paper_id", "id"], "left")
        .withColumn("dependency_ids", F.coalesce("__deps", F.array().cast("array<string>")))
        .withColumn("dependency_extraction_method", F.concat(F.lit("lean_source_regex_tier"), tier))
        .drop("__deps", "__tier")
    )


def keyword_counts(files: DataFrame, path: str, text: str, words: list[str]) -> DataFrame:
    """Whole-word counts per file and keyword, files without any hit left out."""
    counts = files.select(path, *[c.word_count(text, w).alias(w) for w in words])
    total = sum((F.col(w) for w in words), F.lit(0))
    return counts.where(total > 0)


def keyword_totals(files: DataFrame, text: str, words: list[str], group: str | None = None) -> DataFrame:
    """Files scanned and whole-word totals, per group with a total row when ``group`` is given."""
    counts = files.select(*([group] if group else []), *[c.word_count(text, w).alias(w) for w in words])
    aggs = [F.count(F.lit(1)).alias("files_scanned"), *[F.coalesce(F.sum(w), F.lit(0)).alias(w) for w in words]]
    if not group:
        return counts.agg(*aggs)
    per_group = counts.groupBy(group).agg(*aggs)
    return metrics.with_totals(per_group, group, ["files_scanned", *words])


def headings(
    docs: DataFrame, doc_id: str, text: str, heading: str = r"(?is)<h[1-6][^>]*>(.*?)</h[1-6]>", width: int = 500
) -> DataFrame:
    """One suggested row per heading, numbered in text order; empty headings keep their number.

    ``body`` is the text up to the next heading.
    """
    marked = F.regexp_replace(F.col(text), heading, MARK + "$1" + NAME_END)
    pieces = F.filter(F.split(marked, MARK), lambda p, i: i > 0)
    rows = docs.select(doc_id, F.posexplode(pieces).alias("__at", "__piece"))
    title = c.strip(F.regexp_replace(F.substring_index("__piece", NAME_END, 1), "(?s)<[^>]*>", ""))
    out = rows.select(
        doc_id,
        (F.col("__at") + 1).alias("section"),
        F.substring(title, 1, width).alias("informal_text"),
        F.substring(F.col("__piece"), F.instr("__piece", F.lit(NAME_END)) + 1, F.length("__piece")).alias("body"),
    )
    return out.where(F.col("informal_text") != "")


def formula_symbols(formula: Column, cap: int = 20) -> Column:
    """Candidate symbols of a formula: commands first, then single letters not seen, at most ``cap``."""
    commands = F.regexp_extract_all(formula, F.lit(r"\\([a-zA-Z]+)"), F.lit(1))
    letters = F.regexp_extract_all(formula, F.lit(r"\b([a-zA-Z])\b"), F.lit(1))
    fresh = F.array_except(letters, commands)
    return F.slice(F.concat(commands, fresh), 1, cap)


def section_formulas(
    sections: DataFrame, keys: list[str], body: str, formula: str = r"(?s)\$\$?(.+?)\$\$?", width: int = 500, cap: int = 15
) -> DataFrame:
    """Formulas of each section and at most ``cap`` of their symbols (sorted, so the cap is stable)."""
    found = F.filter(F.regexp_extract_all(body, F.lit(formula), F.lit(1)), lambda f: f != "")
    symbols = F.sort_array(F.array_distinct(F.flatten(F.transform(found, lambda f: formula_symbols(f)))))
    return sections.select(
        *keys,
        F.transform(found, lambda f: F.substring(f, 1, width)).alias("candidate_equations"),
        F.slice(symbols, 1, cap).alias("candidate_symbols"),
    )


def macro_definitions(docs: DataFrame, doc_id: str, text: str, width: int = 200) -> DataFrame:
    """Macro names and definitions; the first definition of a name in a document wins."""
    def found(pattern: str, kind: int) -> Column:
        names = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        defs = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        return F.transform(
            F.arrays_zip(names.alias("n"), defs.alias("d")),
            lambda s, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), s["n"].alias("name"), F.substring(c.strip(s["d"]), 1, width).alias("definition")),
        )

    rows = docs.select(doc_id, F.inline(F.concat(found(MACRO, 0), found(SHORT_MACRO, 1))))
    return rows.groupBy(doc_id, "name").agg(F.min_by("definition", F.struct("kind", "at")).alias("definition"))


def markdown_pairs(docs: DataFrame, doc_id: str, text: str, header: str = "claim") -> DataFrame:
    """First two cells of markdown table rows, back-ticks stripped, rule and header lines skipped."""
    lines = docs.select(doc_id, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("line", "__l"))
    rows = lines.where(F.startswith(c.strip("__l"), F.lit("|")) & ~F.contains("__l", F.lit("---")))
    cells = F.filter(F.transform(F.split("__l", r"\|"), c.strip), lambda x: x != "")
    pairs = rows.withColumn("__c", cells).where(F.size("__c") >= 2)
    key, value = F.get("__c", F.lit(0)), F.regexp_replace(F.get("__c", F.lit(1)), "^`|`$", "")
    named = pairs.select(doc_id, "line", key.alias("key"), value.alias("value")).where(
        (F.col("key") != "") & (F.col("value") != "") & ~F.startswith(F.lower("key"), F.lit(header))
    )
    return named.groupBy(doc_id, "key").agg(F.max_by("value", "line").alias("value"))


def replacement_issues(docs: DataFrame, doc_id: str, text: str, patches: DataFrame, root: str | None = None) -> DataFrame:
    """Patches that are not safe to apply: bad path, missing document, find text absent or not unique.

    ``patches`` is ``(doc, seq, find, replace)``. With ``root`` document ids must be paths under it.
    """
    checked = patches.join(docs.select(doc_id, F.col(text).alias("__t")), doc_id, "left")
    n = c.literal_count("__t", "find")
    issue = F.when(~c.not_blank("find"), "empty_find")
    if root:
        p = F.replace(c.strip(F.col(doc_id)), F.lit("\\"), F.lit("/"))
        safe = F.startswith(p, F.lit(root)) & ~F.contains(p, F.lit(".."))
        issue = F.when(~safe, "unsafe_path").when(~c.not_blank("find"), "empty_find")
    issue = issue.when(F.col("__t").isNull(), "missing_document").when(n == 0, "not_found").when(n > 1, "not_unique")
    return checked.withColumn("issue", issue).withColumn("matches", n).where("issue is not null").drop("__t")


def apply_replacements(docs: DataFrame, doc_id: str, text: str, patches: DataFrame) -> DataFrame:
    """Documents changed by their patches, applied in ``seq`` order.

    A patch whose text does not occur exactly once when its turn comes makes the whole document
    ``rejected`` and leaves it unchanged; so do an empty or null find text and a null document text. A null
    replacement is the empty text, equal ``seq`` go by find and replacement text.

    Patches stay rows: a document and its patches meet in one shuffle, sorted, and pass as a stream, of which
    only the current text is held. The patches of one document are a sequence by definition, so one task runs
    them. Rows that repeat a document id each get all its patches. Documents without patches, patches without
    a document and null ids give no row.
    """
    kind = docs.schema[doc_id].dataType
    wanted = docs.join(patches.select(doc_id), doc_id, "left_semi")
    null = lambda t: F.lit(None).cast(t)
    seq = patches.schema["seq"].dataType
    texts = wanted.select(F.col(doc_id).alias("doc"), F.lit(0).alias("step"), F.col(text).alias("body"), null(seq).alias("seq"), null("string").alias("put"))
    steps = patches.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast(kind).alias("doc"), F.lit(1).alias("step"), F.col("find").alias("body"), "seq", F.col("replace").alias("put")
    )
    stream = texts.unionByName(steps).repartition("doc").sortWithinPartitions("doc", "step", "seq", "body", "put")
    schema = T.StructType([T.StructField("doc", kind), T.StructField("new_text", T.StringType()), T.StructField("rejected", T.BooleanType()), T.StructField("modified", T.BooleanType())])
    return stream.select("doc", "step", "body", "put").mapInArrow(_patched(schema), schema).withColumnRenamed("doc", doc_id)


def _patched(schema: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over sorted (doc, step, body, put) rows: texts first, then their patches."""

    def once(text: str, find: str | None, put: str) -> tuple[str, bool]:
        at = text.find(find) if find else -1
        if at < 0 or text.find(find, at + len(find)) >= 0:
            return text, False
        return text[:at] + put + text[at + len(find) :], True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []  # held: [text now, text at first, still good]
        target = to_arrow_schema(schema)

        def flush() -> Iterator[pa.RecordBatch]:
            for now, first, good in held:
                row = {"doc": current, "new_text": now if good else first, "rejected": not good, "modified": good and now != first}
                yield pa.RecordBatch.from_pylist([row], schema=target)

        for batch in batches:
            for doc, step, body, put in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if doc != current:
                    yield from flush()
                    current, held = doc, []
                if step == 0:
                    held.append([body, body, body is not None])
                    continue
                for state in held:
                    if state[2]:
                        state[0], state[2] = once(state[0], body, put or "")
        yield from flush()

    return run


def replacement_preview(patches: DataFrame, width: int = 200) -> DataFrame:
    """Before and after snippets of each patch."""
    keys = [x for x in patches.columns if x not in ("find", "replace")]
    return patches.select(
        *keys, c.truncated("find", width).alias("before"), c.truncated("replace", width).alias("after")
    )


def proposal_patches(proposals: DataFrame, proposal_id: str | None = None, root: str = "formal/") -> DataFrame:
    """Convertible proposals as patch rows ``(proposal_id, path, seq, find, replace)``."""
    rows = proposals if proposal_id is None else proposals.where(F.col("proposal_id") == proposal_id)
    path = F.replace(c.strip("target_file"), F.lit("\\"), F.lit("/"))
    safe = F.startswith(path, F.lit(root)) & ~F.contains(path, F.lit(".."))
    return rows.where(safe).select(
        "proposal_id", path.alias("path"), F.posexplode("replacements").alias("seq", "r")
    ).select("proposal_id", "path", "seq", F.col("r.find").alias("find"), F.col("r.replace").alias("replace"))


def edit_ready(proposals: DataFrame, docs: DataFrame, root: str = "formal/") -> DataFrame:
    """Proposals that could be applied as they are, as ``(paper_id, proposal_id)`` rows.

    They need replacements, a safe path and every find text exactly once in the stored document
    (``docs`` is ``(path, text)``).
    """
    keys = ["paper_id", "proposal_id"]
    path = F.replace(c.strip("target_file"), F.lit("\\"), F.lit("/"))
    patches = proposals.select(*keys, path.alias("path"), F.posexplode("replacements").alias("seq", "r")).select(
        *keys, "path", "seq", F.col("r.find").alias("find"), F.col("r.replace").alias("replace")
    )
    broken = replacement_issues(docs, "path", "text", patches, root).select(*keys)
    return patches.select(*keys).distinct().join(broken, keys, "left_anti")
