"""Column expressions: predicates, names, tokens, numbers, digests. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The closed vocabularies of the data model.
CLAIM_STATUSES = (
    "unparsed",
    "parsed",
    "mapped",
    "stubbed",
    "compiles_with_sorries",
    "machine_checked",
    "linked_to_kernel",
    "disputed",
    "superseded",
)
VERIFICATION_BOUNDARIES = (
    "fully_machine_checked",
    "machine_checked_plus_axioms",
    "numerically_witnessed",
    "schema_valid_only",
    "human_review_only",
)
REVIEWER_STATUSES = ("unreviewed", "reviewed", "blocked", "accepted")
REUSE_VALUE_KINDS = (
    "foundational_law",
    "bridge_lemma",
    "executable_contract",
    "cross_paper_anchor",
)
AMBIGUITY_FLAGS = ("overloaded_symbol", "unit_unclear", "scope_unclear", "role_unclear")
PAPER_DOMAINS = (
    "chemistry",
    "mathematics",
    "physics",
    "probability",
    "control",
    "quantum_information",
    "other",
)
DIMENSIONLESS_NAMES = ("theta", "alpha", "beta", "gamma", "coverage", "ratio")
STATUS_RANK = {
    "unparsed": 0,
    "parsed": 1,
    "mapped": 2,
    "stubbed": 3,
    "compiles_with_sorries": 4,
    "machine_checked": 5,
    "linked_to_kernel": 6,
    "disputed": -1,
    "superseded": -1,
}
UNKNOWN_STATUS_RANK = -2
EDIT_KIND_ALIASES = {
    "proof_improvement": "proof_repair",
    "proof_fix": "proof_repair",
    "proof_refactor": "proof_repair",
    "new_lemma": "lemma_extraction",
}
VOCABULARY_STOPWORDS = (
    "the",
    "and",
    "for",
    "with",
    "from",
    "that",
    "this",
    "when",
    "then",
    "into",
    "over",
    "paper",
    "claim",
)
ZERO_DIGEST = "0" * 64
WHITESPACE = " \t\r\n\f\x0b"

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- truthiness -------------------------------------------------------------------------------


def has_items(arr: ColumnOrName) -> Column:
    """True for a non-empty array; null and empty arrays are both false."""
    return F.coalesce(F.size(_c(arr)), F.lit(0)) > 0


def count_items(arr: ColumnOrName) -> Column:
    return F.coalesce(F.size(_c(arr)), F.lit(0)).cast("long")


def strip(text: ColumnOrName) -> Column:
    return F.btrim(_c(text), F.lit(WHITESPACE))


def not_blank(text: ColumnOrName) -> Column:
    return F.coalesce(strip(text) != "", F.lit(False))


def blank_to_null(text: ColumnOrName) -> Column:
    return F.nullif(strip(text), F.lit(""))


def filled(text: ColumnOrName, default: ColumnOrName) -> Column:
    """``text`` unless it is null or empty, else ``default``."""
    other = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(_c(text), F.lit("")), other)


def in_values(col: ColumnOrName, values: Sequence[str]) -> Column:
    """Membership that is false, not null, for a null value."""
    return F.coalesce(_c(col).isin(list(values)), F.lit(False))


def span_complete(span: ColumnOrName) -> Column:
    """Evidence span with file, start and end all present."""
    s = _c(span)
    return (
        F.coalesce(s["source_file"] != "", F.lit(False))
        & s["start"].isNotNull()
        & s["end"].isNotNull()
    )


# --- names ------------------------------------------------------------------------------------


def _squeezed(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(strip(text)), "[^a-z0-9]+", "_"), F.lit("_"))


def canonical_name(text: ColumnOrName) -> Column:
    """Lower-cased name with every other run of characters folded to one underscore."""
    return filled(_squeezed(_c(text)), "symbol")


def identifier(text: ColumnOrName) -> Column:
    """Like :func:`canonical_name`, safe as an identifier: never empty, never digit-first."""
    name = filled(_squeezed(_c(text)), "unnamed")
    return F.when(name.rlike("^[0-9]"), F.concat(F.lit("c_"), name)).otherwise(name)


def last_part(dotted: ColumnOrName) -> Column:
    return F.substring_index(_c(dotted), ".", -1)


def default_namespace(
    group_id: ColumnOrName,
    root: str,
    topic: str | None = None,
    topic_root: str | None = None,
) -> Column:
    """``root.<id>`` with ``-`` and ``.`` folded to ``_``.

    Ids containing ``topic`` get ``topic_root.<CamelCase part before _topic><last four digits>``.
    """
    safe = F.translate(_c(group_id), "-.", "__")
    plain = F.concat(F.lit(root + "."), safe)
    if not topic:
        return plain
    head = F.split(F.substring_index(safe, "_" + topic, 1), "_")
    camel = F.array_join(
        F.transform(
            head,
            lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(p.substr(F.lit(2), F.length(p)))),
        ),
        "",
    )
    year = filled(F.right(F.regexp_replace(safe, "[^0-9]", ""), F.lit(4)), "Paper")
    special = F.concat(F.lit((topic_root or root) + "."), camel, year)
    return F.when(F.contains(safe, F.lit(topic)), special).otherwise(plain)


def target_path(
    namespace: ColumnOrName,
    explicit: ColumnOrName | None = None,
    folder: str = "formal",
    extension: str = "lean",
) -> Column:
    """Explicit path when given, else the namespace as a path; empty for an empty namespace."""
    ns = strip(namespace)
    inferred = F.when(
        F.coalesce(ns, F.lit("")) == "", F.lit("")
    ).otherwise(F.concat(F.lit(folder + "/"), F.replace(ns, F.lit("."), F.lit("/")), F.lit("." + extension)))
    return inferred if explicit is None else F.coalesce(blank_to_null(explicit), inferred)


def infer_short_name(
    targets: ColumnOrName, namespace: ColumnOrName, row_id: ColumnOrName, marker: str = "_claim_"
) -> Column:
    """Short declaration name: first non-blank target without namespace, else from the row id."""
    ns = F.coalesce(_c(namespace), F.lit(""))
    first = F.get(F.filter(F.transform(_c(targets), strip), lambda t: t != ""), F.lit(0))
    prefix = F.concat(ns, F.lit("."))
    from_target = F.when(
        (ns != "") & F.startswith(first, prefix),
        F.substring(first, F.length(prefix) + 1, F.length(first)),
    ).otherwise(last_part(first))
    rid = filled(_c(row_id), "claim")
    from_id = F.concat(F.lit("claim_"), identifier(F.substring_index(rid, marker, -1)))
    return F.coalesce(from_target, from_id)


def qualified(namespace: ColumnOrName, short: ColumnOrName) -> Column:
    ns = F.coalesce(strip(namespace), F.lit(""))
    return F.when(ns == "", _c(short)).otherwise(F.concat(ns, F.lit("."), _c(short)))


# --- status rules -----------------------------------------------------------------------------


def status_to_boundary(status: ColumnOrName) -> Column:
    s = _c(status)
    return (
        F.when(s == "machine_checked", "fully_machine_checked")
        .when(s == "linked_to_kernel", "numerically_witnessed")
        .otherwise("human_review_only")
    )


def derive_reviewer_status(status: ColumnOrName) -> Column:
    s = _c(status)
    return (
        F.when(s == "machine_checked", "accepted")
        .when(s == "linked_to_kernel", "reviewed")
        .otherwise("unreviewed")
    )


def suggest_boundary(boundary: ColumnOrName) -> Column:
    b = strip(boundary)
    return F.when(in_values(b, VERIFICATION_BOUNDARIES), b).otherwise("human_review_only")


def needs_repair(status: ColumnOrName, boundary: ColumnOrName) -> Column:
    s, b = F.coalesce(strip(status), F.lit("")), F.coalesce(strip(boundary), F.lit(""))
    return ~((s == "machine_checked") & (b == "fully_machine_checked"))


def suggested_action(status: ColumnOrName, boundary: ColumnOrName) -> Column:
    s, b = F.coalesce(strip(status), F.lit("")), F.coalesce(strip(boundary), F.lit(""))
    return (
        F.when(s.isin("stubbed", "compiles_with_sorries"), "consider_completing_proof")
        .when(b == "human_review_only", "consider_machine_verification")
        .when(b == "machine_checked_plus_axioms", "consider_axiom_reduction")
        .when(s != "machine_checked", "consider_completing_proof")
        .otherwise("consider_review")
    )


def status_rank(status: ColumnOrName) -> Column:
    s = _c(status)
    out = None
    for name, rank in STATUS_RANK.items():
        out = F.when(s == name, rank) if out is None else out.when(s == name, rank)
    return out.otherwise(UNKNOWN_STATUS_RANK)


def default_value_kind(claim_type: ColumnOrName, current: ColumnOrName) -> Column:
    """Current kind where present; laws and definitions are foundational, the rest bridges."""
    law = in_values(strip(claim_type), ("definition", "theorem", "conservation_law"))
    return F.when(not_blank(current), _c(current)).otherwise(
        F.when(law, "foundational_law").otherwise("bridge_lemma")
    )


def normalize_category(col: ColumnOrName, aliases: dict[str, str] | None = None) -> Column:
    """Trimmed lower-case category with known aliases replaced."""
    key = F.lower(strip(col))
    out = key
    for alias, kind in (aliases or EDIT_KIND_ALIASES).items():
        out = F.when(key == alias, kind).otherwise(out)
    return out


def with_dimension_defaults(meta: ColumnOrName) -> Column:
    """Fill a missing dimensional struct or its missing fields; present values stay."""
    m = _c(meta)
    return F.struct(
        F.coalesce(m["kind"], F.lit("unknown")).alias("kind"),
        F.coalesce(m["unit"], F.lit("")).alias("unit"),
        F.coalesce(m["dimension"], F.lit("")).alias("dimension"),
    )


def is_dimensionless_name(name: ColumnOrName) -> Column:
    n = F.lower(_c(name))
    return n.isin(*DIMENSIONLESS_NAMES) | F.replace(n, F.lit("_"), F.lit("")).isin(*DIMENSIONLESS_NAMES)


def unit_from_text(text: ColumnOrName, width: int = 80) -> Column:
    """Unit named after ``in`` / ``unit`` / ``as`` in a constraint; null when none is stated."""
    t = _c(text)
    found = F.regexp_extract(t, r"(?i)\b(?:in|unit|as)\s+\[?([^\]]+)\]?", 1)
    return F.when(
        ~F.contains(t, F.lit("non-negative")), F.nullif(F.substring(strip(found), 1, width), F.lit(""))
    )


# --- text -------------------------------------------------------------------------------------


def alnum_tokens(text: ColumnOrName) -> Column:
    """Lower-cased ``[a-z0-9]+`` tokens in text order (overlap scoring)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit("[a-z0-9]+"), F.lit(0))


def word_tokens(text: ColumnOrName) -> Column:
    """Lower-cased ``[a-z0-9_]+`` tokens in text order (near-duplicate comparison)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit("[a-z0-9_]+"), F.lit(0))


def identifier_tokens(text: ColumnOrName) -> Column:
    """Words that start with a letter, case kept (vocabulary extraction)."""
    return F.regexp_extract_all(_c(text), F.lit(r"\b[a-zA-Z][a-zA-Z0-9_]*\b"), F.lit(0))


def truncated(text: ColumnOrName, width: int, marker: str = "...") -> Column:
    t = _c(text)
    return F.when(F.length(t) > width, F.concat(F.substring(t, 1, width), F.lit(marker))).otherwise(t)


def literal_count(text: ColumnOrName, find: ColumnOrName) -> Column:
    """Non-overlapping occurrences of a literal; 0 for an empty one."""
    t, f = _c(text), _c(find)
    removed = F.length(t) - F.length(F.replace(t, f, F.lit("")))
    return F.when(F.length(f) > 0, (removed / F.length(f)).cast("long")).otherwise(F.lit(0).cast("long"))


def word_count(text: ColumnOrName, word: str) -> Column:
    """Whole-word occurrences; a word character next to it makes it another word."""
    return F.regexp_count(_c(text), F.lit(rf"(?<![A-Za-z0-9_]){word}(?![A-Za-z0-9_])")).cast("long")


def format_pairs(pairs: ColumnOrName, first: str, second: str) -> Column:
    """``a: b, c: d`` from an array of two-field structs."""
    return F.array_join(
        F.transform(_c(pairs), lambda p: F.concat(p[first], F.lit(": "), p[second])), ", "
    )


def json_object_text(text: ColumnOrName) -> Column:
    """The outermost ``{...}`` of noisy text, looking inside a code fence first; null if none."""
    t = strip(text)
    fenced = F.regexp_extract(t, r"(?is)```(?:json)?\s*(.*?)```", 1)
    s = F.when(t.rlike(r"(?is)```(?:json)?\s*(.*?)```"), strip(fenced)).otherwise(t)
    start = F.instr(s, F.lit("{"))
    tail = F.instr(F.reverse(s), F.lit("}"))
    end = F.length(s) - tail + 1
    return F.when((start > 0) & (tail > 0) & (end > start), F.substring(s, start, end - start + 1))


# --- numbers ----------------------------------------------------------------------------------


def ratio(num: ColumnOrName, den: ColumnOrName, empty: float = 0.0) -> Column:
    """``num / den``; ``empty`` when the denominator is zero or missing."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(empty))


def f1(precision: ColumnOrName, recall: ColumnOrName) -> Column:
    p, r = _c(precision), _c(recall)
    return ratio(p * r * 2.0, p + r)


def jaccard(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Jaccard of two arrays read as sets; two empty sets score 0."""
    inter = F.size(F.array_intersect(_c(a), _c(b)))
    return ratio(inter, F.size(F.array_union(_c(a), _c(b))))


def is_close(
    a: ColumnOrName, b: ColumnOrName, rel_tol: float = 1e-9, abs_tol: float = 1e-12
) -> Column:
    x, y = _c(a), _c(b)
    bound = F.greatest(F.greatest(F.abs(x), F.abs(y)) * rel_tol, F.lit(abs_tol))
    return F.abs(x - y) <= bound


def saturating_ratio(k: ColumnOrName, p: ColumnOrName) -> Column:
    """``K*P / (1 + K*P)``; 0 where the denominator vanishes."""
    kp = _c(k) * _c(p)
    return ratio(kp, kp + 1.0)


def power_law(k: ColumnOrName, c: ColumnOrName, n: ColumnOrName) -> Column:
    """``k * c^(1/n)``; NaN outside its domain or for non-finite input."""
    kk, cc, nn = (_c(x).cast("double") for x in (k, c, n))

    def finite(x: Column) -> Column:
        return ~F.isnan(x) & (F.abs(x) < float("inf"))

    ok = (cc > 0) & (nn != 0) & finite(kk) & finite(cc) & finite(nn)
    return F.when(ok, kk * F.pow(cc, F.try_divide(F.lit(1.0), nn))).otherwise(F.lit(float("nan")))


# --- digests and time -------------------------------------------------------------------------


def sha256(value: ColumnOrName) -> Column:
    return F.sha2(_c(value).cast("binary"), 256)


def fnv1a_hex(text: ColumnOrName) -> Column:
    """32-bit FNV-1a over the code points of ``text`` (equals the UTF-16 form inside the BMP)."""
    codes = F.transform(
        F.filter(F.split(_c(text), ""), lambda ch: ch != ""), lambda ch: F.ascii(ch).cast("long")
    )
    folded = F.aggregate(
        codes,
        F.lit(2166136261).cast("long"),
        lambda h, c: (h.bitwiseXOR(c) * F.lit(16777619).cast("long")).bitwiseAND(
            F.lit(4294967295).cast("long")
        ),
    )
    return F.lower(F.hex(folded))


def parse_instant(text: ColumnOrName) -> Column:
    """ISO-8601 string to a timestamp; null when it cannot be read."""
    return F.try_to_timestamp(_c(text))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Seconds from start to end, null where one cannot be read; zone-less ones are in the session time zone."""
    first, last = (F.unix_micros(_c(x).try_cast("timestamp")) for x in (start, end))
    return (last - first) / F.lit(1_000_000.0)


def instant_text(ts: ColumnOrName) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")
