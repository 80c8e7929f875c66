"""Symbol tables: normalization, ambiguity flags, vocabulary and dimension suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgate.functions import columns as c
from corpusgate.operators import ordering, similarity

FLAGS = "array<string>"


def _flags(col: str = "ambiguity_flags") -> Column:
    return F.coalesce(F.col(col), F.array().cast(FLAGS))


def normalize_symbols(symbols: DataFrame, group: str = "paper_id", pos: str = "pos") -> DataFrame:
    """Canonical names, default dimensional metadata and the overload flag on later holders of a name."""
    source = F.coalesce(
        F.nullif("normalized_name", F.lit("")), F.nullif("raw_latex", F.lit("")), F.col("id")
    )
    named = symbols.where(c.not_blank("id")).withColumn("normalized_name", c.canonical_name(source))
    flagged = ordering.later_duplicates(named, [group, "normalized_name"], pos, "__later")
    added = F.when(F.col("__later"), F.array(F.lit("overloaded_symbol"))).otherwise(F.array().cast(FLAGS))
    kept = F.filter(F.array_union(_flags(), added), lambda f: F.coalesce(f, F.lit("")) != "")
    return (
        flagged.withColumn("ambiguity_flags", F.sort_array(kept))
        .withColumn("dimensional_metadata", c.with_dimension_defaults("dimensional_metadata"))
        .drop("__later")
    )


def _found_flags(symbols: DataFrame, group: str) -> DataFrame:
    shared = ordering.all_duplicates(
        symbols.withColumn("__name", F.nullif("normalized_name", F.lit(""))), [group, "__name"], "__many"
    )
    unit_open = c.not_blank("dimensional_metadata.dimension") & ~c.not_blank("dimensional_metadata.unit")
    found = F.array(
        F.when(F.col("__many"), F.lit("overloaded_symbol")), F.when(unit_open, F.lit("unit_unclear"))
    )
    return shared.withColumn("__found", F.filter(found, lambda f: f.isNotNull())).drop("__many", "__name")


def suggest_ambiguity(symbols: DataFrame, group: str = "paper_id") -> DataFrame:
    """Symbols with known or newly suggested flags; unknown flags are left out."""
    known = lambda f: f.isin(list(c.AMBIGUITY_FLAGS))
    out = _found_flags(symbols, group)
    flags = F.filter(F.array_union(_flags(), F.col("__found")), known)
    return out.withColumn("suggested_flags", flags).where(F.size("suggested_flags") > 0).drop("__found")


def apply_ambiguity(symbols: DataFrame, group: str = "paper_id") -> DataFrame:
    """All symbols with the union of valid and suggested flags; ``changed`` marks edited rows."""
    known = lambda f: f.isin(list(c.AMBIGUITY_FLAGS))
    out = _found_flags(symbols, group)
    new = F.sort_array(F.array_union(F.filter(_flags(), known), F.col("__found")))
    old = F.sort_array(F.array_distinct(_flags()))
    changed = ~new.eqNullSafe(old)
    return (
        out.withColumn("changed", changed)
        .withColumn("ambiguity_flags", F.when(changed, new).otherwise(F.col("ambiguity_flags")))
        .drop("__found")
    )


def extract_symbols(claims: DataFrame, existing: DataFrame, cap: int = 24) -> DataFrame:
    """First-seen vocabulary of papers that have no symbol table yet."""
    open_claims = claims.join(existing.select("paper_id").distinct(), "paper_id", "left_anti")
    words = ordering.first_seen_vocabulary(open_claims, "paper_id", "pos", "informal_text", cap)
    prefix = F.replace("paper_id", F.lit("-"), F.lit("_"))
    return words.select(
        "paper_id",
        (F.col("rank") - 1).alias("pos"),
        F.concat(prefix, F.lit("_sym_"), "token").alias("id"),
        F.col("raw_token").alias("raw_latex"),
        F.col("token").alias("normalized_name"),
        F.lit("Real").alias("type_hint"),
        F.struct(
            F.lit("unknown").alias("kind"), F.lit("").alias("unit"), F.lit("").alias("dimension")
        ).alias("dimensional_metadata"),
        F.array().cast(FLAGS).alias("ambiguity_flags"),
    )


def dimension_suggestions(symbols: DataFrame, constraints: DataFrame, text: str = "text", pos: str = "pos") -> DataFrame:
    """Unit or dimension for symbols without metadata: first matching constraint, else by name."""
    meta = F.col("dimensional_metadata")
    bare = symbols.where(
        ~(c.not_blank(meta["unit"]) | c.not_blank(meta["dimension"]) | c.not_blank(meta["kind"]))
    ).withColumn("__name", c.strip("normalized_name")).where(c.not_blank("__name"))
    unit = c.unit_from_text(text)
    bounded = F.contains(text, F.lit("in [0, 1]")) | F.contains(text, F.lit("dimensionless"))
    value = F.coalesce(
        F.when(unit.isNotNull(), F.concat(F.lit("unit="), unit)),
        F.when(bounded, F.lit("dimension=dimensionless")),
    )
    match = similarity.first_match(bare, "__name", constraints, text, pos, value)
    joined = bare.join(match.select("__name", F.col("value").alias("__v")), "__name", "left")
    by_name = F.when(c.is_dimensionless_name("__name"), F.lit("dimension=dimensionless,kind=dimensionless"))
    return (
        joined.withColumn("suggested", F.coalesce("__v", by_name))
        .withColumn("source", F.when(F.col("__v").isNotNull(), "kernel").otherwise("heuristic"))
        .where("suggested is not null")
        .drop("__v", "__name")
    )
