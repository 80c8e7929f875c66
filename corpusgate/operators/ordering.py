"""Order-dependent operators that keep working when one group holds a large share of the rows.

A window over a hot group runs in one task. Where the reference semantics allow it, these
operators use aggregates instead; where a true running value is needed, ``chunk`` splits the group:
a column that never decreases along the order (for example ``floor(pos / 100000)``). Each
``(group, chunk)`` is then windowed on its own and only one row per chunk meets in a second,
small window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusgate.functions import columns as c

CHUNK = "__chunk"


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group. Spark limits each map task to ``k`` per group first."""
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)


def later_duplicates(df: DataFrame, keys: Sequence[str], pos: str, flag: str) -> DataFrame:
    """Flag the second and later holder of a key in list order (first position kept clean)."""
    first = df.where(_all_present(keys)).groupBy(*keys).agg(F.min(pos).alias("__first"))
    joined = df.join(first, list(keys), "left")
    return joined.withColumn(flag, F.coalesce(F.col(pos) > F.col("__first"), F.lit(False))).drop("__first")


def all_duplicates(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Flag every holder of a key that occurs more than once."""
    many = (
        df.where(_all_present(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .select(*keys, F.lit(True).alias("__repeated"))
    )
    return df.join(many, list(keys), "left").withColumn(flag, F.coalesce("__repeated", F.lit(False))).drop("__repeated")


def _all_present(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def row_numbers(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str,
    chunk: Column | None = None,
) -> DataFrame:
    """1-based position of each row in its group."""
    if chunk is None:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    df = df.withColumn(CHUNK, chunk)
    sizes = df.groupBy(*group, CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    before = _before(sizes, group, "__n")
    local = F.row_number().over(W.partitionBy(*group, CHUNK).orderBy(*order))
    return (
        df.withColumn("__local", local)
        .join(before, [*group, CHUNK])
        .withColumn(name, (F.col("__local") + F.col("__before")).cast("long"))
        .drop("__local", "__before", CHUNK)
    )


def _before(parts: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    earlier = W.partitionBy(*group).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    total = F.coalesce(F.sum(value).over(earlier), F.lit(0))
    return parts.select(*group, CHUNK, total.alias("__before"))


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    value: str,
    name: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Sum of ``value`` over the rows strictly before each row of its group."""
    frame = W.unboundedPreceding, -1
    if chunk is None:
        w = W.partitionBy(*group).orderBy(*order).rowsBetween(*frame)
        return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))
    df = df.withColumn(CHUNK, chunk)
    before = _before(df.groupBy(*group, CHUNK).agg(F.sum(value).alias("__s")), group, "__s")
    w = W.partitionBy(*group, CHUNK).orderBy(*order).rowsBetween(*frame)
    return (
        df.withColumn("__local", F.coalesce(F.sum(value).over(w), F.lit(0)))
        .join(before, [*group, CHUNK])
        .withColumn(name, F.col("__local") + F.col("__before"))
        .drop("__local", "__before", CHUNK)
    )


def previous_value(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Value of the preceding row of the group; null for the first row."""
    if chunk is None:
        return df.withColumn(name, F.lag(value).over(W.partitionBy(*group).orderBy(*_cols(order))))
    df = df.withColumn(CHUNK, chunk)
    last = df.groupBy(*group, CHUNK).agg(F.max_by(F.struct(value), F.struct(*order)).alias("__last"))
    last = last.select(
        *group,
        CHUNK,
        F.lag("__last").over(W.partitionBy(*group).orderBy(CHUNK))[value].alias("__carry"),
    )
    inner = W.partitionBy(*group, CHUNK).orderBy(*_cols(order))
    first_row = F.row_number().over(inner) == 1
    return (
        df.withColumn("__prev", F.lag(value).over(inner))
        .withColumn("__head", first_row)
        .join(last, [*group, CHUNK])
        .withColumn(name, F.when(F.col("__head"), F.col("__carry")).otherwise(F.col("__prev")))
        .drop("__prev", "__head", "__carry", CHUNK)
    )


def sequential_keys(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    name: str = "key",
    infix: str = "_card_",
    chunk: Column | None = None,
) -> DataFrame:
    """``<group>_card_001``-style keys; a group of one gets ``_001`` with ``-`` folded to ``_``."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("__size"))
    numbered = row_numbers(df, [group], order, "__idx", chunk).join(counts, group)
    return numbered.withColumn(
        name, numbered_key(F.col(group), F.col("__idx"), F.col("__size"), infix)
    ).drop("__idx", "__size")


def numbered_key(group: Column, idx: Column, size: Column, infix: str = "_card_") -> Column:
    text = idx.cast("string")
    padded = F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text)
    single = F.concat(F.replace(group.cast("string"), F.lit("-"), F.lit("_")), F.lit(infix + "001"))
    return F.when(size > 1, F.concat(group.cast("string"), F.lit(infix), padded)).otherwise(single)


def first_wins(df: DataFrame, key: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """One value per key: the one met first in ``order``."""
    return df.groupBy(*key).agg(F.min_by(value, F.struct(*order)).alias(value))


def last_wins(df: DataFrame, key: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.max_by(value, F.struct(*order)).alias(value))


def first_seen_vocabulary(
    texts: DataFrame,
    group: str,
    order: str,
    text: str,
    cap: int = 24,
    tokens: Column | None = None,
    stopwords: Sequence[str] = c.VOCABULARY_STOPWORDS,
    min_length: int = 2,
) -> DataFrame:
    """Per group the first ``cap`` distinct tokens in reading order, with the form first seen.

    A token among the first ``cap`` of its group is also among the first ``cap`` of the text it first
    appears in, so each text contributes at most that many. The group keeps the smallest place by a
    map-side combined minimum and the cap is a group-limited rank.
    """
    raw = c.identifier_tokens(text) if tokens is None else tokens
    usable = F.filter(
        F.array_distinct("__low"), lambda w: (F.length(w) >= min_length) & ~w.isin(*stopwords)
    )
    forms = F.transform(
        F.slice(usable, 1, cap),
        lambda w: F.struct(w.alias("token"), F.get(F.col("__raw"), F.array_position("__low", w) - 1).alias("raw")),
    )
    placed = (
        texts.select(group, F.col(order).alias("__doc"), raw.alias("__raw"))
        .withColumn("__low", F.transform("__raw", F.lower))
        .select(group, "__doc", F.posexplode(forms).alias("__at", "__w"))
    )
    first = placed.groupBy(group, F.col("__w.token").alias("token")).agg(
        F.min(F.struct("__doc", "__at", F.col("__w.raw").alias("raw_token"))).alias("first")
    )
    return top_k(first, [group], [F.col("first")], cap).select(
        group, "rank", "token", F.col("first.raw_token").alias("raw_token")
    )


def within_budget(
    parts: DataFrame,
    group: str,
    order: str,
    text: str,
    budget: int = 120_000,
    chunk: Column | None = None,
) -> DataFrame:
    """Non-empty parts of a concatenation up to ``budget`` characters; the crossing part is clipped."""
    sized = parts.withColumn("__len", F.length(text).cast("long")).where("__len > 0")
    run = running_total(sized, [group], [F.col(order)], "__len", "__used", chunk)
    left = F.lit(budget) - F.col("__used")
    return (
        run.where(left > 0)
        .withColumn(text, F.substring(F.col(text), F.lit(1), F.least(left, F.col("__len")).cast("int")))
        .drop("__len", "__used")
    )


def budgeted_text(
    parts: DataFrame, group: str, order: str, text: str, budget: int = 120_000, chunk: Column | None = None
) -> DataFrame:
    """One clipped concatenation per group; a group never holds more than ``budget`` characters."""
    kept = within_budget(parts, group, order, text, budget, chunk)
    return kept.groupBy(group).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda s: s[text]), ""
        ).alias(text)
    )


def value_drops(
    history: DataFrame, group: Sequence[str], order: str, value: str
) -> DataFrame:
    """Runs whose value is lower than the run before (trend warning)."""
    prev = previous_value(history, group, [order], value, "previous")
    return prev.where(F.col(value) < F.col("previous"))


def monotone_breaks(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    tol: float = 1e-9,
    chunk: Column | None = None,
) -> DataFrame:
    """Rows whose value falls below the value before it by more than ``tol``."""
    prev = previous_value(df, group, order, value, "previous", chunk)
    return prev.where(F.col("previous") > F.col(value) + F.lit(tol))


def keep_latest(history: DataFrame, order: Sequence[Column], n: int = 100) -> DataFrame:
    """Newest ``n`` rows (top-n, no full sort)."""
    return history.orderBy(*order).limit(n)


def set_once(old: Column, new: Column) -> Column:
    """Keep a timestamp that is already set."""
    return F.coalesce(F.nullif(old, F.lit("")), new)
