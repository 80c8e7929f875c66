"""Mixing sources to target weights by temperature.

The sources' token shares are raised to an exponent between 0 and 1, bisected until the weights reach a
target entropy, or the largest exponent's neighbour that keeps every source within a repetition limit.
The weights become token budgets, and each budget is realised by permuted blocks: whole passes over the
source, then whole blocks in the order of a permutation, then rows of one last block up to the budget.

A row's tokens are its words and one end mark. Rows are placed by hashes, so nothing is sorted but the
block totals of a source (``BLOCKS`` at most) and the rows of its last block.

Defined cases: a null source is a source of its own; a null or empty text has one token; rows that repeat
an id are drawn together; ties of hashes are drawn together, so a budget is missed by less than the rows
of one hash; an empty table gives an empty result; `drawn` keeps other columns, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from corpusgate.session import durable

#: Tokens of a block at least, and blocks of a source at most.
BLOCK_TOKENS, BLOCKS = 50_000, 10_000
#: Exponents tried by one job, and jobs: the exponent is found to 1 / 32 ** 5.
GRID, ROUNDS = 33, 5


@dataclass(frozen=True)
class Target:
    """``entropy``: place of the target between the natural entropy (0) and that of equal weights (1)."""

    entropy: float = 0.5
    repeats: float = 4.0
    budget: float = 1.0  # tokens to draw, as a multiple of those there are
    seed: int = 11


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def tokens(text: Column) -> Column:
    return (F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1).cast("long")


def place(id_col: Column, seed: int) -> Column:
    """Where a row lies in its source: a hash of the id."""
    return F.xxhash64(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("")))


def block_key(block: Column, source: Column, epoch: Column, seed: int) -> Column:
    """Place of a block in the permutation of an epoch."""
    return F.xxhash64(F.lit(seed), source, epoch, block)


def measures(totals: DataFrame, exponents: list[float], top: float) -> dict[float, tuple[float, float]]:
    """Entropy of the weights, and the largest weight over share, of each exponent: one small job."""
    x = F.log(F.col("n") / F.lit(top))
    part = F.exp(F.col("a") * x)
    rows = (
        totals.withColumn("a", F.explode(F.array([F.lit(float(a)) for a in exponents])))
        .groupBy("a")
        .agg(F.sum(part).alias("z"), F.sum(part * x).alias("zx"), F.max(F.exp((F.col("a") - 1) * x)).alias("r"), F.sum("n").alias("all"))
        .collect()  # one row an exponent
    )
    from math import log

    return {r["a"]: (log(r["z"]) - r["a"] * r["zx"] / r["z"], r["r"] / r["z"] * r["all"] / top) for r in rows}


def exponent(totals: DataFrame, target: Target) -> float:
    """Smallest exponent in [0, 1] that keeps to the target entropy and the repetition limit; 1 if none does.

    ``totals``: (source, n). Entropy and repetition both fall as the exponent grows, so one bracket holds.
    """
    bounds = totals.agg(F.max("n").alias("top"), F.count("*").alias("sources")).first()
    if not bounds["sources"]:
        return 1.0
    top = float(bounds["top"])
    ends = measures(totals, [0.0, 1.0], top)
    wanted = ends[1.0][0] + target.entropy * (ends[0.0][0] - ends[1.0][0])
    fits = lambda m: m[0] <= wanted + 1e-12 and m[1] * target.budget <= target.repeats + 1e-12
    if fits(ends[0.0]):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = [low + (high - low) * k / (GRID - 1) for k in range(1, GRID - 1)]
        got = measures(totals, tried, top)
        good = [a for a in tried if fits(got[a])]
        high = min([*good, high])
        low = max([a for a in tried if a < high] + [low])
    return high


def plan(docs: DataFrame, target: Target | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per source: tokens, weight, budget, whole passes, blocks and where the last pass ends.

    One scan of the texts, for the narrow table (source, place, tokens) that everything else reads.
    """
    target = target or Target()
    rows = docs.select(source_key(F.col(source_col)).alias("source"), place(F.col(id_col), target.seed).alias("h"), tokens(F.col(text_col)).alias("n"))
    narrow = durable(rows, "mixing-rows")
    totals = durable(narrow.groupBy("source").agg(F.sum("n").alias("n")), "mixing-totals")
    a = exponent(totals, target)
    whole = totals.agg(F.sum("n").alias("n"), F.max("n").alias("top")).first()
    every, top = float(whole["n"] or 0), float(whole["top"] or 1)
    z = totals.agg(F.sum(F.pow(F.col("n") / top, F.lit(a)))).first()[0] or 1.0
    budgets = (
        totals.withColumn("weight", F.pow(F.col("n") / top, F.lit(a)) / z)
        .withColumn("budget", F.floor(F.col("weight") * F.lit(every * target.budget)))
        .withColumn("passes", F.floor(F.col("budget") / F.col("n")))
        .withColumn("rest", F.col("budget") - F.col("passes") * F.col("n"))
        .withColumn("blocks", F.ceil(F.col("n") / F.greatest(F.lit(float(BLOCK_TOKENS)), F.col("n") / BLOCKS)))
    )
    budgets = durable(budgets, "mixing-budgets")
    placed = narrow.join(budgets.select("source", "blocks", "passes", "rest"), "source").withColumn("block", F.pmod("h", "blocks"))
    sums = placed.groupBy("source", "block").agg(
        F.sum("n").alias("n"), F.first("passes").alias("passes"), F.first("rest").alias("rest")
    )
    keyed = sums.withColumn("key", block_key(F.col("block"), F.col("source"), F.col("passes"), target.seed))
    run = W.Window.partitionBy("source").orderBy("key", "block").rowsBetween(W.Window.unboundedPreceding, 0)
    reached = keyed.withColumn("upto", F.sum("n").over(run))
    last = reached.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest"))).select(
        "source", "block", F.col("key").alias("last_key"), (F.col("rest") - F.col("upto") + F.col("n")).alias("left")
    )
    last = durable(last, "mixing-last")
    inside = placed.select("source", "block", "h", "n").join(last, ["source", "block"]).groupBy("source", "block", "last_key", "left", "h").agg(F.sum("n").alias("n"))
    order = W.Window.partitionBy("source").orderBy("h").rowsBetween(W.Window.unboundedPreceding, 0)
    cut = inside.withColumn("upto", F.sum("n").over(order)).where(F.col("upto") <= F.col("left")).groupBy("source").agg(F.max("h").alias("last_place"))
    out = (
        budgets.join(last.select("source", F.col("block").alias("last_block"), "last_key"), "source", "left")
        .join(cut, "source", "left")
        .withColumn("exponent", F.lit(a))
    )
    return durable(out, "mixing-plan")


def drawn(
    docs: DataFrame, planned: DataFrame, target: Target | None = None, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """(document, epoch, block, key, place): every row once for each time it is drawn.

    ``planned`` has one row per source and is small; Spark's own size check decides whether it is broadcast.
    """
    target = target or Target()
    per = planned.select("source", "passes", "blocks", "last_block", "last_key", "last_place")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("document"))
    rows = rows.withColumn("source", source_key(F.col(f"document.`{source_col}`"))).withColumn("place", place(F.col(f"document.`{id_col}`"), target.seed))
    joined = rows.join(per, "source").withColumn("block", F.pmod("place", "blocks"))
    key = block_key(F.col("block"), F.col("source"), F.col("passes"), target.seed)
    before = (key < F.col("last_key")) | ((key == F.col("last_key")) & (F.col("block") < F.col("last_block")))
    within = (F.col("block") == F.col("last_block")) & (F.col("place") <= F.col("last_place"))
    copies = F.col("passes") + F.coalesce(before | within, F.lit(False)).cast("long")
    times = joined.withColumn("copies", copies).where("copies > 0")
    again = times.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return again.select("document", "epoch", "block", block_key(F.col("block"), F.col("source"), F.col("epoch"), target.seed).alias("key"), "place")


def mixed(
    docs: DataFrame, target: Target | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The documents' own columns, each row as often as its source's budget draws it."""
    planned = plan(docs, target, id_col, text_col, source_col)
    return drawn(docs, planned, target, id_col, source_col).select("document.*")
