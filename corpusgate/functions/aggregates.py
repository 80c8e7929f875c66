"""Aggregates that stay mergeable: exact medians, order-free fingerprints and checksums of ordered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusgate.functions import columns as c
from corpusgate.operators import ordering
from corpusgate.session import durable

#: Rows of a median's bracket that are ranked in one range of values.
CHUNK_ROWS = 100_000


def multiset_fingerprint(row_digest: Column) -> Column:
    """SHA-256 over the row count and the sums of four 60-bit slices of each row's SHA-256.

    Sums commute, so partial aggregation applies and a group is never sorted or collected. The
    result changes when any row changes, appears, vanishes or is repeated, and not with row order.
    Null digests count for nothing.
    """
    sums = [
        F.sum(F.conv(F.substring(row_digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).cast("string")
        for i in range(4)
    ]
    return F.sha2(F.concat_ws(":", F.count(row_digest).cast("string"), *sums), 256)


def row_digest(*cols: str | Column) -> Column:
    """SHA-256 of the row's values in a fixed text form (null marked apart from empty)."""
    parts = [F.coalesce((F.col(x) if isinstance(x, str) else x).cast("string"), F.lit("\u0000")) for x in cols]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def ordered_checksum(df: DataFrame, order: Sequence[str], digest: str, fan: int = 1_000) -> DataFrame:
    """One row ``(n, checksum)``: a tree of SHA-256 over the rows' digests in order, which a swap of two rows changes.

    Rows are numbered across ranges of the order (each range on its own, with the sum of the ranges before
    it); every ``fan`` neighbours give one digest of the next level, of their digests joined by commas, until
    one is left. No task holds more than a range or ``fan`` digests, and the result does not depend on how the
    rows are cut. ``order`` must tell all rows apart; rows that agree in it go by their digest. An empty table
    has the digest of an empty text.
    """
    rows = df.select(*order, F.coalesce(F.col(digest).cast("string"), F.lit("")).alias("__d"))
    ranged = rows.repartitionByRange(*order, "__d").withColumn("__range", F.spark_partition_id())
    ranged = durable(ranged, "ordered")  # the ranges are cut from a sample: they are stored, so they stay
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__range", F.coalesce(before, F.lit(0)).alias("__start"))  # one row a range
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order, "__d")) - 1
    level = ranged.withColumn("__at", place).join(F.broadcast(starts), "__range").select((F.col("__at") + F.col("__start")).alias("at"), F.col("__d").alias("d"))
    n = ranged.count()
    left = n
    while True:
        parts = level.groupBy(F.floor(F.col("at") / fan).alias("at")).agg(F.sort_array(F.collect_list(F.struct("at", "d"))).alias("s"))
        level = parts.select("at", F.sha2(F.array_join(F.transform("s", lambda x: x["d"]), ","), 256).alias("d"))
        left = -(-left // fan)
        if left <= 1:
            break
    return level.agg(F.lit(n).cast("long").alias("n"), F.coalesce(F.max("d"), F.sha2(F.lit(""), 256)).alias("checksum"))


def exact_median(df: DataFrame, group: Sequence[str], value: str, accuracy: int = 20_000) -> DataFrame:
    """Exact median, minimum, maximum and count of ``value`` per group.

    An approximate percentile brackets the median within ``rows / accuracy`` ranks; only the distinct
    values inside the bracket are then ranked. The bracket is cut into ranges of values by the group's
    row count, each ranked on its own with the sum of the ranges before it.
    """
    df = df.where(F.col(value).isNotNull())
    eps = 2.0 / accuracy
    marks = F.percentile_approx(
        value, F.array(F.lit(0.5 - eps), F.lit(0.5 + eps)), F.lit(accuracy)
    )
    stats = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("count"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        marks.alias("__marks"),
    )
    keys = list(group)
    known = F.struct("__marks", F.col("count").alias("__rows")).alias("__known")
    if keys:
        tagged = df.select(*keys, value).join(stats.select(*keys, known), keys)
    else:
        tagged = df.select(value).withColumn("__known", stats.select(known).scalar())
    tagged = tagged.select(*keys, value, "__known.*")
    low, high = F.col("__marks")[0], F.col("__marks")[1]
    below = F.col(value) < low
    inside = ~below & (F.col(value) <= high)
    counts = tagged.groupBy(*keys).agg(F.count_if(below).alias("__below"))
    chunks = F.ceil(F.col("__rows") * (2 * eps) / CHUNK_ROWS)
    share = F.try_divide((F.col(value) - low).cast("double"), (high - low).cast("double"))
    chunk = F.coalesce(F.floor(share * chunks), F.lit(0)).cast("long")
    distinct = tagged.where(inside).groupBy(*keys, value, chunk.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    ranked = ordering.running_total(distinct, keys, [F.col(value)], "__n", "__cum", F.col("__part"))
    if keys:
        ranked = ranked.join(counts, keys).join(stats.select(*keys, "count"), keys)
    else:
        ranked = ranked.withColumn("__below", counts.scalar()).withColumn(
            "count", stats.select("count").scalar()
        )
    first = F.col("__below") + F.col("__cum") + 1
    last = F.col("__below") + F.col("__cum") + F.col("__n")
    lo, hi = F.floor((F.col("count") + 1) / 2), F.floor(F.col("count") / 2) + 1
    mid = ranked.groupBy(*keys).agg(
        (
            (
                F.max(F.when((first <= lo) & (lo <= last), F.col(value)))
                + F.max(F.when((first <= hi) & (hi <= last), F.col(value)))
            )
            / 2
        ).alias("median")
    )
    out = stats.drop("__marks")
    if keys:
        return out.join(mid, keys)
    return out.withColumn("median", mid.scalar())


def latency_summary(df: DataFrame, start: str, end: str, group: Sequence[str] = ()) -> DataFrame:
    """Exact median, min, max and count of the seconds from start to end; negatives are dropped."""
    seconds = df.withColumn("seconds", c.seconds_between(start, end)).where("seconds >= 0")
    return exact_median(seconds, group, "seconds")
