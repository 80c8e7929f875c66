"""Comparison of two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.functions import columns as c


def status_changes(base: DataFrame, curr: DataFrame, keys: Sequence[str], status: str) -> DataFrame:
    """Rows whose status appeared, changed or vanished, with ``from`` and ``to``."""
    b = base.select(*keys, F.col(status).alias("__b"), F.lit(True).alias("__in_b"))
    n = curr.select(*keys, F.col(status).alias("__c"), F.lit(True).alias("__in_c"))
    j = b.join(n, list(keys), "full_outer")
    new, gone = F.col("__in_b").isNull(), F.col("__in_c").isNull()
    moved = ~F.col("__b").eqNullSafe(F.col("__c"))
    old_text, new_text = F.coalesce("__b", F.lit("")), F.coalesce("__c", F.lit(""))
    return j.where(new | gone | moved).select(
        *keys,
        F.when(new, "").otherwise(old_text).alias("from"),
        F.when(new, c.filled("__c", "(new)")).when(gone, "(removed)").otherwise(new_text).alias("to"),
    )


def rank_changes(base: DataFrame, curr: DataFrame, keys: Sequence[str], status: str) -> DataFrame:
    """Rows that are new or rose in rank (``new``), or vanished or fell (``broken``)."""
    b = base.select(*keys, F.col(status).alias("from"), F.lit(True).alias("__in_b"))
    n = curr.select(*keys, F.col(status).alias("to"), F.lit(True).alias("__in_c"))
    j = b.join(n, list(keys), "full_outer")
    up = F.col("__in_b").isNull() | (
        F.col("__in_c").isNotNull() & (c.status_rank("to") > c.status_rank("from"))
    )
    down = F.col("__in_c").isNull() | (
        F.col("__in_b").isNotNull() & (c.status_rank("to") < c.status_rank("from"))
    )
    kind = F.when(up, "new").when(down, "broken")
    return j.withColumn("kind", kind).where(F.col("kind").isNotNull()).select(*keys, "kind", "from", "to")


def text_drift(base: DataFrame, curr: DataFrame, keys: Sequence[str], digest: str) -> DataFrame:
    """Ids in both versions whose digest differs; new and removed ids are not drift."""
    b = base.select(*keys, F.col(digest).alias("before"))
    n = curr.select(*keys, F.col(digest).alias("after"))
    return b.join(n, list(keys)).where(F.col("before") != F.col("after"))


def set_changes(base: DataFrame, curr: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys only in one version, tagged ``added`` or ``removed``."""
    b, n = base.select(*keys).distinct(), curr.select(*keys).distinct()
    added = n.join(b, list(keys), "left_anti").withColumn("change", F.lit("added"))
    removed = b.join(n, list(keys), "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def group_changes(
    base: DataFrame, curr: DataFrame, group: str, item: str, status: str, digest: str
) -> DataFrame:
    """Per-group summary of two long snapshots ``(group, item, status, digest)``.

    ``change`` is added, removed or changed; groups without any difference are left out. The item
    detail is in :func:`set_changes`, :func:`status_changes` and :func:`text_drift`.
    """
    b = base.select(group, item, F.col(status).alias("__sb"), F.col(digest).alias("__db"), F.lit(1).alias("__in_b"))
    n = curr.select(group, item, F.col(status).alias("__sc"), F.col(digest).alias("__dc"), F.lit(1).alias("__in_c"))
    j = b.join(n, [group, item], "full_outer")
    in_b, in_c = F.col("__in_b").isNotNull(), F.col("__in_c").isNotNull()
    per_group = j.groupBy(group).agg(
        F.count("__in_b").alias("items_before"),
        F.count("__in_c").alias("items_after"),
        F.count_if(in_c & ~in_b).alias("items_added"),
        F.count_if(in_b & ~in_c).alias("items_removed"),
        F.count_if(in_b & in_c & ~F.col("__sb").eqNullSafe(F.col("__sc"))).alias("status_changed"),
        F.count_if(in_b & in_c & (F.col("__db") != F.col("__dc"))).alias("text_drifted"),
    )
    kind = (
        F.when(F.col("items_before") == 0, "added")
        .when(F.col("items_after") == 0, "removed")
        .when(
            (F.col("items_added") + F.col("items_removed") + F.col("status_changed") + F.col("text_drifted")) > 0,
            "changed",
        )
    )
    return (
        per_group.withColumn("change", kind)
        .where(F.col("change").isNotNull())
        .withColumn("item_delta", F.col("items_after") - F.col("items_before"))
    )
