"""Sinks: table exports, point-in-time snapshots and report files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgate.functions import columns as c

EXPORT_VERSION = "0.3"


def export_tables(tables: Mapping[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """One parquet folder per table and a version marker; nothing passes through the driver."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{path}/{name}")
    spark = next(iter(tables.values())).sparkSession
    marker = spark.range(1).select(F.lit(EXPORT_VERSION).alias("version"))
    marker.write.mode(mode).parquet(f"{path}/export_version")


def commit_version(tables: Mapping[str, DataFrame], path: str) -> str:
    """Publish all tables as one version; returns its id.

    Every run writes a folder of its own under ``versions``. Only when all tables are there is the version
    named, by one file that Spark's committer moves into ``commits``. A run that ends earlier leaves
    readers on the version before, and no run overwrites another's files. Runs that overlap both get a
    version; the one that names its last is current, equal times go by id.
    """
    version = uuid.uuid4().hex
    export_tables(tables, f"{path}/versions/{version}", mode="error")
    spark = next(iter(tables.values())).sparkSession
    names = F.array_sort(F.array(*[F.lit(x) for x in tables]))
    # One row of one partition: one file, which is there as a whole or not at all.
    spark.range(0, 1, 1, 1).select(F.lit(version).alias("version"), F.current_timestamp().alias("committed_at"), names.alias("tables")).write.mode(
        "append"
    ).parquet(f"{path}/commits")
    return version


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Named versions ``(version, committed_at, tables)``; none where nothing was published yet."""
    schema = "version string, committed_at timestamp, tables array<string>"
    try:
        return spark.read.schema(schema).parquet(f"{path}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_version(spark: SparkSession, path: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of one version, by default the current one. All are of the same run, also while others publish."""
    known = versions(spark, path)
    row = (known if version is None else known.where(F.col("version") == version)).agg(
        F.max_by(F.struct("version", "tables"), F.struct("committed_at", "version")).alias("last")
    ).first()["last"]
    if row is None:
        raise ValueError(f"no version {version or ''} under {path}".replace("  ", " "))
    return {name: spark.read.parquet(f"{path}/versions/{row['version']}/{name}") for name in row["tables"]}


def publish_group(df: DataFrame, path: str, group: str = "paper_id") -> None:
    """Replace only the partitions of the groups present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(group)
        .parquet(path)
    )


def baseline_name(baseline_id: str) -> str:
    """A usable baseline name: ``.json`` dropped, no folders, not empty."""
    name = (baseline_id or "last-release").strip().replace("\\", "/").removesuffix(".json")
    if not name or "/" in name or ".." in name:
        raise ValueError(f"invalid baseline id {baseline_id!r}")
    return name


def snapshot_rows(claims: DataFrame, assumptions: DataFrame, cards: DataFrame, manifests: DataFrame) -> DataFrame:
    """Long snapshot ``(paper_id, kind, item_id, status, digest)`` of claims, assumptions, declarations.

    Declarations come from cards, or from the manifest for papers without any. Assumption rows carry
    the digest of their text, so later text drift can be seen.
    """
    null = F.lit(None).cast("string")

    def rows(df: DataFrame, kind: str, item: str | Column, status: Column, digest: Column) -> DataFrame:
        key = F.col(item) if isinstance(item, str) else item
        out = df.select(
            "paper_id", F.lit(kind).alias("kind"), key.alias("item_id"), status.alias("status"), digest.alias("digest")
        )
        return out.where(c.not_blank("item_id"))

    blank = F.lit("")
    held = rows(cards, "declaration", "lean_decl", F.coalesce("proof_status", blank), null)
    listed = manifests.join(held.select("paper_id").distinct(), "paper_id", "left_anti")
    listed = listed.select("paper_id", F.explode("declaration_index").alias("d"))
    return (
        rows(claims, "claim", "id", F.coalesce("status", blank), null)
        .unionByName(rows(assumptions, "assumption", "id", null, c.sha256("text")))
        .unionByName(held)
        .unionByName(rows(listed, "declaration", "d", blank, null))
    )


def write_snapshot(
    rows: DataFrame, path: str, baseline_id: str, snapshot_at: Column | None = None,
    title: str | None = None, narrative: str | None = None, highlights: list[str] | None = None,
) -> None:
    """Store a snapshot under its baseline and its description beside it."""
    name = baseline_name(baseline_id)
    when = c.instant_text(F.current_timestamp()) if snapshot_at is None else snapshot_at
    tagged = rows.withColumn("baseline_id", F.lit(name))
    publish_group(tagged, f"{path}/rows", "baseline_id")
    notes = F.array(*[F.lit(h) for h in highlights]) if highlights else F.array().cast("array<string>")
    info = rows.sparkSession.range(1).select(
        F.lit(title).cast("string").alias("title"), F.lit(narrative).cast("string").alias("narrative"),
        notes.alias("highlights"), when.alias("snapshot_at"), F.lit(name).alias("baseline_id"),
    )
    publish_group(info, f"{path}/info", "baseline_id")


def read_snapshot(spark: SparkSession, path: str, baseline_id: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").where(F.col("baseline_id") == baseline_name(baseline_id))


def list_baselines(spark: SparkSession, path: str) -> DataFrame:
    """Baselines with ``last-release`` first, then by name."""
    info = spark.read.parquet(f"{path}/info")
    return info.orderBy(F.col("baseline_id") != "last-release", "baseline_id")


def write_report(df: DataFrame, path: str) -> None:
    """A report table as JSON lines."""
    df.write.mode("overwrite").json(path)


def markdown_lines(report: DataFrame, title: str, name: str, value: str) -> DataFrame:
    """A small report as markdown text, one heading and one bullet per row (ordered by name)."""
    bullet = F.concat(F.lit("- "), F.col(name), F.lit(": "), F.col(value).cast("string"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(name), bullet.alias("b")))), lambda s: s["b"]), "\n")
    return report.agg(F.concat(F.lit(f"# {title}\n\n"), body).alias("markdown"))


def append_trend(history: DataFrame, entry: DataFrame, keep: int = 100) -> DataFrame:
    """History with the new run added, cut to the newest ``keep`` runs."""
    return history.unionByName(entry).orderBy(F.col("timestamp").desc()).limit(keep)
