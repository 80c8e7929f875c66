"""Batch intake of new papers, default records and gold scaffolds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgate.functions import columns as c
from corpusgate.operators import checks


def read_intake_csv(spark: SparkSession, path: str) -> DataFrame:
    """Intake rows from CSV files with a header, which must name ``paper_id``.

    ``place`` tells where a row stands, whatever is shuffled later: its file, block and number there.
    """
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    if "paper_id" not in df.columns:
        raise ValueError("the intake CSV needs a paper_id column")
    for col in ("domain", "title", "year"):
        if col not in df.columns:
            df = df.withColumn(col, F.lit(None).cast("string"))
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    return df.select("paper_id", "domain", "title", "year", place.alias("place"))


def _placed(rows: DataFrame) -> list[str]:
    return [x for x in rows.columns if x == "place"]


def normalized_intake(rows: DataFrame) -> DataFrame:
    """Trimmed rows with a paper id; an absent domain becomes ``other``. A ``place`` is kept."""
    return rows.where(c.not_blank("paper_id")).select(
        c.strip("paper_id").alias("paper_id"),
        c.strip(c.filled("domain", "other")).alias("domain"),
        c.blank_to_null("title").alias("title"),
        c.blank_to_null("year").try_cast("int").alias("year"),
        *_placed(rows),
    )


def intake_violations(rows: DataFrame) -> DataFrame:
    """Rows with an unknown domain or a year that is no number. A dry run is this alone."""
    bad = normalized_intake(rows).where(~c.in_values("domain", c.PAPER_DOMAINS))
    domains = checks.violations(bad, "intake_domain", "paper_id", "paper_id", F.concat(F.lit("invalid domain "), "domain"))
    text = c.blank_to_null("year")
    odd = rows.where(c.not_blank("paper_id") & text.isNotNull() & text.try_cast("int").isNull()).select(
        c.strip("paper_id").alias("paper_id"), text.alias("year")
    )
    years = checks.violations(odd, "intake_year", "paper_id", "paper_id", F.concat(F.lit("invalid year "), "year"))
    return domains.unionByName(years)


def skeletons(ids: DataFrame) -> DataFrame:
    """Default paper record per new id."""
    return ids.select(
        F.col("paper_id").alias("id"),
        F.lit("(no title yet)").alias("title"),
        F.array(F.lit("(unknown)")).alias("authors"),
        F.lit(1900).alias("year"),
        F.lit("other").alias("domain"),
        F.struct(
            F.lit("pdf").alias("kind"),
            F.concat(F.lit("corpus/papers/"), "paper_id", F.lit("/source/source.pdf")).alias("path"),
            F.lit(c.ZERO_DIGEST).alias("sha256"),
        ).alias("source"),
        F.lit("admitted").alias("artifact_status"),
    )


def admit(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """Catalog ``(id, title, year, domain)`` after intake: new papers added, given values overwrite.

    Rows that :func:`intake_violations` names are not admitted. The last row of a repeated id wins field by
    field, as if rows were applied one after another in the order of ``place``, any sortable column.
    Rows without it have no order; of their values the largest wins.
    """
    text = c.blank_to_null("year")
    usable = rows.where(text.isNull() | text.try_cast("int").isNotNull())
    good = normalized_intake(usable).where(c.in_values("domain", c.PAPER_DOMAINS))
    place = F.col("place") if _placed(rows) else F.lit(0)
    last = lambda x: F.max_by(x, F.when(F.col(x).isNotNull(), F.struct(place.alias("place"), F.col(x).alias("value"))))
    latest = (
        good.groupBy("paper_id")
        .agg(
            last("domain").alias("__domain"), last("title").alias("__title"), last("year").alias("__year")
        )
        .withColumnRenamed("paper_id", "id")
    )
    known = catalog.select("id", "title", "year", "domain")
    return known.join(latest, "id", "full_outer").select(
        "id",
        F.coalesce("__title", "title", F.lit("(no title yet)")).alias("title"),
        F.coalesce("__year", "year", F.lit(1900)).alias("year"),
        F.coalesce("__domain", "domain").alias("domain"),
    )


def default_mappings(ids: DataFrame, mapping: DataFrame, root: str) -> DataFrame:
    """An empty mapping row for every paper without one; existing rows stay."""
    fresh = ids.select("paper_id").distinct().join(mapping.select("paper_id"), "paper_id", "left_anti")
    made = fresh.select(
        "paper_id",
        c.default_namespace("paper_id", root).alias("namespace"),
        F.lit(None).cast("string").alias("target_file"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("claim_to_decl"),
    )
    return mapping.select(*made.columns).unionByName(made)


def scaffold_gold(claims: DataFrame, assumptions: DataFrame) -> dict[str, DataFrame]:
    """Reference copies of claims and assumptions and the spans of claims that have one."""
    spans = claims.where(c.not_blank("id") & F.col("source_span").isNotNull()).select(
        "paper_id", F.col("id").alias("claim_id"), "source_span"
    )
    return {"gold_claims": claims, "gold_assumptions": assumptions, "gold_spans": spans}
