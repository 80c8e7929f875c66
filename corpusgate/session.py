"""Session settings and durable intermediate tables."""

from __future__ import annotations

import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "corpusgate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, skew-join splitting).

    Nothing here overrides cluster sizing; pass ``conf`` for local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names; where none is set, ``fallback`` or a folder of the warehouse."""
    return spark.conf.get(CHECKPOINT_CONF, None) or fallback or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"


def durable(df: DataFrame, name: str, codec: str | None = None, release: bool = False) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Used where an intermediate is read several times: the table survives lost executors, cuts the
    lineage and, unlike an RDD checkpoint, keeps column pruning and vectorised reads. ``codec`` is the
    compression of large ones; without it the session's is used. With ``release`` the shuffle files of the
    write go as soon as it ends, and not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/corpusgate/{name}-{uuid.uuid4().hex}"
    if release:
        _write_and_release(df, path, codec)
    else:
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def _write_and_release(df: DataFrame, path: str, codec: str | None) -> None:
    """Write by a SQL command: Spark cleans up after those, where told to, but not after a DataFrame's writer."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP_CONF, None)
    options = f" OPTIONS (compression '{codec}')" if codec else ""
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING parquet{options} SELECT * FROM {{df}}", df=df)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def constant_rows(spark: SparkSession, rows: Sequence[tuple], **types: str) -> DataFrame:
    """A small fixed table built inside the JVM; ``types`` names and types the columns."""
    fields = lambda row: [F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, types.items())]
    if not rows:
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in types.items()))
    return spark.range(1).select(F.inline(F.array(*[F.struct(*fields(r)) for r in rows])))
