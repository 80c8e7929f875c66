"""Incremental forms of intake, row checks and latency on Structured Streaming.

Sources and sinks are the caller's; checkpoints go to the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusgate.functions import columns as c
from corpusgate.operators import checks, linking
from corpusgate.session import checkpoint_dir
from corpusgate.sources import entities


def entity_stream(spark: SparkSession, root: str, entity: str, ddl: str) -> DataFrame:
    """New ``<paper>/<entity>.json`` array files as parsed rows ``(paper_id, pos, raw, fields…)``."""
    files = spark.readStream.format("text").option("wholetext", "true").load(f"{root}/*/{entity}.json")
    path = F.col("_metadata.file_path")
    raw = files.select(F.regexp_extract(path, entities.GROUP, 1).alias("paper_id"), F.col("value").alias("raw"))
    return entities.parse_array(raw, ddl)


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Each key once, remembered for at least ``delay`` of event time."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def row_violations(claims: DataFrame | None = None, cards: DataFrame | None = None) -> DataFrame:
    """Checks that need one row only; they hold no state and work on streams and tables alike."""
    found = []
    if claims is not None:
        found.append(checks.lifecycle(claims))
    if cards is not None:
        found.append(checks.card_review(cards))
    return checks.union_all(found)


def write_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], name: str) -> StreamingQuery:
    """Run ``handle`` on every micro-batch until the available input is used up."""
    folder = f"{checkpoint_dir(stream.sparkSession)}/corpusgate/streams/{name}"
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", folder)
        .trigger(availableNow=True)
        .start()
    )


def table_sink(out: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler that appends to a table; a repeated batch replaces its own rows."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")


def written(spark: SparkSession, out: str) -> DataFrame:
    """The rows of a :func:`table_sink`."""
    return spark.read.parquet(out).drop("batch")


def orphan_sink(parent: Callable[[], DataFrame], on: dict[str, str], out: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler that appends rows without a parent; a repeated batch replaces its own rows."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        lost = linking.orphans(batch, parent(), on)
        lost.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return handle


def open_references(spark: SparkSession, out: str, before: int | None = None) -> DataFrame | None:
    """The last finished version of a ledger of :func:`orphan_ledger`, or None where there is none."""
    try:
        done = spark.read.parquet(f"{out}/done").select(F.col("batch").cast("long"))
    except AnalysisException:
        return None
    if before is not None:
        done = done.where(F.col("batch") < before)
    last = done.agg(F.max("batch")).first()[0]
    return None if last is None else spark.read.parquet(f"{out}/open/batch={last}")


def orphan_ledger(parent: Callable[[], DataFrame], on: dict[str, str], out: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler that keeps the rows whose parent has not come yet, as a versioned table.

    Every batch is judged together with the rows left open before it, so a parent that comes late withdraws
    its rows; only open rows are carried on. A version counts once its mark is written, after its rows: a
    run that is killed between the two leaves the version before, and a repeated batch starts from that.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = open_references(spark, out, batch_id)
        rows = batch if before is None else before.unionByName(batch)
        linking.orphans(rows, parent(), on).write.mode("overwrite").parquet(f"{out}/open/batch={batch_id}")
        spark.range(1).write.mode("overwrite").parquet(f"{out}/done/batch={batch_id}")

    return handle


def settled_orphans(spark: SparkSession, out: str, parent: DataFrame, on: dict[str, str]) -> DataFrame | None:
    """The open rows of a ledger that have no parent now, whenever the last batch was."""
    rows = open_references(spark, out)
    return None if rows is None else linking.orphans(rows, parent, on)


def latency_pairs(
    events: DataFrame, key: str, event_time: str, kind: str, start: str, end: str, delay: str, keep: str
) -> DataFrame:
    """``(key, started, ended, seconds)``: each start of a key with the first end at or after it, over any gap up to ``keep``.

    A start while another is open, and an end while none is, count for nothing. A key's state holds its open
    start and the events that the watermark has not passed; they are taken in order of time once it has, so
    rows up to ``delay`` late fall into place. A start without an end is forgotten ``keep`` after it, by a
    timer, and its state with it.
    """
    most = int(events.sparkSession.sql(f"SELECT unix_micros(timestamp_seconds(0) + interval {keep})").first()[0])
    rows = (
        events.where(F.col(key).isNotNull() & F.col(event_time).isNotNull() & F.col(kind).isin(start, end))
        .withWatermark(event_time, delay)
        .select(F.col(key), F.col(event_time), F.unix_micros(event_time).alias("__at"), (F.col(kind) == start).alias("__start"))
    )

    def paired(own: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        opened, times, starts = state.get if state.exists else (None, [], [])
        waiting = list(zip(times, starts))
        if not state.hasTimedOut:
            for frame in frames:
                waiting += zip(frame["__at"].tolist(), frame["__start"].tolist())
        passed = state.getCurrentWatermarkMs() * 1000
        out, left = [], []
        for at, begins in sorted(waiting, key=lambda w: (w[0], not w[1])):
            if opened is not None and at > opened + most:
                opened = None
            if at >= passed:
                left.append((at, begins))
            elif begins:
                opened = at if opened is None else opened
            elif opened is not None:
                out.append((own[0], opened, at))
                opened = None
        if opened is not None and opened + most < passed and not left:
            opened = None
        if opened is None and not left:
            state.remove()
        else:
            state.update((opened, [a for a, _ in left], [b for _, b in left]))
            wake = min([a for a, _ in left] + ([opened + most] if opened is not None else []))
            state.setTimeoutTimestamp(max(wake // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["key", "started", "ended"])

    kind_of_key = events.schema[key].dataType.simpleString()
    pairs = rows.groupBy(key).applyInPandasWithState(
        paired, f"key {kind_of_key}, started long, ended long", "opened long, times array<long>, starts array<boolean>",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
    return pairs.select(
        F.col("key").alias(key), F.timestamp_micros("started").alias("started"), F.timestamp_micros("ended").alias("ended"),
        ((F.col("ended") - F.col("started")) / 1e6).alias("seconds"),
    )


def latency_stream(
    events: DataFrame, key: str, event_time: str, kind: str, start: str, end: str, delay: str, window: str
) -> DataFrame:
    """Seconds from the first start to the first end event of a key inside an event-time window.

    For pairs that may lie in two windows there is :func:`latency_pairs`.
    """
    seen = lambda v: F.min(F.when(F.col(kind) == v, F.col(event_time)))
    grouped = (
        events.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, window), key)
        .agg(seen(start).alias("started"), seen(end).alias("ended"))
    )
    out = grouped.withColumn("seconds", c.seconds_between("started", "ended"))
    return out.where("seconds >= 0").select(F.col("window.start").alias("window_start"), key, "seconds")
