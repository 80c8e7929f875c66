"""Streams beside plain versions: late rows, pairs over any gap, parents that come later, restarts."""

import tempfile
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusgate.streaming import intake as streaming


@pytest.fixture()
def root():
    return Path(tempfile.mkdtemp(prefix="run-"))


def plain_pairs(events, keep):
    """(key, start, end) of events (second, key, kind), taken in order of time."""
    out, opened = [], {}
    for at, key, kind in sorted(events, key=lambda e: (e[0], e[2] != "start")):
        if key in opened and at > opened[key] + keep:
            del opened[key]
        if kind == "start":
            opened.setdefault(key, at)
        elif kind == "end" and key in opened:
            out.append((key, opened.pop(key), at))
    return sorted(out)


def put(spark, root, part, events):
    df = spark.createDataFrame(events, "s long, u string, kind string").select(F.timestamp_seconds("s").alias("ts"), "u", "kind")
    df.coalesce(1).write.parquet(str(root / f"in/part={part}"))


def run(spark, root, got):
    stream = spark.readStream.schema("ts timestamp, u string, kind string").option("maxFilesPerTrigger", 1).parquet(str(root / "in/part=*"))
    pairs = streaming.latency_pairs(stream, "u", "ts", "kind", "start", "end", "10 seconds", "2 hours")
    take = lambda b, i: got.extend((r["u"], int(r["started"].timestamp()), int(r["ended"].timestamp()), r["seconds"]) for r in b.collect())
    streaming.write_batches(pairs, take, f"pairs-{root.name}").awaitTermination(300)


def test_pairs_over_any_gap_with_late_rows_and_restart(spark, root):
    rng = random.Random(2)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        day = 1_700_000_000
        events = [(day + 3590, "edge", "start"), (day + 3605, "edge", "end"), (day + 5, "far", "start"), (day + 7000, "far", "end")]
        events += [(day + 3, "lost", "start"), (day + 9000, "lost", "end"), (day + 50, "alone", "end"), (day, "never", "start")]
        events += [(day + rng.randrange(9000), f"k{rng.randrange(6)}", rng.choice(["start", "end"])) for _ in range(150)]
        events += [(day + 9500, "z", "other"), (day + 9500, "z", "start"), (day + 20000, "z", "start")]
        arriving = sorted(events, key=lambda e: e[0] + rng.random() * 8)  # at most 8 seconds out of order
        got = []
        put(spark, root, 0, arriving[:60])
        put(spark, root, 1, arriving[60:110])
        run(spark, root, got)
        put(spark, root, 2, arriving[110:])
        put(spark, root, 3, [(day + 30000, "y", "start")])
        run(spark, root, got)  # goes on from the stored state
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = plain_pairs(events, 7200)
    assert sorted(g[:3] for g in got) == want and {"edge", "far"} <= {w[0] for w in want} and "lost" not in {w[0] for w in want}
    assert all(s == e - b for _, b, e, s in got)


def test_a_parent_that_comes_later_leaves_no_orphan(spark, root):
    out = str(root / "ledger")
    parents = {"now": ["a"]}
    table = lambda: spark.createDataFrame([(x,) for x in parents["now"]], "id string")
    assert streaming.open_references(spark, out) is None

    def batch(n, *rows):
        spark.createDataFrame(list(rows), "child string, ref string").coalesce(1).write.parquet(str(root / f"children/part={n}"))
        stream = spark.readStream.schema("child string, ref string").parquet(str(root / "children/part=*"))
        handle = streaming.orphan_ledger(table, {"ref": "id"}, out)
        streaming.write_batches(stream, handle, f"ledger-{root.name}").awaitTermination(120)
        return sorted(r["child"] for r in streaming.open_references(spark, out).collect())

    assert batch(0, ("1", "a"), ("2", "b"), ("3", "c"), ("4", None)) == ["2", "3"]
    parents["now"].append("b")
    assert sorted(r["child"] for r in streaming.settled_orphans(spark, out, table(), {"ref": "id"}).collect()) == ["3"]
    assert batch(1, ("5", "d")) == ["3", "5"]
    parents["now"] += ["c", "d"]
    assert batch(2, ("6", "a")) == []
    # a batch that is run again starts from the version before it
    handle = streaming.orphan_ledger(lambda: table().where("id = 'a'"), {"ref": "id"}, out)
    handle(spark.createDataFrame([("7", "q")], "child string, ref string"), 2)
    assert sorted(r["child"] for r in streaming.open_references(spark, out).collect()) == ["3", "5", "7"]
    # rows without their mark are no version
    spark.createDataFrame([("8", "q")], "child string, ref string").write.parquet(f"{out}/open/batch=9")
    assert streaming.open_references(spark, out).count() == 3
