"""Grouped prefix join of documents by the Jaccard similarity of their word shingles.

1. Document frequencies of all shingles are counted exactly: tasks count their own shingles first and send
   sorted, delta-coded runs of distinct hashes with counts by range, so a shingle that a third of all
   documents hold is one number a run; a range is summed at once. The most frequent are marked in a bitmap of fixed size,
   which only decides that they come last in the order of shingles; any such order gives exact results.
2. Documents with equal sets become one class, classes with equal prefixes and sizes one group.
3. Groups meet on prefix shingles: first each with the most central one of a shingle, which settles
   large families of near copies; verified links give components. Then classes of different components
   that share a prefix shingle meet, under the size and position filters.
4. Candidate pairs are verified on whole shingle sets. A hot leader's pairs are salted.

Defined cases: null texts and texts without a word have an empty set and link with nothing; fewer words
than a shingle are one shingle; repeated rows and equal texts are one class; a null id never becomes a
component's id unless all its ids are null; an empty table gives an empty result; other columns are not
read, and `deduplicated` keeps them. `deduplicated` decides row by row and keeps one row of each component,
also where ids are null or repeated; rows without a shingle are no copies and all stay.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from corpusgate.llm import texts
from corpusgate.llm.shipping import ship
from corpusgate.session import durable

WORDS, PERCENT = 5, 80
#: Documents with a shingle from which on it counts as frequent, bits of the bitmap, and marked slots at most.
FREQUENT, BITS, MARKED = 8, 27, 1 << 23
#: Text bytes whose shingles one counting task takes.
RANGE_BYTES = 12 << 20
#: Ids that may be broadcast, and members of a leader that one task verifies.
BROADCAST_IDS, CELL = 1_000_000, 256


def shingle_sets(rows: list[bytes], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): the distinct shingles of each document, in the order of their hashes."""
    words = [t.translate(texts.LOWER).split() for t in rows]
    off, codes, distinct = texts.numbered(words)
    hashes = texts.word_hashes(distinct)[codes]
    doc = texts.owner(off)
    parts, docs = [], []
    n = np.diff(off)
    at = texts.inside(off, size)
    parts.append(texts.rolled(hashes, size)[at])
    docs.append(doc[at])
    for k in range(1, size):  # whole sequences of fewer words
        short = off[:-1][n == k]
        parts.append(texts.mixed(texts.rolled(hashes, k)[short] + np.uint64(k)) if len(short) else np.empty(0, np.uint64))
        docs.append(np.flatnonzero(n == k))
    key, doc = np.concatenate(parts), np.concatenate(docs)
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]) if len(key) else np.zeros(0, bool)
    key, doc = key[new], doc[new]
    return np.searchsorted(doc, np.arange(len(rows) + 1)), key


def set_keys(off: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums of scattered shingles: 128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        return tuple(texts.summed(texts.mixed(key * m), off).astype(np.int64) for m in (texts.M1, texts.M3))


def _coded(sorted_: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences."""
    steps = np.diff(sorted_, prepend=np.uint64(0))
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _decoded(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def frequent(docs: DataFrame, words: int = WORDS) -> bytes:
    """Bitmap over the upper ``BITS`` bits of the hashes of frequent shingles; exact counts over all documents.

    Of each range of hashes the ``MARKED`` / ranges most frequent are marked, so the bitmap (16 MB) never
    fills, however many documents there are. ``docs``: a column text.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 << max(0, int(np.ceil(np.log2(max(1, size / RANGE_BYTES)))))
    ranges = min(ranges, 1 << BITS)
    shift = np.uint64(56 - int(np.log2(ranges))) if ranges > 1 else None
    most = max(1, MARKED // ranges)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in texts.slices(batches):
            held.append(shingle_sets(texts.raw(part), words)[1])
            if sum(map(len, held)) > 1_000_000:
                yield pack(held)
                held = []
        if held:
            yield pack(held)

    def pack(held: list[np.ndarray]) -> pa.RecordBatch:
        every = np.sort(np.concatenate(held)) >> np.uint64(8)  # 56 bits tell shingles apart when they are counted
        start = starts(every)
        kind, n = every[start], np.diff(start, append=len(every)).astype("<u4")
        home = (kind >> shift).astype(np.int64) if shift is not None else np.zeros(len(kind), np.int64)
        ends = np.searchsorted(home, np.arange(ranges + 1))
        used = np.flatnonzero(np.diff(ends))
        blobs = [_coded(kind[ends[r] : ends[r + 1]]) for r in used]
        counts = [zlib.compress(n[ends[r] : ends[r + 1]].tobytes(), 1) for r in used]
        columns = [pa.array(used.astype(np.int64)), pa.array(blobs, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["home", "run", "counts"])

    def starts(sorted_: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate([np.ones(min(1, len(sorted_)), bool), sorted_[1:] != sorted_[:-1]]))

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        every = np.concatenate([_decoded(x) for x in batch["run"]])
        n = np.concatenate([np.frombuffer(zlib.decompress(x), "<u4") for x in batch["counts"]])
        order = np.argsort(every, kind="stable")
        every, n = every[order], n[order]
        start = starts(every)
        n = np.add.reduceat(n, start, dtype=np.int64) if len(start) else np.zeros(0, np.int64)
        some = n >= FREQUENT
        kind, n = every[start][some], n[some]
        if len(kind) > most:
            kind = kind[np.argsort(-n, kind="stable")[:most]]
        slots = np.unique(kind >> np.uint64(56 - BITS)).astype(np.int64)
        return pd.DataFrame({"slots": [slots.astype("<u4").tobytes()]})

    ship(docs.sparkSession)
    runs = texts.arrow(docs, send, "home long, run binary, counts binary")
    slots = runs.groupBy("home").applyInPandas(count, "slots binary")
    bitmap = np.zeros(1 << (BITS - 3), np.uint8)
    for row in slots.toLocalIterator():  # at most MARKED numbers of 4 bytes in all
        slot = np.frombuffer(row["slots"], "<u4")
        np.bitwise_or.at(bitmap, slot >> 3, np.uint8(128) >> (slot & 7).astype(np.uint8))
    return bitmap.tobytes()


class Order:
    """Puts the shingles of each document in the common order: not frequent before frequent, then by hash."""

    def __init__(self, bitmap: bytes) -> None:
        self.bits = np.frombuffer(bitmap, np.uint8)

    def marked(self, key: np.ndarray) -> np.ndarray:
        slot = key >> np.uint64(64 - BITS)
        return (self.bits[slot >> np.uint64(3)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1 > 0


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Shingles of a set of ``n`` of which one at least is in every set it can link with."""
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def prefixes(docs: DataFrame, bitmap: Broadcast, words: int, percent: int) -> DataFrame:
    """(id, n, k1, k2, cold, hot): set size, set key and the prefix, frequent shingles apart."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(bitmap.value)
        for part in texts.slices(batches):
            off, key = shingle_sets(texts.raw(part), words)
            n = np.diff(off)
            k1, k2 = set_keys(off, key)
            hot = order.marked(key)
            cold_n = texts.summed(~hot, off)
            want = prefix_size(n, percent)
            take = np.minimum(want, cold_n), np.maximum(want - cold_n, 0)
            lists = []
            for mask, most in zip((~hot, hot), take):
                rank = np.cumsum(mask) - 1
                own = texts.owner(off)
                first = np.concatenate([[0], np.cumsum(mask)])[off[:-1]]
                chosen = mask & (rank - first[own] < most[own])
                ends = np.concatenate([[0], np.cumsum(most)])
                lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key[chosen].astype(np.int64))))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n), pa.array(k1), pa.array(k2), *lists], names=["id", "n", "k1", "k2", "cold", "hot"]
            )

    return texts.arrow(docs, run, f"id {kind}, n long, k1 long, k2 long, cold array<long>, hot array<long>")


def least_common(n: str, m: str, percent: int) -> F.Column:
    """Smallest intersection of sets of ``n`` and ``m`` shingles that link: percent * (n + m) / (100 + percent)."""
    total = (F.col(n) + F.col(m)) * percent
    return F.floor((total + 99 + percent) / (100 + percent)).cast("long")


def may_link(n: str, i: str, m: str, j: str, percent: int) -> F.Column:
    """Size filter, and position filter for a shingle at places ``i`` and ``j`` (from 0)."""
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return sizes & (F.least(F.col(n) - F.col(i), F.col(m) - F.col(j)) >= least_common(n, m, percent))


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) of the ``pairs`` (leader a, member b) whose sets link. Stored, as it is read several times.

    Only the texts of classes in a pair are cut into shingles again. A leader's set goes once to each of
    its cells of ``CELL`` members; a member's set goes once for each of its pairs.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells"))
    members = pairs.join(sizes, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("cells")).cast("int").alias("cell"), F.col("b").alias("cls"), F.lit(True).alias("member")
    )
    leaders = sizes.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.col("a").alias("cls"), F.lit(False).alias("member")
    )
    roles = durable(members.unionByName(leaders), "jaccard-roles")
    wanted = durable(roles.select("cls").distinct().join(classes.select("cls", "id", "k1", "k2"), "cls"), "jaccard-wanted")
    keyed = wanted.select(F.col("id").alias("rep"), "cls", "k1", "k2")
    if wanted.count() <= BROADCAST_IDS:  # 32 bytes a row; beyond that Spark shuffles both sides
        keyed = F.broadcast(keyed)
    own = docs.join(keyed, F.col("id").eqNullSafe(F.col("rep")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches):
            off, key = shingle_sets(texts.raw(part), words)
            k1, k2 = set_keys(off, key)
            same = (k1 == part.column("k1").to_numpy()) & (k2 == part.column("k2").to_numpy())
            at = np.flatnonzero(same)
            blobs = [key[off[i] : off[i + 1]].tobytes() for i in at]
            yield pa.RecordBatch.from_arrays([part.column("cls").take(pa.array(at)), pa.array(blobs, pa.binary())], names=["cls", "set"])

    cut = texts.arrow(own.select("cls", "k1", "k2", "text"), sets, "cls long, set binary")
    rows = cut.join(roles, "cls").repartition("a", "cell").sortWithinPartitions("a", "cell", "member")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            columns = (batch.column(c).to_pylist() for c in ("a", "cell", "cls", "member", "set"))
            for key, cell, cls, member, blob in zip(*columns):
                values = np.frombuffer(blob, np.uint64)
                if not member:
                    leader, own = (key, cell), values
                elif leader == (key, cell):
                    place = np.searchsorted(own, values)
                    common = int((own[np.minimum(place, len(own) - 1)] == values).sum())
                    if 100 * common >= percent * (len(own) + len(values) - common):
                        a.append(key)
                        b.append(cls)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    links = texts.arrow(rows.select("a", "cell", "cls", "member", "set"), compare, "a long, b long")
    return durable(links.distinct(), "jaccard-links")


def components(links: DataFrame) -> DataFrame:
    """(cls, root) of every class in a link; the smallest class reachable is the root.

    Labels go along the links, then jump to the label of their label, until none changes.
    """
    both = durable(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "jaccard-edges"
    )
    state = durable(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "cls"), "jaccard-roots")
    while True:
        told = both.join(state, both["b"] == state["cls"]).groupBy("a").agg(F.min("root").alias("other"))
        near = state.join(told, state["cls"] == told["a"]).select("cls", "root", F.least("root", "other").alias("near"))
        jump = state.select(F.col("cls").alias("via"), F.col("root").alias("far"))
        step = near.join(jump, near["near"] == jump["via"], "left").select(
            "cls", F.least("near", F.coalesce("far", "near")).alias("root"), F.col("root").alias("was")
        )
        step = durable(step, "jaccard-roots")
        state = step.select("cls", "root")
        if not step.where("root < was").limit(1).count():
            return state


def linked(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    bitmap = spark.sparkContext.broadcast(frequent(plain.select("text"), words))
    rows = durable(prefixes(plain, bitmap, words, percent), "jaccard-rows")
    # classes of equal sets, numbered once and stored
    same = rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("id").alias("id"), F.first("cold").alias("cold"), F.first("hot").alias("hot"))
    keyed = same.withColumn("cls", F.monotonically_increasing_id())
    for k in (1, 2):  # 128 bits that tell prefixes apart
        keyed = keyed.withColumn(f"g{k}", F.xxhash64(F.lit(k), "cold", F.lit(k), "hot"))
    classes = durable(keyed, "jaccard-classes")
    # groups of equal prefix and size; the smallest class stands for all
    groups = classes.groupBy("g1", "g2", "n").agg(F.min("cls").alias("gid"), F.count("*").alias("size"))
    grouped = durable(classes.select("cls", "g1", "g2", "n").join(groups, ["g1", "g2", "n"]).select("cls", "gid", "n", "size"), "jaccard-groups")
    lead = classes.join(grouped.where("cls = gid").select("cls"), "cls", "left_semi")
    cold = lead.select("cls", "n", F.posexplode("cold").alias("pos", "tok"))
    hot = lead.select("cls", "n", F.size("cold").alias("base"), F.posexplode("hot").alias("at", "tok")).select(
        "cls", "n", (F.col("base") + F.col("at")).alias("pos"), "tok"
    )
    # a shingle that is not frequent has few holders, so its holders meet in a window; frequent ones are pre-aggregated
    per = W.Window.partitionBy("tok").orderBy("pos", "cls")
    held = F.struct("cls", "n", "pos")
    met = cold.select("tok", "cls", "n", "pos", F.first(held).over(per).alias("lead"), F.lead("cls").over(per).alias("after"))
    cold_met = met.where((F.col("lead.cls") != F.col("cls")) | F.col("after").isNotNull()).drop("after")
    firsts = hot.groupBy("tok").agg(F.min(F.struct("pos", "cls", "n")).alias("lead"), F.count("*").alias("holders")).where("holders > 1")
    hot_met = hot.join(firsts, "tok").select("tok", "cls", "n", "pos", F.struct("lead.cls", "lead.n", "lead.pos").alias("lead"))
    shared = durable(cold_met.unionByName(hot_met), "jaccard-shared")
    stars = (
        shared.where(F.col("lead.cls") != F.col("cls"))
        .select("cls", "n", "pos", F.col("lead.cls").alias("a"), F.col("lead.n").alias("m"), F.col("lead.pos").alias("at"))
        .where(may_link("n", "pos", "m", "at", percent))
        .select("a", F.col("cls").alias("b"))
    )
    # expand the groups: a group's own members meet its head, and members of another group that group's leader
    many = grouped.where("size > 1 and cls != gid").select("cls", "gid")
    expanded = stars.join(many, stars["b"] == many["gid"]).select("a", F.col("cls").alias("b"))
    first = stars.unionByName(expanded).unionByName(many.select(F.col("gid").alias("a"), F.col("cls").alias("b"))).distinct()
    first_links = verified(plain, classes, durable(first, "jaccard-pairs"), words, percent)
    roots = components(first_links)
    # classes of different components under one shingle
    full = shared.select("tok", "cls", "n", "pos").unionByName(
        shared.join(many, shared["cls"] == many["gid"]).select("tok", many["cls"].alias("cls"), "n", "pos")
    )
    inner = many.select(F.xxhash64("gid").alias("tok"), "cls", F.col("gid").alias("g"))
    own = classes.select("cls", "n")
    within = inner.select("tok", "cls").unionByName(inner.select("tok", F.col("g").alias("cls")).distinct())
    full = full.unionByName(within.join(own, "cls").select("tok", "cls", "n", F.lit(0).alias("pos")))
    rooted = full.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    mixed = rooted.groupBy("tok").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("tok")
    open_ = durable(rooted.join(mixed, "tok", "left_semi"), "jaccard-open")
    cells = 8  # a frequent shingle's holders meet in cells, so no task has all of them
    left = open_.withColumn("cell", F.pmod(F.xxhash64("cls"), F.lit(cells)).cast("int"))
    right = open_.select(
        F.col("tok").alias("tok2"), F.col("cls").alias("b"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("root").alias("root2"),
        F.explode(F.array([F.lit(c) for c in range(cells)])).alias("cell2"),
    )
    ahead = (F.col("pos") < F.col("at")) | ((F.col("pos") == F.col("at")) & (F.col("cls") < F.col("b")))
    crossed = left.join(
        right,
        (F.col("tok") == F.col("tok2")) & (F.col("cell") == F.col("cell2")) & (F.col("root") != F.col("root2")) & ahead
        & may_link("n", "pos", "m", "at", percent),
    ).select(F.col("cls").alias("a"), "b")
    pairs = crossed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    fresh = pairs.join(first, ["a", "b"], "left_anti").join(first.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    second_links = verified(plain, classes, durable(fresh, "jaccard-pairs"), words, percent)
    every = components(first_links.unionByName(second_links))
    named = classes.select("cls", "k1", "k2", "id").join(every, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    lowest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    result = durable(named.join(lowest, "root").select("k1", "k2", "component_id"), "jaccard-components")
    return rows.join(result, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns.

    Rows are told apart by id and text, so a row goes only if it is itself a near copy of one that stays. A null
    id comes after all others; among equal ids the text's hashes decide, among equal texts the other columns'.
    """
    names = docs.columns
    name, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    content = [F.xxhash64(F.lit(k), text.isNull(), text).alias(f"r{k}") for k in (1, 2)]  # 128 bits that tell texts apart
    row = "__row"
    while row.lower() in {x.lower() for x in names}:  # a user's column of that name stays
        row += "_"
    keyed = docs.withColumn(row, F.struct(name.isNull().alias("none"), name.alias("id"), *content))
    found = linked(keyed.select(row, text.alias("__text")), row, "__text", words, percent)
    counted = found.where("n_shingles > 0").groupBy(row, "component_id").agg(F.count("*").alias("n"))
    stays = F.col(row) == F.col("component_id")
    counted = durable(counted.select(row, stays.alias("stays"), "n").where("not stays or n > 1"), "jaccard-gone")
    gone, repeated = counted.where("not stays").select(row), counted.where("stays").select(row)

    def sized(rows: DataFrame, n: int) -> DataFrame:
        return F.broadcast(rows) if n <= BROADCAST_IDS else rows  # an id and 17 bytes; beyond that Spark shuffles both sides

    kept = keyed.join(sized(gone, gone.count()), row, "left_anti")
    n = repeated.count()
    if n:  # equal ids with equal texts
        plain = [F.col(f"`{f.name}`") for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())]
        rest = F.xxhash64(*(c for x in plain for c in (x.isNull(), x)))
        of_many = kept.join(sized(repeated, n), row, "left_semi")
        one = of_many.groupBy(row).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in names)), rest).alias("__one"))
        kept = kept.join(sized(repeated, n), row, "left_anti").drop(row).unionByName(one.select("__one.*"))
    return kept.select(*(F.col(f"`{c}`") for c in names))
