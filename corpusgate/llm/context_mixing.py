"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is read as its words (A-Z lower-cased), a space after each, and one line feed as the end. Every byte
is predicted bit by bit, most significant first, by one predictor for each context: the last 1 to 4 bytes,
and a hash of the last 5 bytes with the length of the word so far. A predictor's estimate is the share of its training
occurrences at this bit, as a logit; the logits are added with weights chosen by a gate (the longest context
that has been seen, and how often), and the sum's probability is refined by a map adapted per gate and bit
(linear between 33 logits), averaged with it. Weights and map are learned online, shard by shard of the
contexts, from all training occurrences, each predicted without itself; the shards' weights are averaged.
Both bits of every decision get probabilities that add to 1, so a text's score is a log-probability.

All counts are over all training texts and grow with them. Contexts with the byte after them ("grams") are
counted in the tasks before they are shuffled. Grams that share their last three context bytes meet in one
task, which gives each its probability; counts of the two shortest contexts are a table of at most 2^24
rows. Probabilities of the `FREQUENT` most frequent grams, and counts of the `FREQUENT_WORDS` most frequent
words, go to every task; the rest of a text's grams and words meet theirs by a join. Both ways give the
same numbers. The base score is a unigram model of words with counts of the same kind.

Defined cases: a null or empty text has no word, only its end; very long texts are taken whole; repeated
rows are counted and scored one by one; rows whose training flag is null are not learned from; without
training rows every bit has probability 1/2 and the base score is 0; an empty table gives an empty result;
other columns, whatever their names, are not read; null ids are returned as they are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgate.llm import texts
from corpusgate.session import durable

#: Grams and words whose numbers every task holds; bounds of what is broadcast.
FREQUENT, FREQUENT_WORDS = 1 << 21, 1 << 18
#: Distinct grams and words a task counts before it passes them on.
HELD_GRAMS, HELD_WORDS = 1 << 21, 1 << 19
#: Words of a text that are turned into bytes at once.
PIECE_WORDS = 1 << 18
#: Grams of a shard worked on at once; contexts with equal last three bytes are never parted.
SHARD_ROWS = 100_000
#: Bits by which a gram is shifted to leave a context of 1 to 4 bytes, and the hashed one.
CONTEXTS = (56, 48, 40, 32, 8)
#: Letters of the word so far that the hashed context tells apart.
LETTERS = 6
#: Occurrences that each bit has before any is counted.
PRIOR = 0.3
#: Buckets of a gate's count, nodes of the refining map and the largest logit.
SEEN, NODES, LOGIT = 8, 33, 12.0
GATES = (len(CONTEXTS) + 1) * SEEN
END = b"\n"
LEAD = 5
#: Bytes whose grams are made at once.
GRAM_BLOCK = 1 << 15


def grams(data: bytes) -> np.ndarray:
    """Gram of each byte from place `LEAD` on: four bytes before it, the hash of the long context, and the byte."""
    b = np.frombuffer(data, np.uint8)
    out = np.empty(max(len(b) - LEAD, 0), np.uint64)
    for at in range(LEAD, len(b), GRAM_BLOCK):  # blocks that stay in the processor's caches
        own = _grams(b[max(at - LEAD - LETTERS, 0) : at + GRAM_BLOCK].astype(np.uint64))
        stop = min(at + GRAM_BLOCK, len(b))
        out[at - LEAD : stop - LEAD] = own[len(own) - (stop - at) :]
    return out


def _grams(b: np.ndarray) -> np.ndarray:
    n = len(b)
    apart = (b == 32) | (b == 10)
    start = np.maximum.accumulate(np.where(apart, np.arange(1, n + 1), 0))[LEAD - 1 : -1]  # of the word that the byte goes on
    letters = np.minimum(np.arange(LEAD, n) - start, LETTERS).astype(np.uint64)
    back = lambda k: b[LEAD - k : n - k]
    hashed = texts.mixed((back(5) << np.uint64(8) | letters) * texts.M1) >> np.uint64(40)
    out = hashed << np.uint64(8) | b[LEAD:]
    for k in range(1, 5):
        out |= back(k) << np.uint64(64 - 8 * k)
    return out


def pieces(words: list[list[bytes]]) -> Iterator[tuple[int, bytes]]:
    """(document, bytes with what leads up to them) of texts, very long ones in several pieces."""
    for k, own in enumerate(words):
        lead = END * LEAD
        for at in range(0, max(len(own), 1), PIECE_WORDS):
            part = own[at : at + PIECE_WORDS]
            body = b" ".join(part) + b" " if part else b""
            body += END if at + PIECE_WORDS >= len(own) else b""
            yield k, lead + body
            lead = (lead + body)[-LEAD:]


def read(words: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, gram) of every byte, some megabytes at a time."""
    held, size = [], 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        got = grams(b"".join(x for _, x in held))
        lengths = np.array([len(x) for _, x in held], np.int64)
        docs = np.repeat(np.array([k for k, _ in held], np.int32), lengths)[LEAD:]
        body = np.ones(len(docs), bool)
        for at in np.cumsum(lengths)[:-1] - LEAD:  # what leads up to a piece is not predicted
            body[at : at + LEAD] = False
        return docs[body], got[body]

    for k, piece in pieces(words):
        if held and size + len(piece) > texts.SLICE_BYTES:
            yield joined()
            held, size = [], 0
        held.append((k, piece))
        size += len(piece)
    if held:
        yield joined()


class Grams:
    """Distinct grams with two counts, merged when many are pending."""

    def __init__(self) -> None:
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, keys: np.ndarray, every: np.ndarray, train: np.ndarray) -> None:
        self.parts.append((keys, every, train))
        self.size += len(keys)
        if self.size > 2 * HELD_GRAMS:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, every, train = (np.concatenate(x) for x in zip(*self.parts)) if self.parts else (np.empty(0, t) for t in (np.uint64, float, float))
        codes, distinct = pd.factorize(keys.view(np.int64))
        sums = [np.bincount(codes, x, len(distinct)) for x in (every, train)]
        self.parts, self.size = [(distinct.view(np.uint64), *sums)], len(distinct)
        return self.parts[0]


def _counted_rows(keys, words, every, train) -> pa.RecordBatch:
    arrays = [pa.array(keys, pa.int64()), pa.array(words, pa.binary()), *(pa.array(np.asarray(x).astype(np.int64)) for x in (every, train))]
    return pa.RecordBatch.from_arrays(arrays, names=["gram", "word", "n", "train"])


def counted(docs: DataFrame) -> DataFrame:
    """(gram, word, n, train) of all grams (word null) and words (gram 0) of (text, train), stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen = Grams(), (Counter(), Counter())  # words of held-out texts, and of training texts

        def emitted(chunk: int = 1 << 16) -> Iterator[pa.RecordBatch]:
            keys, every, train = found.merge()
            for at in range(0, len(keys), chunk):
                own = slice(at, at + chunk)
                yield _counted_rows(keys[own].view(np.int64), [None] * len(keys[own]), every[own], train[own])
            found.parts, found.size = [], 0

        def spelled(chunk: int = 1 << 16) -> Iterator[pa.RecordBatch]:
            for learned, counts in enumerate(seen):
                names = list(counts)
                for at in range(0, len(names), chunk):
                    own = names[at : at + chunk]
                    n = np.fromiter(map(counts.__getitem__, own), np.int64, len(own))
                    yield _counted_rows(np.zeros(len(own), np.int64), own, n, n * learned)
                counts.clear()

        for part in texts.slices(batches):
            words = [t.translate(texts.LOWER).split() for t in texts.raw(part)]
            trains = np.array([bool(x) for x in part.column("train").to_pylist()])
            for doc, keys in read(words):
                own = trains[doc]
                for some, learned in ((keys[own], 1), (keys[~own], 0)):  # sorting is faster here than hashing
                    distinct, n = np.unique(some, return_counts=True)
                    found.add(distinct, n, n * learned)
            if found.size > HELD_GRAMS:
                yield from emitted()
            for own, learned in zip(words, trains.tolist()):
                seen[learned].update(own)
                seen[learned][END] += 1
            if sum(map(len, seen)) > HELD_WORDS:
                yield from spelled()
        yield from emitted()
        yield from spelled()

    rows = texts.arrow(docs, count, "gram long, word binary, n long, train long")
    return durable(rows.groupBy("gram", "word").agg(F.sum("n").alias("n"), F.sum("train").alias("train")), "lm-counts")


@dataclass(frozen=True)
class Short:
    """Training occurrences below each node of the bits after the two shortest contexts; keys ascending."""

    keys: list[np.ndarray]
    counts: list[np.ndarray]

    @staticmethod
    def of(contexts: np.ndarray, symbols: np.ndarray, counts: np.ndarray) -> Short:
        keys, sums = [], []
        for bits in (8, 0):
            own = [contexts >> np.uint64(bits) << np.uint64(9) | np.uint64(1 << j) | symbols >> np.uint64(8 - j) for j in range(9)]
            codes, distinct = pd.factorize(np.concatenate(own))
            order = np.argsort(distinct)
            keys.append(distinct[order])
            sums.append(np.bincount(codes, np.tile(counts, 9), len(distinct))[order])
        return Short(keys, sums)

    def below(self, k: int, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys[k]):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys[k], keys), len(self.keys[k]) - 1)
        return np.where(self.keys[k][at] == keys, self.counts[k][at], 0.0)


def occurrences(keys: np.ndarray, counts: np.ndarray, short: Short) -> np.ndarray:
    """(contexts, 9, grams): training occurrences of each context, then of it with 1 to 8 bits of the byte."""
    symbols = keys & np.uint64(255)
    out = np.empty((len(CONTEXTS), 9, len(keys)))
    for k, shift in enumerate(CONTEXTS):
        both, place = np.unique((keys >> np.uint64(shift) << np.uint64(8) | symbols) if shift > 8 else keys, return_inverse=True)
        own = None if k < 2 else np.bincount(place, counts, len(both))
        for j in range(9):
            node = both >> np.uint64(8 - j)
            if own is None:
                prefix = (both & np.uint64(255)) >> np.uint64(8 - j)
                out[k, j] = short.below(k, both >> np.uint64(8) << np.uint64(9) | np.uint64(1 << j) | prefix)[place]
            else:
                first = np.concatenate([[True], node[1:] != node[:-1]])
                out[k, j] = np.add.reduceat(own, np.flatnonzero(first))[(np.cumsum(first) - 1)[place]]
    return out


def predictors(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of the true bits (bits x grams, contexts), gate and longest seen context of each."""
    total, true = seen[:, :8], seen[:, 1:]
    logits = np.log((true + PRIOR) / (total - true + PRIOR)).reshape(len(CONTEXTS), -1).T
    known = total.reshape(len(CONTEXTS), -1) > 0
    longest = np.where(known.any(axis=0), len(CONTEXTS) - np.argmax(known[::-1], axis=0), 0)
    last = np.take_along_axis(total.reshape(len(CONTEXTS), -1), np.maximum(longest - 1, 0)[None], 0)[0]
    bucket = np.minimum(np.log2(np.maximum(last, 1)).astype(np.int64), SEEN - 1)
    return logits, longest * SEEN + bucket, longest


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -LOGIT, LOGIT)))


def bits(keys: np.ndarray) -> np.ndarray:
    """The eight bits of each gram's byte, (8, grams) flattened."""
    return (keys[None] >> np.arange(7, -1, -1, dtype=np.uint64)[:, None] & np.uint64(1)).ravel().astype(np.int64)


class Mixer:
    """Weights of each gate, moved against the coding error of small batches with adapted steps."""

    def __init__(self, rate: float = 0.05, batch: int = 8192) -> None:
        self.weights, self.past = np.full((GATES, len(CONTEXTS)), 0.3), np.full((GATES, len(CONTEXTS)), 1e-6)
        self.mass, self.rate, self.batch = np.zeros(GATES), rate, batch

    def learn(self, logits: np.ndarray, gate: np.ndarray, mass: np.ndarray, rng: np.random.Generator) -> None:
        order = rng.permutation(len(gate))
        for at in range(0, len(order), self.batch):
            own = order[at : at + self.batch]
            g, x, m = gate[own], logits[own], mass[own]
            pull = m * (1 - squash((self.weights[g] * x).sum(axis=1)))
            sums = np.bincount(g, m, GATES)
            some = sums > 0
            step = np.stack([np.bincount(g, pull * x[:, k], GATES) for k in range(x.shape[1])], axis=1)[some] / sums[some, None]
            self.past[some] += step**2
            self.weights[some] += self.rate * step / np.sqrt(self.past[some])
            self.mass += sums


def mapped(mixed: np.ndarray, bit: np.ndarray, longest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower cell of the refining map, and the share of the cell above it, for logits of the true bits."""
    place = (np.clip(np.where(bit == 1, mixed, -mixed), -LOGIT, LOGIT) + LOGIT) * (NODES - 1) / (2 * LOGIT)
    low = np.minimum(place.astype(np.int64), NODES - 2)
    depth = np.repeat(np.arange(8), len(bit) // 8)
    return (longest * 8 + depth) * NODES + low, place - low


CELLS = (len(CONTEXTS) + 1) * 8 * NODES


def refined(mixed: np.ndarray, bit: np.ndarray, longest: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Probability of the true bits: the mixture's and the map's mean."""
    low, part = mapped(mixed, bit, longest)
    one = cells[low] * (1 - part) + cells[low + 1] * part
    return (squash(mixed) + np.where(bit == 1, one, 1 - one)) / 2


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, training occurrences) of whole contexts of three bytes, many at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        held.append((batch.column("gram").to_numpy().view(np.uint64), batch.column("train").to_numpy().astype(float)))
        if sum(len(k) for k, _ in held) >= SHARD_ROWS:
            keys, counts = (np.concatenate(x) for x in zip(*held))
            group = keys >> np.uint64(40)
            cut = int(np.flatnonzero(group != group[-1])[-1]) + 1 if (group != group[-1]).any() else 0
            if cut:
                yield keys[:cut], counts[:cut]
            held = [(keys[cut:], counts[cut:])]
    if held and len(held[0][0]):
        yield tuple(np.concatenate(x) for x in zip(*held))


def modelled(found: DataFrame) -> DataFrame:
    """(gram, n, score) of every counted gram, stored: log10 of the byte's probability in its context."""
    own = found.where(F.col("word").isNull())
    low = own.groupBy(F.shiftrightunsigned("gram", 48).alias("context"), F.col("gram").bitwiseAND(255).alias("symbol"))
    low = low.agg(F.sum("train").alias("n")).where("n > 0").toArrow()  # three bytes: at most 2^24 rows
    short = Short.of(*(low[c].to_numpy().astype(t) for c, t in (("context", np.uint64), ("symbol", np.uint64), ("n", float))))
    context = found.sparkSession.sparkContext
    shared = context.broadcast(short)
    sharded = own.repartition(F.shiftrightunsigned("gram", 40)).sortWithinPartitions(F.shiftrightunsigned("gram", 40))
    sharded = sharded.select("gram", "n", "train").persist(StorageLevel.DISK_ONLY)

    def without_itself(keys: np.ndarray, counts: np.ndarray) -> tuple:
        seen = occurrences(keys, counts, shared.value)
        some = counts > 0
        logits, gate, longest = predictors(seen[:, :, some] - 1)
        return logits, gate, longest, np.tile(counts[some], 8), bits(keys[some])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, rng = Mixer(), np.random.default_rng(7)
        for keys, counts in shards(batches):
            logits, gate, _, mass, _ = without_itself(keys, counts)
            mixer.learn(logits, gate, mass, rng)
        slots = np.arange(GATES * len(CONTEXTS))
        mass = np.repeat(mixer.mass, len(CONTEXTS))
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(mixer.weights.ravel() * mass), pa.array(mass)], names=["slot", "a", "b"])

    def summed(df: DataFrame, fn, size: int) -> tuple[np.ndarray, np.ndarray]:
        got = texts.arrow(df, fn, "slot long, a double, b double").groupBy("slot").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()
        out = np.zeros((2, size))
        out[:, got["slot"].to_numpy()] = got["a"].to_numpy(), got["b"].to_numpy()
        return out

    a, b = summed(sharded.select("gram", "train"), weigh, GATES * len(CONTEXTS))
    weights = np.where(b > 0, a / np.maximum(b, 1e-300), 0.3).reshape(GATES, len(CONTEXTS))

    def adapt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, mass = np.zeros(CELLS), np.zeros(CELLS)
        for keys, counts in shards(batches):
            logits, gate, longest, weight, bit = without_itself(keys, counts)
            low, part = mapped((weights[gate] * logits).sum(axis=1), bit, longest)
            for at, share in ((low, 1 - part), (low + 1, part)):
                hits += np.bincount(at, weight * share * bit, CELLS)
                mass += np.bincount(at, weight * share, CELLS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CELLS)), pa.array(hits), pa.array(mass)], names=["slot", "a", "b"])

    a, b = summed(sharded.select("gram", "train"), adapt, CELLS)
    start = squash(np.tile(np.linspace(-LOGIT, LOGIT, NODES), CELLS // NODES))
    cells = (a + 4 * start) / (b + 4)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in shards(batches):
            logits, gate, longest = predictors(occurrences(keys, counts, shared.value))
            p = refined((weights[gate] * logits).sum(axis=1), bits(keys), longest, cells)
            score = np.log10(p).reshape(8, -1).sum(axis=0)
            for at in range(0, len(keys), 1 << 15):
                part = slice(at, at + (1 << 15))
                yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(score[part])], names=["gram", "score"])

    scores = texts.arrow(sharded.select("gram", "train"), predict, "gram long, score double")
    out = durable(scores, "lm-scores")
    sharded.unpersist()
    return out


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value of each wanted key (0 where it is not among the ascending ``keys``), and whether it is."""
    value, here = np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    if len(keys):
        order = np.argsort(wanted)  # searched in order, neighbours are near in memory
        at = np.minimum(np.searchsorted(keys, wanted[order]), len(keys) - 1)
        here[order] = keys[at] == wanted[order]
        value[order] = np.where(here[order], values[at], 0.0)
    return value, here


def most_frequent(table: DataFrame, most: int) -> DataFrame:
    """Rows with the largest ``n``, at most ``most``: those above a count, an eighth of a power of two apart."""
    bucket = F.floor(F.log2("n") * 8)
    sizes = sorted(map(tuple, table.groupBy(bucket.alias("b")).count().collect()), reverse=True)
    least, size = None, 0
    for b, count in sizes:
        size += count
        if size > most:
            break
        least = b
    return table.where(bucket >= least) if least is not None else table.limit(0)


def scored(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row by a model of the rows where ``train`` is true.

    (id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte)
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    found = counted(rows.select("text", "train"))
    words = found.where(F.col("word").isNotNull()).select("word", "n", "train")
    scores = modelled(found)
    size = words.agg(F.sum("train").alias("n"), F.count_if(F.col("train") > 0).alias("v")).first()
    n, v = size["n"] or 0, size["v"]
    often = most_frequent(found.where(F.col("word").isNull()).select("gram", "n"), FREQUENT)
    top = scores.join(often.select("gram"), "gram", "left_semi").toArrow()  # at most FREQUENT rows
    keys, values = top["gram"].to_numpy().view(np.uint64), top["score"].to_numpy()
    order = np.argsort(keys)
    usual = most_frequent(words, FREQUENT_WORDS).toArrow()  # at most FREQUENT_WORDS rows
    places = dict(zip(usual["word"].to_pylist(), range(len(usual))))
    shared = spark.sparkContext.broadcast((keys[order], values[order], places, usual["train"].to_numpy().astype(np.int64)))

    schema = (
        f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, n_known long, base double, score double, n_bytes long,"
        " rare array<struct<gram:long,n:long>>, words array<struct<word:binary,n:long>>"
    )

    def nested(count: int, doc: np.ndarray, name: str, values: pa.Array, n: np.ndarray) -> pa.Array:
        fields = pa.StructArray.from_arrays([values, pa.array(n)], names=[name, "n"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(count + 1)), pa.int32()), fields)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, places, counts = shared.value
        counts = np.append(counts, 0)  # a word that is not held stands at -1
        logs, known = np.append(np.log10(counts[:-1] + 0.5), 0.0), (counts > 0).astype(np.int64)
        for part in texts.slices(batches):
            own = [t.translate(texts.LOWER).split() for t in texts.raw(part)]
            count = len(own)
            total, size, far = np.zeros(count), np.zeros(count, np.int64), []
            for doc, got in read(own):
                codes, distinct = pd.factorize(got.view(np.int64))
                distinct = distinct.view(np.uint64)
                value, here = looked_up(keys, values, distinct)
                total += np.bincount(doc, value[codes], count)
                size += np.bincount(doc, minlength=count)
                rest = np.flatnonzero(~here[codes])
                pairs, n = np.unique(doc[rest].astype(np.int64) * len(distinct) + codes[rest], return_counts=True)
                far.append((pairs // len(distinct), distinct[pairs % len(distinct)], n))
            doc, gram, n = (np.concatenate(x) for x in zip(*far))
            off = texts.offsets(len(w) + 1 for w in own)
            spoken = [w for ws in own for w in (*ws, END)]
            place = np.fromiter(map(places.get, spoken, repeat(-1)), np.int64, len(spoken))
            base, hit = texts.summed(logs[place], off), texts.summed(known[place], off)
            rest = np.flatnonzero(place < 0).tolist()
            owner = texts.owner(off)
            seldom = sorted(Counter((int(owner[i]), spoken[i]) for i in rest).items())
            spelled = pa.array([w for (_, w), _ in seldom], pa.binary())
            m = np.array([n for _, n in seldom], np.int64)
            speaker = np.array([k for (k, _), _ in seldom], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    *(pa.array(x) for x in (np.diff(off), hit, base, total, size)),
                    nested(count, doc, "gram", pa.array(gram.view(np.int64)), n),
                    nested(count, speaker, "word", spelled, m),
                ],
                names=["id", "n_tokens", "n_known", "base", "score", "n_bytes", "rare", "words"],
            )

    judged = texts.arrow(rows.select("id", "text"), judge, schema)
    judged = durable(judged.withColumn("row", F.monotonically_increasing_id()), "lm-texts")  # stored, so the numbers stay
    rare = judged.select("row", F.inline("rare")).join(scores, "gram")
    zero = F.lit(0.0)
    rare = rare.select("row", (F.col("n") * F.col("score")).alias("score"), zero.alias("base"), F.lit(0).cast("long").alias("n_known"))
    spelled = judged.select("row", F.inline("words").alias("word", "times")).join(words.select("word", "train"), "word")
    spelled = spelled.select(
        "row",
        zero.alias("score"),
        (F.col("times") * F.log10(F.col("train") + 0.5)).alias("base"),
        F.when(F.col("train") > 0, F.col("times")).otherwise(0).alias("n_known"),
    )
    more = rare.unionByName(spelled).groupBy("row").agg(*(F.sum(c).alias(f"more_{c}") for c in ("score", "base", "n_known")))
    whole = lambda c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0))
    whole_score = whole("score")
    return judged.drop("rare", "words").join(more, "row", "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        whole("n_known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (whole("base") - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))).alias("base_score"),
        whole_score.alias("score"),
        "n_bytes",
        (-whole_score / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
