"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, report, other). Small transducers are composed:
one takes the force out of insults after a negation, one out of reported speech, one adds force beside a
target. What leaves the last one is weighed clause by clause, and a logistic curve fitted on the sample
turns the sum of a document's clauses into a probability. Insults are a short seed list and what labelled rows teach: words, and
beginnings of words, that stand in many different places of toxic texts and in hardly any others.

Defined cases: a null or empty text has no clause and the lowest score; training rows without a label are
left out; without toxic training rows the seed list alone decides; repeated texts teach nothing more, as
places are counted by their neighbours; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.llm import texts

#: Largest number of labelled rows, half of them toxic at most, from which insults are learned.
SAMPLE = 12_000
#: Lengths of the word beginnings that are learned beside whole words.
STEMS = (4, 5, 6)
#: Different places a learned insult has in toxic texts, their least share of these and all its clean ones, and by
#: how many standard deviations they must outnumber the clean ones, as both classes give equally many rows.
PLACES, PURE, DEVIATIONS = 6, 0.8, 4.0
#: Features that have enough places in toxic texts to be looked for in the others, the most frequent first.
CANDIDATES = 200_000
#: Most insults that are kept, the most frequent first.
LEXICON = 20_000

#: Word lists of the grammar. Fixed values.
INSULTS = "idiot moron stupid scum loser pathetic worthless trash clown disgusting".split()
THREATS = "kill hurt destroy punch beat shoot stab burn hang töten umbringen tuer frapper matar golpear".split()
TARGETS = (
    "you your yours yourself he him she her they them these those people du dich dir euch ihr sie "
    "tu te toi vous ils elles tú ti usted ustedes ellos ellas"
).split()
NEGATIONS = "not no never isn't aren't wasn't don't nicht kein keine nie pas jamais nunca".split()
REPORTS = "said says say quoted quote wrote called reported claims sagte sagt schrieb dit écrit dijo dice".split()

CLAUSE = re.compile(rb"[.!?;\n]+")
#: The ends of clauses as spaces: the words of a text are those of its clauses.
STOPS = bytes.maketrans(b".!?;\n", b"     ")
TRIM = b",:()[]\"'*#$%&|<>!"


class Transducer:
    """States, and for (state, symbol) the next state, the symbol handed on and a factor.

    ``None`` as a symbol stands for every one that has no arc of its own; without any arc a symbol passes
    unchanged and the state stays.
    """

    def __init__(self, arcs: dict[tuple[int, str | None], tuple[int, str | None, float]]) -> None:
        self.arcs = arcs

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        to, out, factor = self.arcs.get((state, symbol)) or self.arcs.get((state, None)) or (state, None, 1.0)
        return to, out or symbol, factor


class Composed:
    """Transducers one behind the other; the steps of the product are worked out once and remembered."""

    def __init__(self, parts: Iterable[Transducer]) -> None:
        self.parts = list(parts)
        self.start = (0,) * len(self.parts)
        self.known: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], str, float]] = {}

    def step(self, states: tuple[int, ...], symbol: str) -> tuple[tuple[int, ...], str, float]:
        key = states, symbol
        if key not in self.known:
            to, total = [], 1.0
            for part, state in zip(self.parts, states):
                state, symbol, factor = part.step(state, symbol)
                to.append(state)
                total *= factor
            self.known[key] = tuple(to), symbol, total
        return self.known[key]


HARSH = ("insult", "threat")


def negation(reach: int = 3, factor: float = 0.5) -> Transducer:
    """Harsh words up to ``reach`` words after a negation lose force."""
    arcs: dict = {(0, "negation"): (reach, None, 1.0)}
    for state in range(1, reach + 1):
        arcs[state, "negation"] = (reach, None, 1.0)
        arcs[state, None] = (state - 1, None, 1.0)
        arcs |= {(state, h): (state - 1, None, factor) for h in HARSH}
    return Transducer(arcs)


def reported(factor: float = 0.7) -> Transducer:
    """Harsh words after a word of saying lose force to the end of the clause."""
    return Transducer({(0, "report"): (1, None, 1.0)} | {(1, h): (1, None, factor) for h in HARSH})


def aimed(factor: float = 1.5, threat: float = 0.4) -> Transducer:
    """Harsh words after a target gain force; a threat without one loses most of it. Who speaks is no target."""
    arcs: dict = {(0, "target"): (1, None, 1.0), (0, "threat"): (0, None, threat), (1, "report"): (0, None, 1.0)}
    return Transducer(arcs | {(1, h): (1, None, factor) for h in HARSH})


@dataclass
class Grammar:
    """Weights of the harsh words and beginnings, and the composed transducers."""

    words: dict[bytes, float]
    stems: dict[bytes, float] = field(default_factory=dict)
    threat: float = 0.5
    slope: float = 1.5
    bias: float = -4.0

    def __post_init__(self) -> None:
        self.machine = Composed([negation(), reported(), aimed()])
        lists = (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS))
        self.symbols = {w.encode(): kind for kind, ws in lists for w in ws}
        self.memory: dict[bytes, tuple[str, float]] = {}

    def read(self, word: bytes) -> tuple[str, float]:
        """Symbol of a word, and its weight, which is 0 if it is not harsh."""
        got = self.memory.get(word)
        if got is None:
            if len(self.memory) > 500_000:
                self.memory = {}
            text = word.decode().lower().strip(TRIM.decode())
            weight = max([self.words.get(text.encode(), 0.0), *(self.stems.get(text[:n].encode(), 0.0) for n in STEMS if len(text) > n)])
            symbol = "insult" if weight else self.symbols.get(text.encode(), "other")
            got = symbol, self.threat if symbol == "threat" else weight
            self.memory[word] = got
        return got

    def clause(self, words: list[bytes]) -> float:
        """Strength of a clause: what its harsh words weigh after the factors of the machine."""
        states, total = self.machine.start, 0.0
        for word in words:
            symbol, weight = self.read(word)
            states, out, factor = self.machine.step(states, symbol)
            if out in HARSH:
                total -= math.log(1 - min(0.998, weight * factor))
        return total

    def strength(self, text: bytes) -> float:
        """Sum over the clauses; only texts with a harsh word, read as clauses read it, are cut into clauses."""
        read = self.read
        if not any(read(word)[1] for word in text.translate(STOPS).split()):
            return 0.0
        return sum(self.clause(part.split()) for part in CLAUSE.split(text))

    def score(self, text: bytes) -> float:
        return 1 / (1 + math.exp(-min(50.0, self.slope * self.strength(text) + self.bias)))


def places(rows: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Every lower-cased word with its beginnings (marked by a final *), and a hash of its neighbours."""
    features: list[bytes] = []
    around: list[np.ndarray] = []
    for text in rows:
        words = [w.strip(b".?;" + TRIM) for w in text.decode().lower().encode().split()]
        hashes = texts.word_hashes(np.array([b"", *words, b""], dtype=object))
        near = texts.mixed(hashes[:-2] * texts.M1 + hashes[2:])
        features += words
        around.append(near)
        chars = [w.decode() for w in words]
        for n in STEMS:
            at = [i for i, c in enumerate(chars) if len(c) > n]
            features += [chars[i][:n].encode() + b"*" for i in at]
            around.append(near[at])
    return features, np.concatenate(around) if around else np.empty(0, np.uint64)


def learned(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", sample: int = SAMPLE) -> Grammar:
    """Grammar from rows with a text and a label of 0 or 1; rows are taken by the smallest hashes of the id."""
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), F.col(id_col).cast("string").alias("id")
    )
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    key = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    share = [min(1.0, sample / 2 / sizes.get(k, 1)) for k in (0, 1)]
    rows = rows.where(key < F.when(F.col("label") == 1, share[1]).otherwise(share[0])).select("text", "label")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches):
            features, near = places(texts.raw(part))
            yield pa.RecordBatch.from_arrays([pa.array(features, pa.binary()), pa.array(near.astype(np.int64))], names=["feature", "near"])

    toxic = texts.arrow(rows.where("label = 1").select("text"), spread, "feature binary, near long").distinct()
    often = toxic.groupBy("feature").agg(F.count("*").alias("n")).where(F.col("n") >= PLACES)
    candidates = {bytes(r["feature"]): r["n"] for r in often.orderBy(F.desc("n"), "feature").limit(CANDIDATES).collect()}
    known = rows.sparkSession.sparkContext.broadcast(frozenset(candidates))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[bytes] = Counter()
        for part in texts.slices(batches):
            n.update(f for f in places(texts.raw(part))[0] if f in known.value)
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["feature", "n"])

    clean = texts.arrow(rows.where("label = 0").select("text"), count, "feature binary, n long")
    seen = {bytes(r["feature"]): r["n"] for r in clean.groupBy("feature").agg(F.sum("n").alias("n")).collect()}  # CANDIDATES at most
    clean_rows = min(sizes.get(0, 0), sample / 2) or 1
    even = min(sizes.get(1, 0), sample / 2) / clean_rows  # clean places as if there were as many clean rows
    against = {f: seen.get(f, 0) * even for f in candidates}
    sure = lambda f: (candidates[f] - against[f]) / (candidates[f] + against[f]) ** 0.5 >= DEVIATIONS
    best = [f for f, n in candidates.items() if n >= PURE * (n + against[f]) and sure(f)][:LEXICON]
    words = {w.encode(): 0.9 for w in INSULTS}
    stems: dict[bytes, float] = {}
    for f in best:
        weight = 1 - (against[f] + 0.5) / (candidates[f] + 1)
        (stems if f.endswith(b"*") else words)[f.removesuffix(b"*")] = weight
    grammar = Grammar(words, stems)
    if len(sizes) == 2:
        got = _strengths(rows, grammar).toArrow()  # three numbers a row of the sample
        x, y = got["strength"].to_numpy(), got["label"].to_numpy().astype(float)
        grammar.slope, grammar.bias = curve(x, y, np.where(y > 0, 1 / share[1], 1 / share[0]), grammar.slope, grammar.bias)
    return grammar


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, slope: float, bias: float) -> tuple[float, float]:
    """Logistic regression of ``y`` on ``x`` by Newton steps, drawn to the given start where rows say little."""
    start = now = np.array([slope, bias])
    rows, hold = np.stack([x, np.ones_like(x)], axis=1), np.array([4.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ now, -30, 30)))
        gradient = rows.T @ (weight * (p - y)) + hold * (now - start)
        step = np.linalg.solve((rows * (weight * p * (1 - p))[:, None]).T @ rows + np.diag(hold), gradient)
        now = now - np.clip(step, -1, 1)
    return max(0.1, float(now[0])), float(now[1])


def _strengths(rows: DataFrame, grammar: Grammar) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((grammar.words, grammar.stems, grammar.threat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(*shared.value)
        for part in texts.slices(batches):
            strength = [own.strength(t) for t in texts.raw(part)]
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(strength, pa.float64())], names=["label", "strength"])

    return texts.arrow(rows.select("text", "label"), run, "label int, strength double")


def scored(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; the grammar holds at most ``LEXICON`` learned words and is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((grammar.words, grammar.stems, grammar.threat, grammar.slope, grammar.bias))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(*shared.value)
        for part in texts.slices(batches):
            score = [own.score(t) for t in texts.raw(part)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64())], names=[id_col, "score"])

    return texts.arrow(docs.select(F.col(id_col), F.col(text_col).alias("text")), run, f"`{id_col}` {kind}, score double")
