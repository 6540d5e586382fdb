"""Toxicity by a weighted finite-state grammar over clauses.

Words fall into classes: insults, threats, targets, negations, speech verbs, others. Small
transducers, one for each class of context, remember whether that context is near; composed,
they form one machine that reads a clause from left to right and another that reads it from
right to left, and each insult or threat is weighed by the context on both sides. A threat is a
word of threat with a target; the word alone is none. Speech counts on either side. A document
is scored from its clauses, not from single words.

Insults and threats are learned: word beginnings and whole words that labelled toxic documents
have and the others do not, and words in front of a target, with their log-odds as weights. How clause scores make a document's score is a
logistic regression on the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm import common
from windrow.session import materialise

#: Labelled rows to learn from, at most (about): rows are taken by a hash of their id.
MOST_LABELLED = 40_000

#: Beginnings of words from this length to that, and the least evidence for an entry: toxic
#: documents that have it, in number and as a share, and log-odds of a document that does.
SHORTEST, LONGEST, LEAST_SEEN, LEAST_SHARE, LEAST_ODDS = 3, 9, 5, 0.001, 2.5

#: Bytes of words and their classes that a task remembers.
WORD_BYTES = 16 << 20

OTHER, INSULT, THREAT, TARGET, NEGATION, SPEECH = range(6)

#: Classes that are given, in four languages, and insults to begin with.
GIVEN = {
    THREAT: "kill hurt destroy murder strangle töten umbringen tuer matar",
    TARGET: "you your yours yourself they them he she him her us everyone du dich dir dein ihr euch tu toi te vous tú ti usted ustedes",
    NEGATION: "not never no none nobody isn aren nicht kein keine nie pas jamais aucun nunca jamás ningún",
    SPEECH: "said says called wrote quoted claimed sagte schrieb nannte dit disait écrit dijo escribió llamó",
}
#: Threats whose target may stand in front of them too.
EITHER_SIDE = frozenset("töten umbringen tuer matar".split())
SEEDS = "idiot moron stupid loser trash scum pathetic worthless disgusting clown"
SEED_WEIGHT, THREAT_WEIGHT = 3.0, 2.0

_TOKENS = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_STOP = frozenset(".!?;:\n")


@dataclass(frozen=True)
class Transducer:
    """Remembers for ``reach`` words that ``sign`` was read; then a hit is weighed by ``factor``."""

    sign: int
    reach: int
    factor: float

    def step(self, state: int, symbol: int) -> int:
        return self.reach if symbol == self.sign else max(state - 1, 0)

    def weight(self, state: int) -> float:
        return self.factor if state else 1.0


CONTEXTS = (Transducer(NEGATION, 3, 0.5), Transducer(SPEECH, 8, 0.5), Transducer(TARGET, 4, 1.5))


#: What is read from the right: a speech verb behind a hit, and a target behind a threat.
BEHIND = (Transducer(SPEECH, 8, 0.5), Transducer(TARGET, 4, 1.0))


def _states(parts: tuple[Transducer, ...]) -> list[tuple[int, ...]]:
    return list(product(*[range(p.reach + 1) for p in parts]))


def held(parts: tuple[Transducer, ...], sign: int) -> list[bool]:
    """For each state of the composed machine: is ``sign`` near?"""
    return [any(p.sign == sign and x > 0 for p, x in zip(parts, s)) for s in _states(parts)]


def compose(parts: tuple[Transducer, ...]) -> tuple[list[list[int]], list[float]]:
    """One machine: next state by state and symbol, and what a hit in a state is worth."""
    states = _states(parts)
    number = {s: i for i, s in enumerate(states)}
    go = [[number[tuple(p.step(x, c) for p, x in zip(parts, s))] for c in range(6)] for s in states]
    worth = [float(np.prod([p.weight(x) for p, x in zip(parts, s)])) for s in states]
    return go, worth


@dataclass
class Grammar:
    """Reads texts; ``lexicon`` has word beginnings, whole words with a trailing '$', and threats with '>'."""

    lexicon: dict[str, float]

    def __post_init__(self):
        self.known = common.Memory(self._class, WORD_BYTES)
        self.go, self.worth = compose(CONTEXTS)
        self.back, self.worth_behind = compose(BEHIND)
        # A threat's target is part of it, not its context.
        aimless = [p if p.sign != TARGET else Transducer(p.sign, p.reach, 1.0) for p in CONTEXTS]
        self.threat_worth = compose(tuple(aimless))[1]
        self.aimed, self.aimed_behind = held(CONTEXTS, TARGET), held(BEHIND, TARGET)
        self.said = held(CONTEXTS, SPEECH)
        self.given = {w: c for c, words in GIVEN.items() for w in words.split()}

    def _class(self, word: str) -> tuple[int, float, bool]:
        starts = (word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))
        weight = max((self.lexicon.get(x, 0.0) for x in (*starts, word + "$")), default=0.0)
        if weight:
            return INSULT, weight, False
        kind, learned = self.given.get(word, OTHER), self.lexicon.get(word + ">", 0.0)
        if kind == OTHER and learned:
            kind = THREAT
        return kind, max(THREAT_WEIGHT, learned) if kind == THREAT else 0.0, word in EITHER_SIDE

    def _clause(self, marks: list[tuple[int, float, bool]]) -> float:
        """From the right for what stands behind each word, then from the left."""
        behind, state = [], 0
        for m in reversed(marks):
            behind.append(state)
            state = self.back[state][m[0]]
        score, state = 0.0, 0
        for (symbol, weight, either), right in zip(marks, reversed(behind)):
            if weight:
                if symbol != THREAT:
                    worth = self.worth[state]
                elif self.aimed_behind[right] or (either and self.aimed[state]):
                    worth = self.threat_worth[state]
                else:
                    worth = 0.0
                score += weight * worth * (1.0 if self.said[state] else self.worth_behind[right])
            state = self.go[state][symbol]
        return score

    def clauses(self, text: str) -> tuple[list[float], int]:
        """Scores of the clauses that have a hit, and the number of words."""
        known = self.known
        tokens = _TOKENS.findall(text.lower())
        marks = [None if t in _STOP else known[t] for t in tokens]
        stops = marks.count(None)
        scores: list[float] = []
        if any(m and m[1] for m in marks):
            begin, hit = 0, False
            for i, m in enumerate((*marks, None)):
                if m is None:
                    score = self._clause(marks[begin:i]) if hit else 0.0
                    if score:
                        scores.append(score)
                    begin, hit = i + 1, False
                elif m[1]:
                    hit = True
        return scores, len(marks) - stops

    def features(self, text: str) -> list[float]:
        scores, words = self.clauses(text)
        total, most = sum(scores), max(scores, default=0.0)
        share = 100.0 * total / (words + 20)
        return [np.log1p(total), most, np.log1p(share), float(len(scores) > 0), np.log1p(words)]


@dataclass
class Model:
    lexicon: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = np.column_stack([(features - self.mean) / self.scale, np.ones(len(features))])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _train_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of labelled rows that are not held out, about ``MOST_LABELLED`` at most."""
    marked = labels.select(F.col("doc_id").alias("_id"), "toxic").where("_id IS NOT NULL AND toxic IS NOT NULL")
    marked = marked.groupBy("_id").agg(F.max("toxic").alias("toxic")).where(~held_out("_id"))
    part = min(1.0, MOST_LABELLED / max(marked.count(), 1))
    marked = marked.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(part * 1_000_000))
    marked = common.broadcast_if_bounded(marked, 32)
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    # Copies are no further evidence.
    rows = rows.join(marked, F.col("doc_id") == F.col("_id")).groupBy("text").agg(F.max("toxic").alias("toxic"))
    return materialise(rows, "labelled")


def aimed(text: str):
    """A column: the words, with a trailing '>', that a target follows within the reach in their clause."""
    given = {w: c for c, words in GIVEN.items() for w in words.split()}
    reach = next(p.reach for p in BEHIND if p.sign == TARGET)
    targets = "|".join(sorted((re.escape(w) for w, c in given.items() if c == TARGET), reverse=True))
    others = "|".join(sorted(map(re.escape, given), reverse=True))
    gap = r"[^\p{L}.!?;:\n]+"
    near = rf"(?<!\p{{L}})(?!(?:{others})(?!\p{{L}}))(\p{{L}}+)(?={gap}(?:\p{{L}}+{gap}){{0,{reach - 1}}}(?:{targets})(?!\p{{L}}))"
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(near), F.lit(1)), lambda x: F.concat(x, F.lit(">")))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Log-odds of word beginnings, whole words and words before a target, from counts of documents.

    Counting is an aggregate over all rows. Evidence alone decides what is an entry; each is in a
    thousandth of the toxic documents at least, so they are a thousand times what one document
    has at most, and come to the driver.
    """
    seeds = {w + "$": SEED_WEIGHT for w in SEEDS.split()}
    counts = rows.groupBy().agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, clean = counts[0] or 0, counts[1] or 0
    if not toxic or not clean:
        return seeds
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    starts = [
        F.transform(F.filter("w", lambda x, k=k: F.length(x) >= k), lambda x, k=k: F.substring(x, 1, k))
        for k in range(SHORTEST, LONGEST + 1)
    ]
    every = F.flatten(F.array(F.transform("w", lambda x: F.concat(x, F.lit("$"))), *starts, "aimed"))
    seen = rows.select(words.alias("w"), aimed("text").alias("aimed"), "toxic").select(F.explode(F.array_distinct(every)).alias("entry"), "toxic")
    seen = seen.groupBy("entry").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    least = max(LEAST_SEEN, LEAST_SHARE * toxic)
    best = seen.where(F.col("t") >= least).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    found = {r.entry: float(r.odds) for r in best.collect()}
    return {**seeds, **{k: max(v, seeds.get(k, 0.0)) for k, v in found.items()}}


def _features(lexicon: dict[str, float], keep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [grammar.features(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.float64()))], names=[keep, "x"])
        common.give_back()

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 100) -> np.ndarray:
    """Newton's method with steps that are halved until the loss falls; the two classes weigh the same in sum."""
    each = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(each @ (np.logaddexp(0, z) - y * z) + ridge / 2 * w @ w)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (each * (p - y)) + ridge * w
        bend = (x * (each * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        part = 1.0
        while part > 1e-9 and loss(w - part * step) > now - 1e-4 * part * float(slope @ step):
            part /= 2
        w = w - part * step
        now = loss(w)
        if np.abs(part * step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows that are not held out; the features, never source, language or id."""
    rows = _train_rows(docs, labels)
    lexicon = learn_lexicon(rows)
    seen = common.in_small_batches(rows.select("toxic", "text")).mapInArrow(_features(lexicon, "toxic"), "toxic int, x array<double>")
    data = seen.collect()  # five numbers for each of the bounded rows
    x = np.array([r.x for r in data]) if data else np.zeros((0, 5))
    y = np.array([r.toxic for r in data], dtype=float)
    if not len(y) or y.min() == y.max():
        # Nothing to learn from: any clause that is scored counts as toxic.
        return Model(lexicon, np.zeros(5), np.ones(5), np.array([0, 0, 0, 4.0, 0, -2.0]))
    order = np.lexsort(x.T)
    x, y = x[order], y[order]
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    return Model(lexicon, mean, scale, _logistic(np.column_stack([(x - mean) / scale, np.ones(len(x))]), y))


def score(docs: DataFrame, model: Model, doc_id: str, text: str) -> DataFrame:
    """doc_id, held_out, score, predicted, for each row; whole texts.

    A null text counts as empty and is scored like a text without hits. Equal texts have equal
    scores. An empty table gives an empty result. Null ids are not held out.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.lexicon)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = np.array([grammar.features(t or "") for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(x))], names=["doc_id", "score"])
        common.give_back()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = common.in_small_batches(rows).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """The rows, with all their columns, that are not predicted to be toxic."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.lexicon)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                x = np.array([grammar.features(t or "") for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(model.scores(x) < 0.5))
        common.give_back()

    return common.in_small_batches(docs).mapInArrow(run, docs.schema)
