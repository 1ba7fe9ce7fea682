"""Toxicity by a weighted finite-state pattern grammar.

Small transducers over word classes are composed into one machine that reads a sentence:

* insult: accepts learned words and stems, each with its learned weight;
* threat: accepts verbs of harm, which count only with a target in the sentence;
* target: remembers whether somebody is addressed;
* negation: weakens what stands within three words after it;
* reported speech: weakens sentences that quote or attribute.

The composed machine has one state per combination; its output is the weight of the matched
sentence, so a word never counts by itself. Sentences add up to a document's evidence, which a
logistic curve turns into a score from 0 to 1. Insult weights and the curve are learned from a
bounded sample of labelled rows; candidate words must occur in many different contexts, so copies
of one text teach nothing.

Null and empty texts have no evidence and get the score of none. Texts of any length are read
whole. Repeated rows are scored alike; columns other than ``doc_id`` and ``text`` are never an
input. Without labels of both kinds nothing is learned and only the fixed classes score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut
from .common import held_out, lean, slices

# Word classes in the four languages of the corpus.
TARGETS = frozenset("you your yours u ur yourself tu toi vous vos votre du dich dir euch ihr "
                    "usted ustedes ti vosotros".split())
NEGATIONS = frozenset("not no never neither nor isn't aren't wasn't don't doesn't nicht kein "
                      "keine nie pas jamais aucun nunca jamás ni".split())
REPORTS = frozenset("said says say called calls wrote quoted reported alleged sagte schrieb "
                    "zitierte dit écrit déclaré dijo escribió citó".split())
THREATS = frozenset("kill murder hurt stab shoot strangle destroy punch töten umbringen "
                    "erschießen tuer frapper égorger matar golpear apuñalar".split())

OTHER, TARGET, NEGATION, REPORT, THREAT, INSULT = range(6)
NEGATED, REPORTED, ADDRESSED, UNADDRESSED_THREAT, THREAT_WEIGHT = 0.4, 0.6, 1.5, 0.0, 3.0
REACH = 3
STEMS = (4, 5, 6, 7, 8)

WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
SENTENCE = re.compile(r"[.!?;\n]+")


def compose() -> list[list[tuple[int, float]]]:
    """``machine[state][symbol] = (next state, factor)`` of the product of target, negation and
    reported-speech machines; ``factor`` multiplies the weight of an accepted insult or threat."""
    table = []
    for state in range(2 * 2 * (REACH + 1)):
        target, rest = divmod(state, 2 * (REACH + 1))
        reported, left = divmod(rest, REACH + 1)
        row = []
        for symbol in range(6):
            t = 1 if symbol == TARGET else target
            r = 1 if symbol == REPORT else reported
            n = REACH if symbol == NEGATION else max(0, left - 1)
            row.append(((t * 2 + r) * (REACH + 1) + n, NEGATED if left else 1.0))
        table.append(row)
    return table


MACHINE = compose()


def _final(state: int) -> tuple[bool, bool]:
    target, rest = divmod(state, 2 * (REACH + 1))
    return bool(target), bool(rest // (REACH + 1))


@dataclass
class Grammar:
    """Insult arcs by word and stem, and the curve ``1 / (1 + exp(-(bias + slope * evidence)))``."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    bias: float = -3.0
    slope: float = 1.0

    def weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for n in STEMS:
            if len(word) > n:
                found = max(found, self.stems.get(word[:n], 0.0))
        return found

    def sentence(self, words: list[str]) -> float:
        state, insult, threat = 0, 0.0, 0.0
        for word in words:
            weight = self.weight(word)
            symbol = (INSULT if weight else TARGET if word in TARGETS else NEGATION
                      if word in NEGATIONS else REPORT if word in REPORTS else THREAT
                      if word in THREATS else OTHER)
            state, factor = MACHINE[state][symbol]
            insult += weight * factor if symbol == INSULT else 0.0
            threat += THREAT_WEIGHT * factor if symbol == THREAT else 0.0
        target, reported = _final(state)
        total = (insult * (ADDRESSED if target else 1.0)
                 + threat * (ADDRESSED if target else UNADDRESSED_THREAT))
        return total * (REPORTED if reported else 1.0)

    def arcs(self) -> ahocorasick.Automaton | None:
        """An automaton over the arcs' spellings, to skip texts without any."""
        spelled = {*self.words, *self.stems, *THREATS}
        machine = ahocorasick.Automaton()
        for word in spelled:
            machine.add_word(word, len(word))
        machine.make_automaton()
        return machine

    def evidence(self, text: str, arcs: ahocorasick.Automaton) -> float:
        low = text.lower()
        spots = [end - n for end, n in arcs.iter(low) if end < n or not low[end - n].isalnum()]
        if not spots:
            return 0.0
        total, done = 0.0, -1
        for spot in spots:
            if spot < done:
                continue
            start = max(low.rfind(c, 0, spot + 1) for c in ".!?;\n") + 1
            stop = SENTENCE.search(low, spot + 1)
            done = stop.start() if stop else len(low)
            total += self.sentence(WORD.findall(low, start, done))
        return total

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.bias + self.slope * evidence))))


def _features(words: list[str]) -> set[str]:
    """Words as ``=word`` and stems as ``^stem``."""
    out = {f"={w}" for w in words}
    for n in STEMS:
        out |= {f"^{w[:n]}" for w in words if len(w) > n}
    return out


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(feature, bad)``: in how many texts with the label a feature occurs."""
    for batch in chain.from_iterable(map(slices, batches)):
        bad = Counter()
        for text, label in zip(batch.column("text").to_pylist(),
                               batch.column("toxic").to_pylist(), strict=True):
            if label:
                bad.update(_features(set(WORD.findall((text or "").lower()))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(bad), pa.string()), pa.array(list(bad.values()), pa.int64())],
            ["feature", "bad"])


def _count_candidates(batches: Iterator[pa.RecordBatch], names: frozenset[str]
                      ) -> Iterator[pa.RecordBatch]:
    """``(feature, good, context)``: texts without the label, or the context in a toxic text."""
    for batch in chain.from_iterable(map(slices, batches)):
        feature, good, context = [], [], []
        for text, label in zip(batch.column("text").to_pylist(),
                               batch.column("toxic").to_pylist(), strict=True):
            words = WORD.findall((text or "").lower())
            if not label:
                hits = _features(set(words)) & names
                feature += hits
                good += [1] * len(hits)
                context += [None] * len(hits)
                continue
            # One context a text, its first: copies of a text agree in it.
            first = {}
            for i, word in enumerate(words):
                for f in _features([word]) & names:
                    first.setdefault(f, i)
            for f, i in first.items():
                feature.append(f)
                good.append(0)
                context.append(" ".join(words[max(0, i - 1):i + 2]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(feature, pa.string()), pa.array(good, pa.int64()),
             pa.array(context, pa.string())], ["feature", "good", "context"])


def _curve(evidence: np.ndarray, toxic: np.ndarray, count: np.ndarray, ridge: float = 1.0
           ) -> tuple[float, float]:
    """Bias and slope of a logistic curve by Newton steps; ``ridge`` keeps both bounded."""
    x = np.stack([np.ones_like(evidence), evidence], axis=1)
    w = np.array([-2.0, 1.0])
    pull = np.array([0.01, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        slope = x.T @ (count * (toxic - p)) - pull * (w - [-2.0, 1.0])
        curve = (x * (count * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(max(w[1], 0.05))


def fit(labelled: DataFrame, min_contexts: int = 5, purity: float = 0.9,
        max_arcs: int = 20000) -> Grammar:
    """A grammar from ``(text, toxic)``; a bounded table. ``max_arcs`` bounds the arcs kept, the
    strongest first."""
    rows = cut(labelled.where(F.col("toxic").isin(0, 1)).select("text", "toxic"))
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    grammar = Grammar()
    if len(sizes) < 2:
        return grammar
    bad = (rows.mapInArrow(lean(_count_features), "feature string, bad long").groupBy("feature")
           .agg(F.sum("bad").alias("bad")).where(F.col("bad") >= min_contexts)
           .orderBy(F.desc("bad"), "feature").limit(20 * max_arcs))
    counts = {r.feature: r.bad for r in bad.collect()}
    names = frozenset(counts)
    total = (rows.mapInArrow(lambda b: _count_candidates(b, names),
                             "feature string, good long, context string").groupBy("feature")
             .agg(F.sum("good").alias("good"), F.countDistinct("context").alias("contexts")))
    pure = total.where((F.col("contexts") >= min_contexts)
                       & (F.col("contexts") >= purity * (F.col("contexts") + F.col("good"))))
    arcs = []
    for r in pure.collect():
        weight = (math.log((counts[r.feature] + 0.5) / (sizes[1] + 1))
                  - math.log((r.good + 0.5) / (sizes[0] + 1)))
        if weight > 0:
            arcs.append((weight, r.feature))
    for weight, feature in sorted(arcs, reverse=True)[:max_arcs]:
        (grammar.words if feature[0] == "=" else grammar.stems)[feature[1:]] = weight
    bins = (evidence(rows, grammar, ["toxic"]).groupBy("toxic", F.round("evidence", 1).alias("e"))
            .agg(F.count(F.lit(1)).alias("n")).collect())
    grammar.bias, grammar.slope = _curve(
        np.array([r.e for r in bins]), np.array([r.toxic for r in bins], float),
        np.array([r.n for r in bins], float))
    return grammar


def evidence(docs: DataFrame, grammar: Grammar, carry: list[str]) -> DataFrame:
    """``carry`` columns of each row, which may include ``text``, and its ``evidence``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arcs = grammar.arcs()
        for batch in chain.from_iterable(map(slices, batches)):
            found = [grammar.evidence(t or "", arcs) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], pa.array(found, pa.float64())],
                [*carry, "evidence"])

    rows = docs.select(*carry, *({"text"} - set(carry)))
    schema = T.StructType([*[rows.schema[c] for c in carry],
                           T.StructField("evidence", T.DoubleType())])
    return rows.mapInArrow(lean(read), schema)


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = 20000
                  ) -> DataFrame:
    """``(text, toxic)`` of at most ``sample`` labelled documents that are not held out, by least
    hash of the id; their ids are few enough to broadcast."""
    known = (labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id", folds))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
            .select("text", "toxic"))


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = 20000,
          carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (all by default) of each row with ``score`` and ``predicted``."""
    grammar = fit(training_rows(docs, labels, folds, sample))
    kept = [c for c in (carry or docs.columns) if c not in ("score", "predicted")]
    # A text goes through Python once, so it is not in the struct of the other columns as well.
    rest = [c for c in kept if c != "text"]
    rows = docs.select(F.struct(*[F.col(c) for c in rest]).alias("_row"), "text")
    curve = 1 / (1 + F.exp(-F.greatest(F.lit(-60.0), F.least(
        F.lit(60.0), F.lit(grammar.bias) + F.lit(grammar.slope) * F.col("evidence")))))
    read = evidence(rows, grammar, ["_row", *(["text"] if "text" in kept else [])])
    return read.select(
        *[F.col("text") if c == "text" else F.col("_row")[c].alias(c) for c in kept],
        curve.alias("score"), (curve >= 0.5).cast("int").alias("predicted"))
