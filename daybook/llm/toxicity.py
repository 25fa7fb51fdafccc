"""Toxicity classifier with a counterfactual penalty (operator 7).

Logistic regression over the distinct words (and word beginnings) of a text.
Every labelled text that names a group also stands with the group's term
swapped for another of its kind, and for a word that names no group; the fit penalises
the squared changes of the score, so that a neutral mention of a group moves it little.
(Swaps within a kind alone would let all its terms rise together.)
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import arrow_map, fold, stored
from daybook.llm.sampling import labelled_sample, training_fold

WORD = re.compile(r"[^\W_]+")
STEM = 5
# Groups of terms of one kind by language; a term is swapped for the next of its group.  A parameter of the operator.
IDENTITY_TERMS = {
    "en": (
        ("women", "men"),
        ("woman", "man"),
        ("female", "male"),
        ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
        ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
        ("gay", "straight", "lesbian", "bisexual", "transgender"),
        ("black", "white", "asian", "latino", "african", "european"),
        ("immigrant", "native", "refugee"),
        ("immigrants", "natives", "refugees"),
        ("deaf", "blind", "disabled"),
        ("old", "young", "elderly"),
    ),
    "de": (
        ("frauen", "männer"),
        ("frau", "mann"),
        ("muslime", "christen", "juden", "buddhisten", "atheisten"),
        ("schwul", "hetero", "lesbisch", "bisexuell"),
        ("einwanderer", "einheimische", "flüchtlinge"),
        ("gehörlos", "blinde", "behindert"),
    ),
    "fr": (
        ("femmes", "hommes"),
        ("femme", "homme"),
        ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
        ("noirs", "blancs", "asiatiques", "africains", "européens"),
        ("immigrés", "natifs", "réfugiés"),
        ("sourds", "aveugles", "handicapés"),
    ),
    "es": (
        ("mujeres", "hombres"),
        ("mujer", "hombre"),
        ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
        ("negros", "blancos", "asiáticos", "africanos", "europeos"),
        ("inmigrantes", "nativos", "refugiados"),
        ("sordos", "ciegos", "discapacitados"),
    ),
}


def swaps(terms: dict[str, tuple] = IDENTITY_TERMS) -> dict[str, str]:
    """{term: its counterpart} over all languages; a term of several keeps its first counterpart."""
    out: dict[str, str] = {}
    for groups in terms.values():
        for group in groups:
            for i, term in enumerate(group):
                out.setdefault(term, group[(i + 1) % len(group)])
    return out


def features(text: str | None) -> set[str]:
    """Distinct lower-case words, and beginnings of longer words marked by ``^``."""
    words = set(WORD.findall((text or "").lower()))
    return words | {"^" + w[:STEM] for w in words if len(w) > STEM}


def swapped(words: set[str], pairs: dict[str, str]) -> list[set[str]]:
    """The features with every identity term replaced by its counterpart, and by a word of no weight."""
    plain = {w for w in words if w[0] != "^"}
    out = []
    for other in ({pairs.get(w, w) for w in plain}, plain - pairs.keys()):
        out.append(other | {"^" + w[:STEM] for w in other if len(w) > STEM})
    return out


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -20.0

    def __post_init__(self):
        self.known = frozenset(self.weights)

    def score(self, text: str | None) -> float:
        z = self.bias + sum(sorted(self.weights[w] for w in features(text) & self.known))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _term_counts(batch: pa.RecordBatch) -> dict:
    n: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
        n[1 if y else 0].update(features(text))
    words = list(n[0].keys() | n[1].keys())
    return {"word": words, "n0": [n[0][w] for w in words], "n1": [n[1][w] for w in words]}


def _indexed(index: dict[str, int], pairs: dict[str, str]):
    def run(batch: pa.RecordBatch) -> dict:
        ids, others = [], []
        for text in batch.column("text").to_pylist():
            found = features(text)
            ids.append(sorted(index[w] for w in found & index.keys()))
            other = swapped(found, pairs) if not found.isdisjoint(pairs) else None
            others.append(None if other is None else [sorted(index[w] for w in o & index.keys()) for o in other])
        kind = pa.list_(pa.int32())
        return {"y": batch.column("y"), "ids": pa.array(ids, kind), "others": pa.array(others, pa.list_(kind))}

    return run


def _rows(lists: list) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in lists], dtype=np.int64)
    cols = np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(lists) else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(lists)), n), cols


class Loss:
    """Mean log loss, ridge, and the penalty on score changes of rows that name a group."""

    def __init__(self, y: np.ndarray, ids: list, others: list, size: int, penalty: float, l2: float):
        self.y, self.size, self.penalty, self.l2 = y, size, penalty, l2
        own = [(ids[i], other) for i, swaps_of in enumerate(others) for other in swaps_of or ()]
        self.named = len(own)
        self.all, self.this, self.that = _rows(ids), _rows([a for a, _ in own]), _rows([b for _, b in own])

    def _parts(self, w: np.ndarray, b: float) -> tuple[np.ndarray, np.ndarray]:
        z = np.bincount(self.all[0], w[self.all[1]], minlength=len(self.y)) + b
        change = np.bincount(self.this[0], w[self.this[1]], minlength=self.named)
        return z, change - np.bincount(self.that[0], w[self.that[1]], minlength=self.named)

    def value(self, w: np.ndarray, b: float) -> float:
        z, change = self._parts(w, b)
        fit = np.logaddexp(0, z) - self.y * z
        return float(fit.mean() + self.l2 * (w @ w) / 2 / len(self.y) + self.penalty * (change @ change) / max(1, self.named))

    def gradient(self, w: np.ndarray, b: float) -> np.ndarray:
        z, change = self._parts(w, b)
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - self.y) / len(self.y)
        g = np.bincount(self.all[1], err[self.all[0]], minlength=self.size) + self.l2 * w / len(self.y)
        if self.named:
            pull = 2 * self.penalty * change / self.named
            g += np.bincount(self.this[1], pull[self.this[0]], minlength=self.size)
            g -= np.bincount(self.that[1], pull[self.that[0]], minlength=self.size)
        return np.append(g, err.sum())


def fit(
    y: np.ndarray, ids: list, others: list, size: int, penalty: float = 1.0, l2: float = 0.003, steps: int = 400
) -> tuple[np.ndarray, float]:
    """Weights and bias; ``others`` holds the swaps' features of each row that names a group, else None."""

    loss = Loss(y, ids, others, size, penalty, l2)
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        g = loss.gradient(w, b)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def calibrate(z: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> tuple[float, float]:
    """Slope and offset of a logistic fit of the labels on the raw scores, both labels weighing alike."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    x = np.stack([z, np.ones_like(z)], axis=1)
    t = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * (t - [1.0, 0.0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        t = t - step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
    return max(1e-3, float(t[0])), float(t[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 12_000,
    vocabulary: int = 4_096,
    least_z: float = 3.0,
    least_odds: float = 1.5,
    folds: int = 3,
    held_out: int = 1,
    terms: dict[str, tuple] = IDENTITY_TERMS,
    penalty: float = 1.0,
) -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out fold.

    The model's features are the ``vocabulary`` words whose log odds of being in
    a document differ most between the labels (by at least ``least_odds`` and
    ``least_z`` deviations), and all identity ``terms``; ``penalty`` weighs the mean squared change of
    the raw score under their swaps.  Words are counted on the executors; the driver sees
    the chosen words and the sample's feature numbers only.
    """
    rows = stored(labelled_sample(docs, labels, "toxic", training_fold(folds, held_out), sample).select("text", "y"))
    total = {r["y"]: r["n"] for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    if not n0 or not n1:
        return Model({}, 20.0 if n1 else -20.0)
    counted = (
        arrow_map(rows, _term_counts, "word string, n0 long, n1 long")
        .groupBy("word")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    odds = F.log((F.col("n1") + 0.5) / (n1 - F.col("n1") + 0.5)) - F.log((F.col("n0") + 0.5) / (n0 - F.col("n0") + 0.5))
    z = odds / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    chosen = (
        counted.withColumn("z", z)
        .where((F.abs("z") >= least_z) & (F.abs(odds) >= least_odds))
        .orderBy(F.abs("z").desc(), "word")
        .limit(vocabulary)
        .collect()
    )
    pairs = swaps(terms)
    words = sorted({r["word"] for r in chosen} | set(pairs))
    index = {w: i for i, w in enumerate(words)}
    got = arrow_map(rows, _indexed(index, pairs), "y int, ids array<int>, others array<array<int>>").collect()
    y = np.array([1.0 if r["y"] else 0.0 for r in got])
    w, b = fit(y, [r["ids"] for r in got], [r["others"] for r in got], len(words), penalty)
    slope, offset = calibrate(np.array([w[r["ids"]].sum() + b for r in got]), y)
    w, b = slope * w, slope * b + offset
    return Model({x: float(w[i]) for x, i in index.items() if abs(w[i]) > 1e-6}, b)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for every row; a null or empty text has the score of no features."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> dict:
        return {
            "doc_id": batch.column("doc_id"),
            "score": [shared.value.score(t) for t in batch.column("text").to_pylist()],
        }

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(own, score, "doc_id long, score double")


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 3,
    held_out: int = 1,
    terms: dict[str, tuple] = IDENTITY_TERMS,
    penalty: float = 1.0,
) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.7 on) for every row."""
    model = train(docs, labels, folds=folds, held_out=held_out, terms=terms, penalty=penalty)
    return score_documents(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
