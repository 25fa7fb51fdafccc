"""Document quality by a linear-chain conditional random field over lines (operator 8).

Every line is labelled good or bad from its own features, its neighbours' and
the transition to the next line's label.  A document's score is the mean of the
lines' forward-backward marginals, weighted by line length.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import arrow_map, fold
from daybook.llm.sampling import labelled_sample, training_fold

# bounds of the feature values; a line's value becomes the number of bounds it reaches
BOUNDS = (
    (0.02, 0.05, 0.1, 0.3, 0.6),  # share of upper-case letters
    (0.002, 0.01, 0.03, 0.08, 0.15),  # share of ASCII symbols
    (0.005, 0.02, 0.08, 0.2, 0.5),  # share of digits
    (1.5, 3.5, 6.5, 12.5, 30.5),  # words
    (2.5, 4, 5.5, 7, 9),  # characters a word
    (0.2, 0.4, 0.6, 0.8, 0.95),  # distinct words / words
    (0.06, 0.12, 0.25, 0.5, 0.8),  # share of the most frequent word
    (0.02, 0.1, 0.25, 0.4, 0.6),  # words followed by themselves
    (0.02, 0.1, 0.25, 0.4, 0.6),  # words without a letter or digit
    (0.005, 0.03, 0.06, 0.1, 0.2),  # sentence marks a word / 10
    (0.5, 1.5, 2.5, 4.5, 9.5),  # earlier equal lines of the document
    (0.02, 0.1, 0.25, 0.5, 0.8),  # words that end in a doubled mark
)
N_BINS = 6
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = bytes(c for c in range(33, 127) if chr(c) not in ".,;:'\"-()?" and not chr(c).isalnum())
ENDS = b".?!"


def line_features(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features) bin numbers and the lines' lengths in bytes."""
    seen: Counter[str] = Counter()
    values, lengths = [], []
    for line in lines:
        raw = line.encode("utf-8", "surrogatepass")
        n = max(1, len(raw))
        words = line.split()
        k = max(1, len(words))
        count = Counter(words)
        doubled = sum(1 for a, b in zip(words, words[1:]) if a == b)
        bare = marked = 0
        for w, c in count.items():
            if not (w[0].isalnum() or w[-1].isalnum() or any(map(str.isalnum, w))):
                bare += c
            elif len(w) > 2 and w[-1] == w[-2] and not w[-1].isalnum():
                marked += c
        upper = len(raw) - len(raw.translate(None, UPPER))
        symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        digits = len(raw) - len(raw.translate(None, DIGITS))
        ends = len(raw) - len(raw.translate(None, ENDS))
        top = max(count.values(), default=0)
        values.append(
            (
                upper / n, symbols / n, digits / n, len(words), n / k, len(count) / k, top / k,
                doubled / k, bare / k, ends / k / 10, seen[line], marked / k,
            )
        )
        seen[line] += 1
        lengths.append(n)
    v = np.array(values).reshape(-1, len(BOUNDS))
    bins = np.stack([np.searchsorted(b, v[:, i], side="right") for i, b in enumerate(BOUNDS)], axis=1)
    return bins.astype(np.int8), np.array(lengths, dtype=np.int64)


def split_lines(text: str | None) -> list[str]:
    return [x for x in (text or "").split("\n") if x.strip()]


@dataclass
class Crf:
    own: np.ndarray  # (features, bins, 2) weights of a line's own values
    before: np.ndarray  # ... of the line before
    after: np.ndarray  # ... of the line after
    move: np.ndarray  # (2, 2) transition
    bias: np.ndarray  # (2,)
    prior: float  # score of a document without lines

    def unary(self, bins: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        f = np.arange(len(BOUNDS))
        own, before, after = (w[f, bins].sum(axis=1) for w in (self.own, self.before, self.after))
        out = own + self.bias
        out[1:] += np.where(first[1:, None], 0, before[:-1])
        out[:-1] += np.where(last[:-1, None], 0, after[1:])
        return out

    def messages(self, unary: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log sums; documents run side by side, the longest first."""
        order = np.argsort(-sizes, kind="stable")
        at, size = starts[order], sizes[order]
        forward, backward = np.empty_like(unary), np.zeros_like(unary)
        longest = int(size[0]) if len(size) else 0
        live = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
        for t in range(longest):
            k = live[t]
            if t == 0:
                forward[at[:k]] = unary[at[:k]]
            else:
                p = forward[at[:k] + t - 1][:, :, None] + self.move[None]
                forward[at[:k] + t] = np.logaddexp(p[:, 0], p[:, 1]) + unary[at[:k] + t]
        for t in range(longest - 2, -1, -1):
            k = live[t + 1]
            nxt = at[:k] + t + 1
            p = self.move[None] + (unary[nxt] + backward[nxt])[:, None, :]
            backward[nxt - 1] = np.logaddexp(p[:, :, 0], p[:, :, 1])
        return forward, backward

    def marginals(self, unary: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """P(label) of every line."""
        both = np.add(*self.messages(unary, starts, sizes))
        return np.exp(both - np.logaddexp(both[:, 0], both[:, 1])[:, None])


def _flat(per_doc: list[np.ndarray]):
    sizes = np.array([len(b) for b in per_doc], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    some = sizes > 0
    first[starts[some]] = True
    last[(starts + sizes - 1)[some]] = True
    bins = np.concatenate(per_doc) if n else np.zeros((0, len(BOUNDS)), np.int8)
    return bins, starts, sizes, first, last


def fit(per_doc: list[np.ndarray], y: np.ndarray, steps: int = 150, l2: float = 1e-3, rate: float = 0.1) -> Crf:
    """Maximum likelihood by Adam; each line carries its document's label."""
    per_doc, y = [b for b in per_doc if len(b)], np.array([v for b, v in zip(per_doc, y) if len(b)])
    shape = (len(BOUNDS), N_BINS, 2)
    crf = Crf(np.zeros(shape), np.zeros(shape), np.zeros(shape), np.zeros((2, 2)), np.zeros(2), 0.0)
    if not per_doc or len(set(y.tolist())) < 2:
        crf.bias = np.array([0.0, 4.0 if len(y) and y[0] else -4.0])
        return crf
    bins, starts, sizes, first, last = _flat(per_doc)
    gold = np.repeat(y, sizes)
    # documents count alike, whatever their number of lines
    weight = np.repeat(1.0 / sizes, sizes) / len(sizes)
    truth = np.eye(2)[gold]
    f = np.arange(len(BOUNDS))
    params = [crf.own, crf.before, crf.after, crf.move, crf.bias]
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat = (f * N_BINS)[None] + bins
    for step in range(1, steps + 1):
        u = crf.unary(bins, first, last)
        forward, backward = crf.messages(u, starts, sizes)
        norm = np.logaddexp(*(forward + backward).T)
        p = np.exp(forward + backward - norm[:, None])
        err = (p - truth) * weight[:, None]
        grads = []
        for shift in (0, 1, -1):
            e = err
            if shift == 1:  # the line before carries the features
                e = np.vstack([np.where(first[1:, None], 0, err[1:]), np.zeros((1, 2))])
            elif shift == -1:
                e = np.vstack([np.zeros((1, 2)), np.where(last[:-1, None], 0, err[:-1])])
            g = np.stack(
                [
                    np.bincount(flat.ravel(), np.repeat(e[:, c], len(BOUNDS)), minlength=len(BOUNDS) * N_BINS)
                    for c in range(2)
                ],
                axis=1,
            )
            grads.append(g.reshape(shape))
        pair = ~last[:-1]
        ahead = (u + backward)[1:]
        joint = forward[:-1][:, :, None] + crf.move[None] + ahead[:, None, :] - norm[:-1, None, None]
        joint = np.exp(np.where(pair[:, None, None], joint, 0))
        seen = truth[:-1][:, :, None] * truth[1:][:, None, :]
        grads.append(((joint - seen) * (weight[:-1] * pair)[:, None, None]).sum(axis=0))
        grads.append(err.sum(axis=0))
        for i, (q, g) in enumerate(zip(params, grads)):
            g = g + l2 * q / len(sizes) ** 0.5
            mean[i] = 0.9 * mean[i] + 0.1 * g
            var[i] = 0.999 * var[i] + 0.001 * g * g
            q -= rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(var[i] / (1 - 0.999**step)) + 1e-8)
    return crf


def _sample_features(batch: pa.RecordBatch) -> dict:
    out = [line_features(split_lines(t))[0].tobytes() for t in batch.column("text").to_pylist()]
    return {"y": batch.column("y"), "bins": pa.array(out, pa.binary())}


def train(
    docs: DataFrame, labels: DataFrame, sample: int = 8_000, longest: int = 2_000, folds: int = 3, held_out: int = 1
) -> Crf:
    """Fit on at most ``sample`` labelled documents of at most ``longest`` lines outside the held-out fold.

    Only line features (12 bytes a line) reach the driver, so the two parameters bound the fit's rows;
    documents of any length are scored.
    """
    rows = labelled_sample(docs, labels, "quality", training_fold(folds, held_out), sample)
    got = arrow_map(rows.select("text", "y"), _sample_features, "y int, bins binary").where(
        F.length("bins") <= longest * len(BOUNDS)
    ).collect()
    per_doc = [np.frombuffer(r["bins"], np.int8).reshape(-1, len(BOUNDS)) for r in got]
    return fit(per_doc, np.array([1 if r["y"] else 0 for r in got], dtype=np.int64))


def score_texts(crf: Crf, texts: list[str | None]) -> np.ndarray:
    feats = [line_features(split_lines(t)) for t in texts]
    bins, starts, sizes, first, last = _flat([f[0] for f in feats])
    out = np.full(len(texts), crf.prior)
    if len(bins):
        p = crf.marginals(crf.unary(bins, first, last), starts, sizes)[:, 1]
        length = np.concatenate([f[1] for f in feats]).astype(float)
        some = sizes > 0
        out[some] = np.add.reduceat(p * length, starts[some]) / np.add.reduceat(length, starts[some])
    return np.clip(out, 0.0, 1.0)


def _scores(crf: Crf, texts: list[str | None]) -> np.ndarray:
    parts = [score_texts(crf, texts[i : i + 1_000]) for i in range(0, len(texts), 1_000)]
    return np.concatenate(parts) if parts else np.zeros(0)


def score_documents(docs: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, score of every row; null and blank texts have the prior, 0."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def score(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "score": _scores(shared.value, batch.column("text").to_pylist())}

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(own, score, "doc_id long, score double")


def kept_documents(docs: DataFrame, crf: Crf, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``least`` or more; blank and null texts go."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def keep(batch: pa.RecordBatch) -> dict:
        good = pa.array(_scores(shared.value, batch.column("text").to_pylist()) >= least)
        return {c: batch.column(c).filter(good) for c in batch.schema.names}

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return arrow_map(docs, keep, kind)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.5 on) for every row."""
    crf = train(docs, labels, folds=folds, held_out=held_out)
    return score_documents(docs, crf).select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
