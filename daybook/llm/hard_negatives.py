"""Hard negatives by length buckets and coordinate pruning (operator 13).

Rows stream past the anchors of a cell (``pairing``) from the longest vector to the
shortest, in buckets.  A bucket keeps, for every coordinate, the list of its rows
sorted by that coordinate of the unit vector.  What an anchor still needs, over the
two lengths, is the least cosine a row of the bucket must have.  If the anchor's unit
vector stands at angle ``a`` to an axis, a row within angle ``t`` of the anchor
stands at an angle in [a - t, a + t]; so each of the anchor's focus
coordinates (its largest ones) has a feasible range of values, found in the sorted
list by binary search.  Rows in all ranges are verified by exact products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import stored
from daybook.llm.pairing import block_of, extent, in_cells, matrices, search_cells
from daybook.llm.topk import DENSE, Best, exact, vectors

FOCUS = 4
SLACK = 1e-9  # of a cosine, against rounding
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Bucket:
    """Rows of similar length with a sorted list for every coordinate."""

    def __init__(self, x: np.ndarray):
        xf = x.astype(float)
        size = np.sqrt((xf * xf).sum(axis=1))
        self.longest = float(size.max(initial=0.0))
        self.unit = np.ascontiguousarray((xf / np.where(size > 0, size, 1.0)[:, None]).T)
        self.order = np.argsort(self.unit, axis=1)
        self.lists = np.take_along_axis(self.unit, self.order, axis=1)

    def within(self, coordinates: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows whose values lie in the ranges of all given coordinates."""
        spans = [
            (np.searchsorted(self.lists[f], a, "left"), np.searchsorted(self.lists[f], b, "right"))
            for f, a, b in zip(coordinates, low, high)
        ]
        least = min(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0])
        rows = self.order[coordinates[least], slice(*spans[least])]
        for i, f in enumerate(coordinates):
            if i != least and len(rows):
                value = self.unit[f, rows]
                rows = rows[(value >= low[i]) & (value <= high[i])]
        return rows


class Anchors:
    """Anchors of one vector length, the score windows of each, and the best rows of each window so far."""

    def __init__(self, ids, labels, q, low, high, same: bool, k: int):
        self.ids, self.labels, self.q, self.low, self.high, self.same = ids, labels, q, low, high, same
        self.qf = q.astype(float)
        self.size = np.sqrt((self.qf * self.qf).sum(axis=1))
        unit = self.qf / np.where(self.size > 0, self.size, 1.0)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.angle = np.arccos(np.clip(np.take_along_axis(unit, self.focus, axis=1), -1, 1))
        self.best = Best(low.size, k)

    def need(self) -> np.ndarray:
        """The least score with which a row can still enter some window of the anchor."""
        return np.maximum(self.low.astype(float), self.best.floor().reshape(self.low.shape)).min(axis=1)

    def feasible(self, bucket: Bucket, rows: slice, n: int) -> np.ndarray:
        """Anchors x rows of the bucket: inside the ranges of all focus coordinates."""
        need, size = self.need()[rows], self.size[rows]
        out = np.zeros((len(need), n), bool)
        reach = size * bucket.longest * (1 + SLACK)
        for i in np.flatnonzero((need <= 0) | (need <= reach)):
            if need[i] <= 0 or not self.focus.shape[1]:
                out[i] = True
                continue
            t = np.arccos(max(-1.0, min(1.0, need[i] / reach[i] - SLACK)))
            angle = self.angle[rows][i]
            low = np.cos(np.minimum(np.pi, angle + t)) - SLACK
            high = np.cos(np.maximum(0.0, angle - t)) + SLACK
            out[i, bucket.within(self.focus[rows][i], low, high)] = True
        return out

    def add(self, vid: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        bucket = Bucket(x)
        xf = x.astype(float)
        for start in range(0, len(self.ids), 512):
            part = slice(start, start + 512)
            alive = self.feasible(bucket, part, len(vid))
            alive &= (self.labels[part, None] == labels[None, :]) == self.same
            alive &= self.ids[part, None] != vid[None, :]
            top = np.abs(self.qf[part]).max(initial=0.0) * np.abs(xf).max(initial=0.0) * x.shape[1]
            if alive.mean() > DENSE and top < 2.0**53:
                s = self.qf[part] @ xf.T  # exact in doubles at this size
                r, c = np.nonzero(alive & (s >= self.need()[part, None]))
                self._keep(r + start, vid[c], s[r, c].astype(np.int64))
                continue
            r, c = np.nonzero(alive)
            for i in range(0, len(r), 100_000):
                rr, cc = r[i : i + 100_000] + start, c[i : i + 100_000]
                self._keep(rr, vid[cc], exact(self.q[rr], x[cc]))

    def _keep(self, r: np.ndarray, vid: np.ndarray, score: np.ndarray) -> None:
        slots = self.low.shape[1]
        for j in range(slots):
            ok = (score >= self.low[r, j]) & (score <= self.high[r, j])
            self.best.add(r[ok] * slots + j, vid[ok], score[ok])


FOUND = "anchor_id long, akey long, slot int, vec_id long, score long"


class _Cell:
    def __init__(self, queries: pa.RecordBatch, same: bool, k: int):
        self.by_size = {}
        ids, labels, keys = (queries.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "akey"))
        windows = [queries.column(c).to_pylist() for c in ("low", "high")]
        for n, (rows, q) in matrices(queries).items():
            slots = max(len(windows[0][i]) for i in rows)
            # an unused slot is an empty window
            low = np.array([windows[0][i] + [MOST] * (slots - len(windows[0][i])) for i in rows], dtype=np.int64)
            high = np.array([windows[1][i] + [LEAST] * (slots - len(windows[1][i])) for i in rows], dtype=np.int64)
            self.by_size[n] = keys[rows], Anchors(ids[rows], labels[rows], q, low, high, same, k)

    def add(self, batch: pa.RecordBatch) -> None:
        ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        for n, (rows, x) in matrices(batch).items():
            if n in self.by_size:
                self.by_size[n][1].add(ids[rows], labels[rows], x)

    def found(self) -> Iterator[pa.RecordBatch]:
        for keys, anchors in self.by_size.values():
            best, slots = anchors.best, anchors.low.shape[1]
            r, c = np.nonzero(np.arange(best.k)[None, :] < best.filled[:, None])
            if len(r):
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor_id": anchors.ids[r // slots],
                        "akey": keys[r // slots],
                        "slot": pa.array(r % slots, pa.int32()),
                        "vec_id": best.vec[r, c],
                        "score": best.score[r, c],
                    }
                )


def _search(
    anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, block: int, same: bool, k: int
) -> DataFrame:
    """The k best rows of every window: anchor_id, akey, slot, vec_id, score, rank."""
    none = F.lit(None).cast("array<long>")
    told = rows.select("vec_id", "label", "v", "akey", none.alias("low"), none.alias("high"))
    cells = in_cells(anchors.select(*told.columns), told, n_anchors, n_rows, block)
    found = search_cells(cells, lambda queries: _Cell(queries, same, k), FOUND)
    order = Window.partitionBy("anchor_id", "akey", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    label: Column,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int | None = None,
) -> DataFrame:
    """For every anchor and each of its best positives, the best negatives not far below it.

    Anchors are the rows whose id is divisible by ``every``; positives its best other
    rows of the same ``label``; negatives the best rows of another label whose score
    lies between ``least_percent`` of the positive's score and that score.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, or a null or non-finite component, take no
    part.  Rows equal in id, label and vector are one row; rows that share an id only
    are rows of their own, and never each other's positives or negatives.  Products
    are taken between vectors of one length; empty vectors score 0.  An anchor
    without positives, or a positive without negatives in its range, has no row.
    """
    named = rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("embedding"), label.cast("long").alias("label"))
    own = stored(
        vectors(named.where(F.col("label").isNotNull()), "vec_id", "embedding", keep=["label"])
        .withColumn("akey", F.xxhash64("label", "v"))
        .dropDuplicates(["vec_id", "akey"])
    )
    n_rows, dim = extent(own)
    block = block or block_of(dim)  # anchors that a task holds
    asked = own.where(F.col("vec_id") % every == 0)
    n_anchors = asked.count()
    everything = asked.select(
        "*", F.array(F.lit(LEAST).cast("long")).alias("low"), F.array(F.lit(MOST).cast("long")).alias("high")
    )
    best = _search(everything, own, n_anchors, n_rows, block, True, positives)
    # an integer n satisfies least * p <= 100 * n exactly if it is at least the ceiling; below 0 no n does
    rest = 100 - least_percent
    floor = F.expr(f"score - (score div 100) * {rest} - ((score % 100) * {rest}) div 100").alias("low")
    pairs = stored(best.where("score >= 0").select("anchor_id", "akey", "rank", F.col("vec_id").alias("positive_id"), "score", floor))
    windows = pairs.groupBy("anchor_id", "akey").agg(F.array_sort(F.collect_list(F.struct("rank", "low", "score"))).alias("w"))
    again = asked.join(
        windows.select(F.col("anchor_id").alias("vec_id"), "akey", F.col("w.low").alias("low"), F.col("w.score").alias("high")),
        ["vec_id", "akey"],
    )
    found = _search(again, own, n_anchors, n_rows, block, False, negatives)
    return (
        pairs.withColumnRenamed("rank", "slot")
        .withColumn("slot", F.col("slot") - 1)
        .withColumnRenamed("score", "positive_score")
        .join(found, ["anchor_id", "akey", "slot"])
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


ORACLE = """
WITH d AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT *, row_number() OVER () AS uid FROM d
), s AS (
  SELECT a.uid AS anchor, b.uid AS other, a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same
  WHERE p.place <= 5 AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
