"""Exact top-k inner products with multi-resolution segment statistics (operator 4).

A segment's mean and deviation bound its part of a distance from below, and so,
with the norms, its part of an inner product from above:
``sum over segments of length * (mean_q * mean_x + dev_q * dev_x)``.  Bounds are
taken with one segment, then with more and shorter ones; only candidates whose
bound still reaches the query's k-th best score are computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import stored
from daybook.llm.pairing import block_of, extent, in_cells, matrices, search_cells

DENSE = 0.02  # share of a block's pairs from which the survivors are computed as one product


def quantised(vector: str = "embedding", factor: int = 256):
    """floor(factor * x) of every component, x taken as double."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * F.lit(float(factor))))


def vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", factor: int = 256, keep: list[str] | None = None
) -> DataFrame:
    """(vec_id, v, columns to keep) of the rows that take part: no null, no null or non-finite component."""
    finite = F.forall(
        F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return df.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).where(finite).select(
        F.col(key).cast("long").alias("vec_id"), quantised(vector, factor).cast("array<long>").alias("v"), *(keep or [])
    )


def levels(dim: int) -> list[int]:
    """Numbers of segments, coarse to fine; the finest has segments of four or more."""
    out, n = [], 1
    while n == 1 or dim // n >= 4:
        out.append(n)
        n *= 4
    return out


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment mean and deviation, scaled so that a bound is a plain inner product."""
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)
    parts = []
    for a, b in zip(edges, edges[1:]):
        s = x[:, a:b]
        mean = s.mean(axis=1)
        dev = np.sqrt(np.maximum(0.0, (s * s).mean(axis=1) - mean * mean))
        parts += [mean * np.sqrt(b - a), dev * np.sqrt(b - a)]
    return np.stack(parts, axis=1)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row-wise integer inner products; beyond 64 bits by Python integers, held to the long range."""
    if not len(q):
        return np.zeros(0, np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0**62:
        return np.einsum("ij,ij->i", q, x)
    sums = (q.astype(object) * x.astype(object)).sum(axis=1)
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in sums], dtype=np.int64)


class Best:
    """The k best (score, vec_id) of each query so far; ties to the smaller vec_id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.vec = np.full((n, k), np.iinfo(np.int64).max)
        self.filled = np.zeros(n, np.int64)

    def floor(self) -> np.ndarray:
        return np.where(self.filled >= self.k, self.score[:, -1].astype(float), -np.inf)

    def add(self, q: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        if not len(q):
            return
        touched = np.unique(q)
        pos = np.searchsorted(touched, q)
        have = np.arange(self.k)[None, :] < self.filled[touched][:, None]
        r, c = np.nonzero(have)
        rows = np.concatenate([pos, r])
        vecs = np.concatenate([vec, self.vec[touched][r, c]])
        scores = np.concatenate([score, self.score[touched][r, c]])
        order = np.lexsort((vecs, ~scores, rows))  # ~score: descending without overflow
        rows, vecs, scores = rows[order], vecs[order], scores[order]
        start = np.searchsorted(rows, np.arange(len(touched)))
        rank = np.arange(len(rows)) - start[rows]
        keep = rank < self.k
        self.score[touched[rows[keep]], rank[keep]] = scores[keep]
        self.vec[touched[rows[keep]], rank[keep]] = vecs[keep]
        self.filled[touched] = np.minimum(self.k, np.bincount(rows, minlength=len(touched)))


def search_block(best: Best, qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray) -> None:
    """Bounds coarse to fine, then exact products of the survivors, for one block of rows."""
    if not len(x) or not len(q):
        return
    if not q.shape[1]:  # empty vectors: every score is 0
        r, c = np.nonzero(qid[:, None] != vid[None, :])
        best.add(r, vid[c], np.zeros(len(r), np.int64))
        return
    qf, xf = q.astype(float), x.astype(float)
    # a float bound may be off by rounding; the margin keeps it an upper bound
    margin = 1e-9 * np.sqrt((qf * qf).sum(axis=1))[:, None] * np.sqrt((xf * xf).sum(axis=1)).max() + 1e-6
    alive = qid[:, None] != vid[None, :]
    stats = [(statistics(qf, n), statistics(xf, n)) for n in levels(q.shape[1])]
    # first scores: the rows with the best finest bounds of each query
    bound = stats[-1][0] @ stats[-1][1].T
    some = min(len(vid), 2 * best.k + 1)
    first = np.argpartition(-bound, some - 1, axis=1)[:, :some]
    r, c = np.repeat(np.arange(len(q)), some), first.ravel()
    ok = alive[r, c]
    r, c = r[ok], c[ok]
    best.add(r, vid[c], exact(q[r], x[c]))
    alive[r, c] = False
    need = best.floor()[:, None] - margin
    for a, b in stats:
        alive &= (a @ b.T) >= need
        if not alive.any():
            return
    if alive.mean() > DENSE and np.abs(qf).max() * np.abs(xf).max() * q.shape[1] < 2.0**53:
        # many survivors: one product of the blocks, exact in doubles at this size
        s = qf @ xf.T
        r, c = np.nonzero(alive & (s >= best.floor()[:, None]))
        best.add(r, vid[c], s[r, c].astype(np.int64))
        return
    r, c = np.nonzero(alive)
    for i in range(0, len(r), 500_000):
        rr, cc = r[i : i + 500_000], c[i : i + 500_000]
        s = exact(q[rr], x[cc])
        reach = s >= best.floor()[rr]
        best.add(rr[reach], vid[cc[reach]], s[reach])


FOUND = "query_id long, vec_id long, score long"


class _Cell:
    """The queries of a cell by vector length, with the k best rows of each so far."""

    def __init__(self, queries: pa.RecordBatch, k: int):
        ids, copies = (queries.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "copies"))
        self.by_size = {
            n: (ids[rows], q, copies[rows], Best(len(rows), k)) for n, (rows, q) in matrices(queries).items()
        }

    def add(self, batch: pa.RecordBatch) -> None:
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        for n, (rows, x) in matrices(batch).items():
            if n not in self.by_size:
                continue
            qid, q, _, best = self.by_size[n]
            for i in range(0, len(q), 512):
                part = Best(0, best.k)
                part.score, part.vec = best.score[i : i + 512], best.vec[i : i + 512]
                part.filled = best.filled[i : i + 512]
                search_block(part, qid[i : i + 512], q[i : i + 512], ids[rows], x)

    def found(self) -> Iterator[pa.RecordBatch]:
        for qid, _, copies, best in self.by_size.values():
            r, c = np.nonzero(np.arange(best.k)[None, :] < best.filled[:, None])
            # every copy of a query has its own pairs
            r, c = np.repeat(r, copies[r]), np.repeat(c, copies[r])
            if len(r):
                yield pa.RecordBatch.from_pydict({"query_id": qid[r], "vec_id": best.vec[r, c], "score": best.score[r, c]})


def top_k(
    rows: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding", block: int | None = None
) -> DataFrame:
    """The k best other rows of every query (rows whose id is divisible by ``every``).

    query_id, rank (from 1), vec_id, score.  Queries and rows meet in cells
    (``pairing``): a task holds about ``block`` queries (by default by their bytes) and streams a group
    of rows past them, and keeps k rows per query.  Rows with a
    null id or vector, or a null or non-finite component, take no part; rows
    of the query's id are not its candidates, and products are taken between
    vectors of one length (empty vectors score 0).  As in ORACLE, rows that repeat
    an id are rows: each takes a rank as a candidate, and each counts as a query.
    """
    own = vectors(rows, key, vector)
    # of the copies of a query, more than k cannot change its k best pairs
    copies = F.least(F.count(F.lit(1)), F.lit(k)).alias("copies")
    asked = stored(own.where(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(copies))
    told = own.withColumn("copies", F.lit(0).cast("long"))
    n_rows, dim = extent(own)
    cells = in_cells(asked.select(*told.columns), told, asked.count(), n_rows, block or block_of(dim))
    out = search_cells(cells, lambda queries: _Cell(queries, k), FOUND)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        out.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
