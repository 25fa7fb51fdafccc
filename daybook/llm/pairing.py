"""A set of query vectors against all rows, in cells that executors hold.

Rows are dealt over G groups and queries over H blocks by a hash of their contents;
a cell is a (group, block).  Each row goes to the H cells of its group, each
query to the G cells of its block, and a task reads a cell's queries first and then
streams its rows past them, longest vectors first.  A task holds about ``block``
queries (``block_of``: by their bytes) and one Arrow batch of rows; nothing passes the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import map_batches

GROUP_ROWS = 2_048
BLOCK_BYTES = 16 << 20  # vectors of the queries that a task holds
MOST_PARTITIONS = 50_000  # of a shuffle; beyond, a task takes several cells in turn


def extent(rows: DataFrame, vector: str = "v") -> tuple[int, int]:
    """(number of rows, longest vector)."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("dim")).first()
    return r["n"], r["dim"] or 0


def block_of(dim: int) -> int:
    """Queries of a block: as many vectors of ``dim`` components as BLOCK_BYTES holds."""
    return max(64, BLOCK_BYTES // (8 * max(1, dim)))


def in_cells(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int, block: int, vector: str = "v") -> DataFrame:
    """Both tables (same columns) dealt over cells: ``__cell``, ``__row`` (false for queries), sorted for a stream."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(parts, -(-n_rows // GROUP_ROWS)))
    blocks = max(1, -(-n_queries // block))
    place = F.xxhash64(*rows.columns)
    all_groups, all_blocks = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (groups, blocks))
    cell = (F.col("__g") * blocks + F.col("__b")).alias("__cell")
    asked = queries.select("*", all_groups.alias("__g"), F.pmod(place, F.lit(blocks)).alias("__b"))
    told = rows.select("*", F.pmod(place, F.lit(groups)).alias("__g"), all_blocks.alias("__b"))
    size = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")).alias("__size")
    both = asked.select(*rows.columns, F.lit(False).alias("__row"), cell, size).unionByName(
        told.select(*rows.columns, F.lit(True).alias("__row"), cell, size)
    )
    return both.repartition(min(groups * blocks, MOST_PARTITIONS), "__cell").sortWithinPartitions("__cell", "__row", F.desc("__size"))


def matrices(batch: pa.RecordBatch, vector: str = "v") -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{length: (row numbers, vectors)}: products are taken between vectors of one length."""
    v = batch.column(vector)
    sizes = np.diff(v.offsets.to_numpy())
    flat = v.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    out = {}
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        out[int(n)] = (rows, flat[starts[rows][:, None] + np.arange(n)[None, :]].reshape(len(rows), int(n)))
    return out


def search_cells(cells: DataFrame, searcher: Callable, schema: str) -> DataFrame:
    """Run ``searcher(queries)`` for each cell: ``add(rows)`` for its batches, then the batches of ``found()``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked, search = None, [], None
        for batch in batches:
            at = batch.column("__cell").to_numpy(zero_copy_only=False)
            told = batch.column("__row").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(told.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                if at[a] != cell:
                    if search is not None:
                        yield from search.found()
                    cell, asked, search = at[a], [], None
                part = batch.slice(a, b - a)
                if not told[a]:
                    asked.append(part)
                elif asked:
                    if search is None:
                        search = searcher(pa.Table.from_batches(asked).combine_chunks().to_batches()[0])
                    search.add(part)
        if search is not None:
            yield from search.found()

    return map_batches(cells, run, schema)
