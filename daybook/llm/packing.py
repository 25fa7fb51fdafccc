"""Best-fit packing by hierarchical residual merging (operator 2).

Each partition packs its own pieces best-fit and closes the bins that are nearly
full.  The pieces of the underfull bins of ``FAN`` neighbours then meet in a
further best-fit round, and so on up the tree; no bin is closed for another
reason.  A task holds about ``BLOCK`` local pieces or ``FAN * CARRY`` merged ones
at most: a node with more is dealt by a hash over several tasks, each a mix of all
lengths.  If the root takes several tasks, it is dealt anew as long as that lowers the
number of bins, and then the emptiest bins of all tasks are merged.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import map_batches, small, stored

CAPACITY = 2_048
BLOCK = 100_000
CARRY = 2_000
FAN = 8
BROADCAST_ROWS = 200_000
SLACK = 16  # a bin with no more free places than this is nearly full


def best_fit(sizes: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing: (bin, offset) of every item, and the bins' fills.

    Open bins are kept by free space; a bit set finds the tightest fit.
    """
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    which, offset, fills = [0] * len(sizes), [0] * len(sizes), []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in order:
        size = sizes[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            b, room = len(fills), capacity
            fills.append(0)
        which[i], offset[i] = b, fills[b]
        fills[b] += size
        left = room - size
        if left:
            stack = by_room.setdefault(left, [])
            if not stack:
                rooms |= 1 << left
            stack.append(b)
    return which, offset, fills


@cache
def byte_bpe(path: str):
    """Encoder with the ids of a byte-level BPE vocabulary file of ``tokenizers``.

    The merge order of such a file is its id order, so the ranks of the faster
    encoder are read from the same file; tests hold its ids against
    ``tokenizers`` itself, called with add_special_tokens=False.  As there, the string of
    an added token in a text is that token, and cuts the text around it.  Texts that
    hold an added token which matches by other rules (whole words, stripped blanks)
    go to ``tokenizers``.
    """
    import public_tokenizers
    import tiktoken

    spec = json.load(open(path, encoding="utf-8"))
    added = spec.get("added_tokens", [])
    special = {t["content"]: t["id"] for t in added}
    cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or "(?!)")
    plainly = not any(t.get(rule) for t in added for rule in ("single_word", "lstrip", "rstrip", "normalized"))
    whole = None
    if not plainly:
        import tokenizers

        whole = tokenizers.Tokenizer.from_file(path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    ordinary = tiktoken.Encoding(
        "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary

    def encode(text: str) -> list[int]:
        if not cut.search(text):
            return ordinary(text)
        if not plainly:
            return whole.encode(text, add_special_tokens=False).ids
        ids, at = [], 0
        for m in cut.finditer(text):
            ids += ordinary(text[at : m.start()])
            ids.append(special[m.group()])
            at = m.end()
        return ids + ordinary(text[at:])

    return encode


def _pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than the capacity."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


# A piece's uid is its partition and its number there; a bin goes by the uid of the piece at its start, so
# bins of all rounds have numbers of their own.
PIECE_BITS = 32
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long, to long, at long, part long, open boolean, fill long"


def placed(uids: list[int], sizes: list[int], capacity: int, slack: int) -> dict[str, pa.Array]:
    """Best-fit: the bin (``to``) and place (``at``) of every piece, its bin's fill and whether that is underfull."""
    which, at, fills = best_fit(sizes, capacity)
    name = {b: uid for b, offset, uid in zip(which, at, uids) if offset == 0}
    return {
        "uid": pa.array(uids, pa.int64()),
        "to": pa.array([name[b] for b in which], pa.int64()),
        "at": pa.array(at, pa.int64()),
        "fill": pa.array([fills[b] for b in which], pa.int64()),
        "open": pa.array([capacity - fills[b] > slack for b in which], pa.bool_()),
    }


def first_uid(part: int) -> int:
    return part << PIECE_BITS


def local_bins(docs: DataFrame, path: str, capacity: int, slack: int) -> DataFrame:
    """Tokenise and pack each partition's documents among themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(path)
        part = TaskContext.get().partitionId()
        next_uid = first_uid(part)
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            nonlocal next_uid
            cols = list(zip(*rows))
            out = placed(list(range(next_uid, next_uid + len(rows))), list(cols[3]), capacity, slack) | {
                "doc_id": pa.array(cols[0], pa.int64()),
                "piece": pa.array(cols[1], pa.int32()),
                "start": pa.array(cols[2], pa.int64()),
                "length": pa.array(cols[3], pa.int64()),
                "ids_crc32": pa.array(cols[4], pa.int64()),
                "part": pa.array([part] * len(rows), pa.int64()),
            }
            next_uid += len(rows)
            rows.clear()
            return pa.RecordBatch.from_pydict({c.split()[0]: out[c.split()[0]] for c in PIECE.split(", ")})

        parts = (batch.slice(i, 200) for batch in batches for i in range(0, batch.num_rows, 200))
        for part_of in parts:
            for doc_id, text in zip(part_of.column("doc_id").to_pylist(), part_of.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), 0], dtype="<u4")
                for k, (start, length) in enumerate(_pieces(len(ids), capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
                if len(rows) >= BLOCK:
                    yield packed()
        if rows:
            yield packed()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(own, run, PIECE)


STATE = "uid long, length long, part long, to long, at long, fill long, open boolean"


def _fit(df: DataFrame) -> DataFrame:
    """Broadcast behind a check of the size; beyond it the join shuffles both sides."""
    return F.broadcast(df) if small(df, BROADCAST_ROWS) else df


def _round(state: DataFrame, level: int, capacity: int, slack: int, bound: int) -> DataFrame:
    """Pack the pieces of each node anew: bin ``to``, place ``at``; nodes of over ``bound`` pieces in several tasks."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        out = placed(pdf["uid"].tolist(), pdf["length"].tolist(), capacity, slack)
        out |= {"length": pdf["length"], "part": pdf["node"]}
        return pd.DataFrame({c.split()[0]: out[c.split()[0]] for c in STATE.split(", ")})

    state = state.withColumn("node", F.floor(F.col("part") / FAN))
    tasks = state.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / F.lit(bound)).alias("tasks"))
    dealt = state.join(_fit(stored(tasks)), "node").withColumn(
        "salt", F.pmod(F.xxhash64("uid", F.lit(level)), F.col("tasks"))
    )
    return stored(dealt.groupBy("node", "salt").applyInPandas(run, STATE))


def _merge_emptiest(bins: DataFrame, capacity: int, bound: int) -> dict[int, tuple[int, int]]:
    """{bin: (bin it goes to, offset)}: the ``bound`` emptiest bins that fit with another, merged until none do.

    Of bins packed best-fit in one task at most one is half empty, so all such bins are among them,
    and there are about as many moves as tasks at the root.
    """
    spark = bins.sparkSession
    moves: dict[int, tuple[int, int]] = {}
    while True:
        least = bins.agg(F.min("fill")).first()[0]
        if least is None:
            break
        rows = bins.where(F.col("fill") + least <= capacity).orderBy("fill", "to").limit(bound).collect()
        which, offset, fills = best_fit([r["fill"] for r in rows], capacity)
        if len(fills) == len(rows):
            break
        # a merged bin takes the number of the part at its start
        name = {which[i]: r["to"] for i, r in enumerate(rows) if offset[i] == 0}
        now = []
        for i, r in enumerate(rows):
            if offset[i]:
                moves[r["to"]] = (name[which[i]], offset[i])
            now.append((r["to"], None if offset[i] else fills[which[i]]))
        changed = spark.createDataFrame(now, "to long, now long").withColumn("seen", F.lit(True))
        bins = stored(
            bins.join(F.broadcast(changed), "to", "left")  # at most ``bound`` rows
            .withColumn("fill", F.when(F.col("seen"), F.col("now")).otherwise(F.col("fill")))
            .where(F.col("fill").isNotNull())
            .select("to", "fill")
        )
    out = {}
    for b in moves:
        to, at = moves[b]
        while to in moves:
            to, at = moves[to][0], at + moves[to][1]
        out[b] = (to, at)
    return out


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    slack: int = SLACK,
    carry: int = CARRY,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    A document is its token ids and a closing id 0 (a null or empty text is that
    id alone).  Returns per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.  Repeated rows are packed each; null doc_ids are kept.
    ``carry`` sets the size of the merging tasks, ``FAN * carry`` pieces.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    bound = FAN * carry
    pieces = stored(local_bins(docs, path, capacity, slack))
    state = pieces.where("open").select("uid", "length", "part")
    finished, last, level = [], None, 0
    top = state.agg(F.max("part")).first()[0]
    while top is not None and last is None:
        merged = _round(state, level, capacity, slack, bound)
        level += 1
        if top < FAN:
            last = merged
            break
        finished.append(merged.where("not open"))
        state = merged.where("open").select("uid", "length", "part")
        top = state.agg(F.max("part")).first()[0]
    places = pieces.limit(0).select("uid", "to", "at")
    if last is not None:
        several = last.count() > bound
        while several:
            left = last.where("open")
            before = left.agg(F.countDistinct("to")).first()[0]
            again = _round(left.select("uid", "length", "part"), level, capacity, slack, bound)
            level += 1
            if again.agg(F.countDistinct("to")).first()[0] >= before:
                break
            finished.append(last.where("not open"))
            last = again
        finished.append(last)
        for part in finished:
            places = places.unionByName(part.select("uid", "to", "at"))
        if several:
            open_bins = last.where("open").groupBy("to").agg(F.first("fill").alias("fill"))
            moves = _merge_emptiest(open_bins, capacity, bound)
            if moves:
                moved = docs.sparkSession.createDataFrame([(b, *m) for b, m in moves.items()], "to long, new long, off long")
                places = places.join(_fit(moved), "to", "left").select(
                    "uid", F.coalesce("new", "to").alias("to"), (F.col("at") + F.coalesce("off", F.lit(0))).alias("at")
                )
    places = places.withColumnsRenamed({"to": "new_to", "at": "new_at"})
    return pieces.join(_fit(places), "uid", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("new_to", "to").alias("sequence_id"),
        F.coalesce("new_at", "at").alias("offset"),
    )
