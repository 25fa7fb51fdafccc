"""Users in groups, rows of one key that wait for the watermark, and the one timer that wakes the key."""

from __future__ import annotations

import pickle

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GROUPS = 512  # groups of users; fixed for the life of a stream's checkpoint
CHUNK = 10_000  # rows of one list entry at most


def use_list_state(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def group_of(user: str, groups: int) -> Column:
    """The group that holds a user's state.

    A key costs its state calls and frames in every micro-batch, whatever it holds, so the
    stream jobs keep a group of users under one key.
    """
    return F.pmod(F.xxhash64(user), F.lit(groups)).cast("int")


class Queue:
    """Rows in a list state that new rows are only appended to, many to an entry.

    Rows are handed out in order as the watermark passes them.  The list is written anew
    only when at least half of its rows are handed out, so writes stay in
    proportion to the rows that arrive.  The caller keeps ``self.at`` (upto, first, size, out): rows up to
    ``upto`` are handed out, ``first`` is the first time that waits, and ``size`` rows are in the
    list, ``out`` of them handed out.
    """

    START = (-(1 << 62), None, 0, 0)
    ENTRY = "low long, high long, n long, rows binary"  # the first and last time of the rows, and the rows

    def __init__(self, handle, schema: str = ENTRY, name: str = "pending"):
        self.state = handle.getListState(name, schema)
        self.at = self.START

    @staticmethod
    def _entries(rows: list[tuple]) -> list[tuple]:
        parts = (rows[i : i + CHUNK] for i in range(0, len(rows), CHUNK))
        return [(min(r[0] for r in p), max(r[0] for r in p), len(p), pickle.dumps(p, 5)) for p in parts]

    def add(self, rows: list[tuple]) -> None:
        """Rows start with their time and a number that orders equal times."""
        if not rows:
            return
        entries = self._entries(rows)
        self.state.appendList(entries)
        upto, first, size, out = self.at
        low = min(e[0] for e in entries)
        self.at = upto, low if first is None else min(first, low), size + len(rows), out

    def take(self, now: int) -> list[tuple]:
        """The rows up to ``now`` that were not handed out yet, in order."""
        upto, first, size, out = self.at
        if first is None or first > now:
            return []
        ready, rest, later = [], [], []
        for entry in self.state.get():
            if entry[0] > now:
                later.append(tuple(entry))
            elif entry[1] > upto:
                for r in pickle.loads(entry[3]):
                    if r[0] > now:
                        rest.append(r)
                    elif r[0] > upto:
                        ready.append(r)
        ready.sort(key=lambda r: r[:2])
        out += len(ready)
        if not rest and not later:
            self.state.clear()
            size = out = 0
        elif 2 * out >= size:
            self.state.put(self._entries(rest) + later)
            size, out = len(rest) + sum(e[2] for e in later), 0
        self.at = now, min([*(r[0] for r in rest), *(e[0] for e in later)], default=None), size, out
        return ready


def set_timer(handle, old_ms: int | None, at_ms: int | None, fired: bool) -> int | None:
    """At most one timer of the key: move it from ``old_ms`` to ``at_ms``; ``fired``: the old one is gone already."""
    if old_ms is not None and not fired and old_ms != at_ms:
        handle.deleteTimer(old_ms)
    if at_ms is not None and (fired or old_ms != at_ms):
        handle.registerTimer(at_ms)
    return at_ms
