"""Many drags of one list composed into one change of places.

Only the items that some drag names can change their order; the runs of items between
them stay whole.  So a list is the line of its named items with the runs between
them, and a drag puts one named item next to another.  The line is kept in blocks,
so a drag costs about a block, whatever the length of the list.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 512
# shifts that a task hands on at once, at the least
BATCH_ROWS = 10_000


class _Block:
    __slots__ = ("items", "no")

    def __init__(self, items: list[int], no: int):
        self.items, self.no = items, no


class Line:
    """Items 0..n-1 in an order that single moves change."""

    def __init__(self, n: int):
        self.blocks = [_Block(list(range(i, min(n, i + BLOCK))), i // BLOCK) for i in range(0, n, BLOCK)]
        self.home = [b for b in self.blocks for _ in b.items]

    def _place(self, item: int) -> tuple[int, int]:
        block = self.home[item]
        return block.no, block.items.index(item)

    def move(self, item: int, onto: int) -> None:
        """Put ``item`` where ``onto`` is: behind it if it was before it, else in front."""
        behind = self._place(item) < self._place(onto)
        self.home[item].items.remove(item)
        block = self.home[onto]
        block.items.insert(block.items.index(onto) + behind, item)
        self.home[item] = block
        if len(block.items) > 2 * BLOCK:
            rest = _Block(block.items[BLOCK:], 0)
            del block.items[BLOCK:]
            self.blocks.insert(block.no + 1, rest)
            for i in rest.items:
                self.home[i] = rest
            for no in range(block.no + 1, len(self.blocks)):
                self.blocks[no].no = no

    def __iter__(self) -> Iterator[int]:
        return (i for b in self.blocks for i in b.items)


def compose(ids: list, places: list[int], drags: Iterable[tuple]) -> list[int] | None:
    """Shift of every run and named item (run 0, item 0, run 1, ...) after all drags; None if none had an effect.

    ``ids`` are the named items by ``places`` (0-based).  A drag onto itself or of or onto
    an item not in the list does nothing.
    """
    at = {v: 2 * i + 1 for i, v in enumerate(ids)}
    line, moved = Line(2 * len(ids) + 1), False
    for drag, over in drags:
        if drag != over and drag in at and over in at:
            line.move(at[drag], at[over])
            moved = True
    if not moved:
        return None
    ends = [-1, *places]
    shifts, now = [0] * (2 * len(ids) + 1), 0
    for element in line:
        i, item = divmod(element, 2)
        start, size = (places[i], 1) if item else (ends[i] + 1, places[i] - ends[i] - 1 if i < len(ids) else 0)
        shifts[element] = now - start
        now += size
    return shifts


SHIFTS = "user_id {kind}, __gap long, __marked int, __shift long"


def shifts(marked: DataFrame, moves: DataFrame, order: list[str]) -> DataFrame:
    """Per user with an effective move, the shift of every run (``__gap``, not marked) and named item.

    ``marked``: user_id, id, pos of the named items; ``moves``: user_id, drag_id, over_id and
    the ``order`` columns.  Each user's items and then moves stream through one task,
    which holds the named items only.
    """
    nothing = F.lit(None)
    items = marked.select(
        "user_id", F.lit(0).alias("__move"), "pos", "id", nothing.alias("drag_id"), nothing.alias("over_id"),
        *[nothing.alias(f"__o{i}") for i in range(len(order))],
    )
    drags = moves.select(
        "user_id", F.lit(1).alias("__move"), F.lit(0).cast("long").alias("pos"), nothing.alias("id"), "drag_id", "over_id",
        *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
    )
    both = items.unionByName(drags)
    kind = marked.schema["user_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user_type = None

        def users() -> Iterator[tuple]:
            nonlocal user_type
            user, ids, places, drags = None, [], [], []
            for batch in batches:
                user_type = batch.schema.field("user_id").type
                cols = [batch.column(c).to_pylist() for c in ("user_id", "__move", "pos", "id", "drag_id", "over_id")]
                for who, is_move, pos, own_id, drag, over in zip(*cols):
                    if who != user:
                        if drags:
                            yield user, ids, places, drags
                        user, ids, places, drags = who, [], [], []
                    if is_move:
                        drags.append((drag, over))
                    else:
                        ids.append(own_id)
                        places.append(pos)
            if drags:
                yield user, ids, places, drags

        def done() -> pa.RecordBatch:
            kinds = (user_type, pa.int64(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=["user_id", "__gap", "__marked", "__shift"])

        rows: tuple[list, ...] = ([], [], [], [])
        for user, ids, places, drags in users():
            found = compose(ids, places, drags)
            if found is not None:
                n = range(len(found))
                rows[0].extend([user] * len(found))
                # a named item counts in its own running total, a run in that of the item before it
                rows[1].extend((i + 1) // 2 for i in n)
                rows[2].extend(i % 2 for i in n)
                rows[3].extend(found)
            if len(rows[0]) >= BATCH_ROWS:
                yield done()
                rows = ([], [], [], [])
        if rows[0]:
            yield done()

    # by a hash of the user: dealt anew even if both parts are dealt by user already, as their partitions may be merged differently
    dealt = both.repartition(F.xxhash64("user_id")).sortWithinPartitions("user_id", "__move", "pos", *[f"__o{i}" for i in range(len(order))])
    return dealt.select("user_id", "__move", "pos", "id", "drag_id", "over_id").mapInArrow(run, SHIFTS.format(kind=kind))
