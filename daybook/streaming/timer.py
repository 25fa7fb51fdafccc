"""T4 on a stream: the focus timer fold with state between micro-batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from daybook import constants as K
from daybook.operators.timers import SESSION_SCHEMA, TimerState
from daybook.streaming.buckets import GROUPS, Queue, group_of, set_timer, use_list_state

_FIELDS = TimerState.__slots__
_EVENT = ("t", "seq", "user_id", "action", "task_id", "reflection", "interrupted", "work_mins", "break_mins")
_NUMBERS = ("t", "seq", "user_id", "work_mins", "break_mins")

QUEUE = "wake_ms long, upto long, first long, size long, out long"
TIMERS = (
    "users array<long>, work_s array<long>, break_s array<long>, phase array<string>, task array<string>, "
    "rem array<long>, run_start array<long>, break_end array<long>"
)


def _restored(fields: tuple) -> TimerState:
    st = TimerState(0, 0)
    for f, v in zip(_FIELDS, fields):
        setattr(st, f, v)
    return st


def _column(pdf: pd.DataFrame, name: str) -> list:
    col = pdf[name]
    if name in _NUMBERS:
        return col.astype("int64").tolist()
    known = col.notna()
    if name == "interrupted":
        return [bool(v) if k else None for v, k in zip(col.tolist(), known.tolist())]
    return col.astype(object).where(known, None).tolist()


class Timer(StatefulProcessor):
    """The timers of a group of users and the events that wait for the watermark.

    Waiting events are only appended.  The timers are one value with an entry a user, read and
    written only when the watermark has passed events of the group.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.queue = handle.getValueState("queue", QUEUE)
        self.timers = handle.getValueState("timers", TIMERS)
        self.pending = Queue(handle)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802
        yield from self._advance(rows, timerValues.getCurrentWatermarkInMs() * 1000, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802
        yield from self._advance([], timerValues.getCurrentWatermarkInMs() * 1000, True)

    def close(self) -> None:
        pass

    def _fold(self, ready: list[tuple]) -> list[tuple]:
        """Sessions of the events, in order; the users' timers go on from where they stood."""
        users, *columns = self.timers.get() or [[] for _ in range(1 + len(_FIELDS))]
        stored = dict(zip(users, zip(*columns)))
        moved: dict[int, TimerState] = {}
        out = []
        for t, seq, uid, action, task_id, refl, intr, wmins, bmins in ready:
            timer = moved.get(uid)
            if timer is None:
                timer = moved[uid] = _restored(stored[uid]) if uid in stored else TimerState(wmins, bmins)
            s = timer.step(t, action, task_id, refl, intr)
            if s is not None:
                ts = pd.Timestamp(t, unit="us")
                out.append((uid, seq, s[0], s[1], s[2], s[3], ts.date(), ts))
        for uid, timer in moved.items():
            stored[uid] = tuple(getattr(timer, f) for f in _FIELDS)
        self.timers.update((list(stored), *map(list, zip(*stored.values()))))
        return out

    def _advance(self, frames, wm: int, fired_timer: bool):
        wake, *at = self.queue.get() or (None, *Queue.START)
        self.pending.at = tuple(at)
        for pdf in frames:
            self.pending.add([*zip(*(_column(pdf, c) for c in _EVENT))])
        ready = self.pending.take(wm)
        out = self._fold(ready) if ready else []
        first = self.pending.at[1]
        wake = set_timer(self.handle, wake, None if first is None else max(first // 1000, wm // 1000 + 1), fired_timer)
        self.queue.update((wake, *self.pending.at))
        if out:
            yield pd.DataFrame.from_records(out, columns=SESSION_SCHEMA.names)


def timer_sessions_stream(
    events: DataFrame, settings: DataFrame | None = None, delay: str = "10 minutes", groups: int = GROUPS
) -> DataFrame:
    """T4 on a stream: sessions at check-in, in event-time order per user.

    ``settings`` is a static table (user_id, work_mins, break_mins), joined to
    the stream; missing values default to 25 / 5.  ``groups``: keys of the state (:func:`group_of`);
    the due events of a group are sorted in one task.
    """
    ev = events.withWatermark("ts", delay)
    if settings is not None:
        ev = ev.join(settings.select("user_id", "work_mins", "break_mins"), "user_id", "left")
    else:
        ev = ev.withColumn("work_mins", F.lit(None).cast("int")).withColumn("break_mins", F.lit(None).cast("int"))
    for c, t in (("reflection", "string"), ("interrupted", "boolean")):
        if c not in ev.columns:
            ev = ev.withColumn(c, F.lit(None).cast(t))
    rows = ev.select(
        group_of("user_id", groups).alias("users"),
        "user_id",
        "ts",
        F.unix_micros("ts").alias("t"),
        "seq",
        "action",
        "task_id",
        "reflection",
        "interrupted",
        F.coalesce(F.nullif(F.col("work_mins"), F.lit(0)), F.lit(K.DEFAULT_WORK_MINS)).alias("work_mins"),
        F.coalesce(F.nullif(F.col("break_mins"), F.lit(0)), F.lit(K.DEFAULT_BREAK_MINS)).alias("break_mins"),
    )
    use_list_state(events.sparkSession)
    return rows.groupBy("users").transformWithStateInPandas(Timer(), SESSION_SCHEMA, "append", "eventTime")
