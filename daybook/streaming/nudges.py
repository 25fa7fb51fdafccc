"""Idle nudges on a stream of activity, with event-time timers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from daybook import constants as K
from daybook.streaming.buckets import GROUPS, group_of, set_timer, use_list_state

OUTPUT = StructType(
    [
        StructField("user_id", LongType(), False),
        StructField("idle_since", TimestampType(), False),
        StructField("fire_ts", TimestampType(), False),
    ]
)
STATE = "wake_ms long, users binary, last binary, fired binary, run_users binary, starts binary, ends binary"
NONE = np.iinfo(np.int64).min  # no activity reached, no nudge sent
ROWS = 100_000  # nudges of one output frame


class Nudges(StatefulProcessor):
    """Nudges of a group of users, whose activity is kept as runs.

    A run is a stretch of activity without a gap of the threshold; no nudge falls inside
    one.  The state is one value of arrays (64-bit integers): for each user the end of the run reached by the
    watermark and the last nudge sent since, and the runs that wait, of which a user has at most a few
    for the time that the watermark lags, however many activities they hold.  Rows without a
    ``user_id`` are of the user who is the key.
    """

    def __init__(self, threshold_us: int, grid_us: int):
        self.threshold_us, self.grid_us = threshold_us, grid_us

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802
        users, times = [], []
        for pdf in rows:
            times.append(pdf["ts"].astype("datetime64[us]").astype("int64").to_numpy())
            own = "user_id" in pdf
            users.append(pdf["user_id"].astype("int64").to_numpy() if own else np.full(len(pdf), int(key[0])))
        yield from self._advance(users, times, timerValues.getCurrentWatermarkInMs() * 1000, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802
        yield from self._advance([], [], timerValues.getCurrentWatermarkInMs() * 1000, True)

    def close(self) -> None:
        pass

    def _next(self, last: np.ndarray, fired: np.ndarray) -> np.ndarray:
        """The next nudge after activity at ``last``, of which ``fired`` was the last nudge."""
        first = -(-(last + self.threshold_us) // self.grid_us) * self.grid_us
        return np.where(fired == NONE, first, fired + self.threshold_us)

    def runs(self, users: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs and activities of users, as the runs they make together, by user and start."""
        order = np.lexsort((ends, starts, users))
        users, starts, ends = users[order], starts[order], ends[order]
        if not len(users):
            return users, starts, ends
        # the latest end so far of each user, by the ends' ranks, which are above those of the users before
        sizes = np.sort(ends)
        rank = np.searchsorted(sizes, ends)
        place = np.cumsum(np.concatenate([[0], users[1:] != users[:-1]])) * len(users)
        ends = sizes[np.maximum.accumulate(place + rank) - place]
        new = np.concatenate([[True], (users[1:] != users[:-1]) | (starts[1:] >= ends[:-1] + self.threshold_us)])
        at = np.flatnonzero(new)
        return users[at], starts[at], ends[np.append(at[1:], len(users)) - 1]

    def _advance(self, new_users: list, new_times: list, wm: int, fired_timer: bool):
        wake, *arrays = self.state.get() or (None, *[b""] * 6)
        known, last, fired, *waits = (np.frombuffer(a, dtype="<i8") for a in arrays)
        who, a, b = self.runs(*(np.concatenate([w, *n]) for w, n in zip(waits, (new_users, new_times, new_times))))
        users = np.union1d(known, who)
        at = np.searchsorted(users, known)
        old_last, old_fired, (last, fired) = last, fired, np.full((2, len(users)), NONE)
        last[at], fired[at] = old_last, old_fired
        at = np.searchsorted(users, who)
        untold = (last[at] == NONE) | (b > last[at])
        at, a, b = at[untold], a[untold], b[untold]
        # runs lie a threshold apart, so only a user's first can go on with the run reached
        on = (last[at] != NONE) & (fired[at] == NONE) & (a < last[at] + self.threshold_us)
        last[at[on]] = b[on]
        at, a, b = at[~on], a[~on], b[~on]
        reached = a <= wm
        wait_at, wait_a, wait_b = at[~reached], a[~reached], b[~reached]
        at, a, b = at[reached], a[reached], b[reached]
        # what each user idled after: the run reached before and those reached now; up to the next one, or the watermark
        had = np.flatnonzero(last != NONE)
        idle = np.concatenate([had, at])
        order = np.argsort(idle, kind="stable")
        idle, since = idle[order], np.concatenate([last[had], b])[order]
        sent = np.concatenate([fired[had], np.full(len(at), NONE)])[order]
        begun = np.concatenate([np.full(len(had), NONE), a])[order]
        final = np.append(idle[1:] != idle[:-1], True)[: len(idle)]
        upto = np.where(final, wm, np.append(begun[1:], wm)[: len(idle)])
        due = self._next(since, sent)
        count = np.maximum((upto - due) // self.threshold_us + 1, 0)
        sent = np.where(count > 0, due + (count - 1) * self.threshold_us, sent)
        last[idle[final]], fired[idle[final]] = since[final], sent[final]
        upcoming = np.concatenate([wait_a, self._next(since[final], sent[final])])
        when = max(int(upcoming.min()) // 1000, wm // 1000 + 1) if len(upcoming) else None
        wake = set_timer(self.handle, wake, when, fired_timer)
        state = (users, last, fired, users[wait_at], wait_a, wait_b)
        self.state.update((wake, *(x.astype("<i8").tobytes() for x in state)))
        yield from self._frames(users[idle], since, due, count)

    def _frames(self, users, since, due, count):
        """``count`` nudges from ``due`` on after each activity."""
        below = np.cumsum(count)
        before = below - count
        for low in range(0, int(below[-1]) if len(below) else 0, ROWS):
            number = np.arange(low, min(low + ROWS, int(below[-1])))
            i = np.searchsorted(below, number, side="right")
            fire = due[i] + (number - before[i]) * self.threshold_us
            yield pd.DataFrame(
                {"user_id": users[i], "idle_since": pd.to_datetime(since[i], unit="us"), "fire_ts": pd.to_datetime(fire, unit="us")}
            )


def idle_nudges_stream(
    activity: DataFrame,
    threshold_min: int = K.IDLE_THRESHOLD_MINUTES,
    grid_min: int = K.IDLE_CHECK_MINUTES,
    delay: str = "10 minutes",
    groups: int = GROUPS,
) -> DataFrame:
    """Every nudge of T1 at or below the watermark, emitted once.

    State: one value for each of ``groups`` groups of users (:class:`Nudges`).  An event-time timer
    wakes a group at the next possible nudge of its users, so trailing idle time produces
    nudges without new activity.
    """
    use_list_state(activity.sparkSession)
    return (
        activity.select(group_of("user_id", groups).alias("users"), "user_id", "ts")
        .withWatermark("ts", delay)
        .groupBy("users")
        .transformWithStateInPandas(
            Nudges(threshold_min * 60_000_000, grid_min * 60_000_000), OUTPUT, "append", "eventTime"
        )
        .select("user_id", "idle_since", "fire_ts")
    )
