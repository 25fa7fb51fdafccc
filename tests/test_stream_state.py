"""The state of the stream jobs on plain stand-ins: order, writes and runs."""

import random

from daybook.streaming.buckets import Queue
from daybook.streaming.nudges import Nudges


class Handle:
    """A list, a value and timers as the state store keeps them; counts rows written."""

    def __init__(self):
        self.rows, self.value, self.written, self.timers = [], None, 0, set()

    def getListState(self, name, schema):  # noqa: N802
        return self

    def getValueState(self, name, schema):  # noqa: N802
        outer = self

        class Value:
            def get(self):
                return outer.value

            def update(self, v):
                outer.value = v

        return Value()

    def appendList(self, rows):  # noqa: N802
        self.rows += rows
        self.written += len(rows)

    def put(self, rows):
        self.rows = list(rows)
        self.written += len(rows)

    def get(self):
        return iter(self.rows)

    def clear(self):
        self.rows = []

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)


def test_queue_hands_out_in_order_and_writes_in_proportion():
    rng = random.Random(1)
    handle = Handle()
    queue, now, sent, got = Queue(handle, ""), 0, [], []
    for step in range(2_000):
        new = [(now + 1 + rng.randrange(600), step * 10 + i) for i in range(rng.randrange(4))]
        sent += new
        queue.add(new)
        now += rng.randrange(5)
        ready = queue.take(now)
        assert all(r[0] <= now for r in ready)
        got += ready
    got += queue.take(10**9)
    assert got == sorted(sent) and handle.rows == []
    assert handle.written <= 2.1 * len(sent)


class Clock:
    def __init__(self, wm):
        self.wm = wm

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.wm


def all_nudges(times, threshold, grid, upto):
    out, times = set(), sorted(set(times))
    for i, a in enumerate(times):
        f = -(-(a + threshold) // grid) * grid
        until = min(times[i + 1], upto) if i + 1 < len(times) else upto
        while f <= until:
            out.add((a, f))
            f += threshold
    return out


def test_runs_give_the_nudges_of_all_activity():
    rng = random.Random(2)
    for trial in range(150):
        threshold, grid = rng.choice([(50, 7), (50, 10), (20, 20), (45, 5)])
        handle = Handle()
        job = Nudges(threshold * 1000, grid * 1000)
        job.init(handle)
        wm, times, got = 0, [], set()
        for _ in range(25):
            import pandas as pd

            new = [(wm + 1 + rng.randrange(rng.choice([30, 400]))) * 1000 for _ in range(rng.randrange(4))]
            times += new
            frames = [pd.DataFrame({"ts": pd.to_datetime(pd.Series(new, dtype="int64"), unit="us")})] if new else []
            parts = list(job.handleInputRows((1,), frames, Clock(wm))) if new else []
            wm += rng.randrange(60)
            due = sorted(t for t in handle.timers if t <= wm)
            for t in due:
                handle.timers.discard(t)
                parts += job.handleExpiredTimer((1,), Clock(wm), None)
            for df in parts:
                for _, a, f in df.itertuples(index=False):
                    pair = (a.value // 1000, f.value // 1000)
                    assert pair not in got
                    got.add(pair)
            assert len(handle.timers) <= 1
        assert got == all_nudges(times, threshold * 1000, grid * 1000, wm * 1000), (trial, threshold, grid)
