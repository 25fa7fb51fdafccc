"""Many users under one state key: as many state calls as groups, and the results of each user alone."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F
from test_stream_state import Clock, Handle, all_nudges

from daybook.operators.timers import TimerState, idle_nudges, timer_sessions
from daybook.streaming import idle_nudges_stream, timer_sessions_stream
from daybook.streaming.buckets import CHUNK, Queue
from daybook.streaming.nudges import Nudges
from daybook.streaming.timer import Timer


class Store(Handle):
    """A value for each name; counts the calls on values and the entries of the list."""

    def __init__(self):
        super().__init__()
        self.values, self.calls = {}, 0

    def getValueState(self, name, schema):  # noqa: N802
        outer = self

        class Value:
            def get(self):
                outer.calls += 1
                return outer.values.get(name)

            def update(self, v):
                outer.calls += 1
                outer.values[name] = v

        return Value()


def drive(job, handle, batches, wms):
    """The rows of ``job`` over micro-batches: rows, then the timers that the watermark has passed."""
    out = []
    for frame, wm in zip(batches, wms):
        if len(frame):
            for df in job.handleInputRows((0,), [frame], Clock(wm)):
                out += df.itertuples(index=False, name=None)
        for t in sorted(t for t in handle.timers if t <= wm):
            handle.timers.discard(t)
            for df in job.handleExpiredTimer((0,), Clock(wm), None):
                out += df.itertuples(index=False, name=None)
        assert len(handle.timers) <= 1
    return out


def test_queue_packs_rows_into_few_entries():
    handle = Handle()
    queue, rows = Queue(handle), [(i % 997, i, "x") for i in range(2 * CHUNK + 5)]
    queue.add(rows)
    assert handle.written == 3
    ready = queue.take(500)
    assert ready == sorted(r for r in rows if r[0] <= 500)
    assert ready + queue.take(996) == sorted(rows) and handle.rows == []


def test_nudges_of_a_group_are_those_of_each_user():
    rng = random.Random(3)
    handle, job = Store(), Nudges(50_000, 7_000)
    job.init(handle)
    wms, batches, times = [], [], {u: [] for u in [*range(200), 2**62, -5]}
    for step in range(8):
        wm = step * 90
        new = [(u, (wm + 1 + rng.randrange(400)) * 1000) for u in times for _ in range(rng.randrange(4))]
        for u, t in new:
            times[u].append(t)
        batches.append(pd.DataFrame({"user_id": [u for u, _ in new], "ts": pd.to_datetime([t for _, t in new], unit="us")}))
        wms.append(wm)
    batches.append(pd.DataFrame())
    wms.append(2_000)
    got = [(u, a.value // 1000, f.value // 1000) for u, a, f in drive(job, handle, batches, wms)]
    want = {(u, a, f) for u, ts in times.items() for a, f in all_nudges(ts, 50_000, 7_000, wms[-1] * 1000)}
    assert len(got) == len(set(got)) and set(got) == want
    assert handle.calls <= 4 * len(wms)


def test_timers_of_a_group_are_those_of_each_user():
    rng = random.Random(4)
    handle, job = Store(), Timer()
    job.init(handle)
    minute, seq, wms, batches, events = 60_000_000, 0, [], [], []
    for step in range(10):
        wm, rows = step * 30 * minute, []
        for u in (0, 1, 2, 2**62):
            for _ in range(rng.randrange(12)):
                seq += 1
                action = rng.choice(["start", "start", "pause", "resume", "checkin", "checkin", "stop", None])
                note, cut = rng.choice([None, "ok"]), rng.choice([None, True, False])
                t = wm + 1 + rng.randrange(45 * minute)
                rows.append((u, t, seq, action, rng.choice([f"t{seq}", None]), note, cut, 5 + u % 3, 2))
        events += rows
        cols = ["user_id", "t", "seq", "action", "task_id", "reflection", "interrupted", "work_mins", "break_mins"]
        batches.append(pd.DataFrame(rows, columns=cols))
        wms.append(wm // 1000)
    batches.append(pd.DataFrame())
    wms.append(100 * 30 * minute // 1000)
    got = [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in drive(job, handle, batches, wms)]
    want, states = [], {}
    for u, t, n, action, task, note, cut, work, rest in sorted(events, key=lambda r: r[1:3]):
        s = states.setdefault(u, TimerState(work, rest)).step(t, action, task, note, cut)
        if s is not None:
            want.append((u, n, *s))
    assert len(want) > 5 and sorted(got) == sorted(want)
    assert handle.calls <= 8 * len(wms) and handle.written < seq


def test_streams_of_few_groups_equal_batch(spark, tmp_path):
    rng = random.Random(5)
    actions = ["start", "resume", "checkin", "checkin", "pause", "stop"]
    kind = "user_id long, seq long, ts timestamp, action string, task_id string"
    rows = [(rng.randrange(-3, 40), i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(200_000)),
             rng.choice(actions), f"t{i}") for i in range(1_500)]
    rows.sort(key=lambda r: r[2])
    for i in range(3):
        part = spark.createDataFrame(rows[i * 500 : (i + 1) * 500], kind)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    events = spark.read.schema(kind).parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for name, build, batch in (
        ("few_nudges", idle_nudges_stream(source, groups=1), lambda wm: idle_nudges(events, wm)),
        ("few_timers", timer_sessions_stream(source, groups=2), lambda wm: timer_sessions(events).where(F.col("completed_at") <= wm)),
    ):
        q = build.writeStream.format("memory").queryName(name).outputMode("append")
        q = q.option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        wm = F.lit(q.lastProgress["eventTime"]["watermark"].replace("T", " ").replace("Z", "")).cast("timestamp")
        q.stop()
        got, want = (sorted(map(tuple, d.collect())) for d in (spark.table(name), batch(wm)))
        assert got == want and got
