"""The timer fold against a tick-by-tick simulation of the app's one-second interval."""

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from daybook.operators.timers import TimerState, timer_sessions, timer_status
from daybook.operators.transitions import IDLE, Stretch, follow

S = 1_000_000


class TickSim:
    """Second-by-second model: a counter decremented by an interval started at (re)start."""

    def __init__(self, work_m, break_m):
        self.work_m, self.break_m = work_m, break_m
        self.phase, self.seconds, self.task = "idle", work_m * 60, None
        self.iv = None  # (start, kind, ticks done)
        self.show = False
        self.sessions = []

    def run_until(self, t):
        while self.iv is not None:
            start, kind, done = self.iv
            nxt = start + (done + 1) * S
            if nxt > t:
                return
            self.iv = (start, kind, done + 1)
            if self.seconds <= 1:
                self.iv = None
                if kind == "work":
                    self.show, self.seconds = True, 0
                else:
                    self.phase, self.seconds = "idle", self.work_m * 60
            else:
                self.seconds -= 1

    def event(self, t, action, task, refl, intr):
        self.run_until(t)
        if action == "start" and self.phase == "idle" and task:
            self.phase, self.seconds, self.task, self.iv = "work", self.work_m * 60, task, (t, "work", 0)
        elif action == "pause" and self.phase == "work" and self.iv is not None:
            self.iv, self.phase = None, "paused"
        elif action == "resume" and self.phase == "paused":
            self.phase, self.iv = "work", (t, "work", 0)
        elif action == "stop" and self.phase != "idle":
            self.iv, self.phase, self.seconds, self.show = None, "idle", self.work_m * 60, False
        elif action == "checkin" and self.show:
            self.show = False
            self.sessions.append((t, self.task, self.work_m, refl or "", bool(intr)))
            self.phase, self.seconds, self.iv = "break", self.break_m * 60, (t, "break", 0)


def random_events(rng, n):
    t = 1_700_000_000 * S
    out = []
    for i in range(n):
        t += rng.choice([rng.randint(0, 3 * S), rng.randint(0, 90 * S), rng.randint(0, 40 * 60 * S)])
        action = rng.choice(["start", "start", "pause", "resume", "stop", "checkin", "checkin"])
        out.append((t, i, action, rng.choice(["t1", "t2", None]), rng.choice([None, "", "note"]),
                    rng.choice([None, True, False])))
    return out


def test_state_machine_matches_tick_simulation():
    rng = random.Random(7)
    for trial in range(300):
        wm, bm = rng.choice([(25, 5), (1, 1), (2, 3), (120, 60)])
        evs = random_events(rng, rng.randint(1, 60))
        st, sim = TimerState(wm, bm), TickSim(wm, bm)
        got = []
        for t, seq, action, task, refl, intr in evs:
            s = st.step(t, action, task, refl, intr)
            if s is not None:
                got.append((t, *s))
            sim.event(t, action, task, refl, intr)
        assert got == sim.sessions, trial
        probe = evs[-1][0] + rng.randint(0, 200 * 60 * S)
        sim.run_until(probe)
        phase, rem, awaiting = st.status(probe)
        assert (phase, rem) == (sim.phase, sim.seconds), trial


def test_spark_fold_matches_local_fold(spark):
    rng = random.Random(3)
    rows = []
    expected = []
    for user in range(40):
        evs = random_events(rng, rng.randint(1, 80))
        st = TimerState(2, 1)
        for t, seq, action, task, refl, intr in evs:
            rows.append((user, seq, pd.Timestamp(t, unit="us").to_pydatetime(), action, task, refl, intr))
            s = st.step(t, action, task, refl, intr)
            if s is not None:
                expected.append((user, seq, s[0], s[2], s[3]))
    events = spark.createDataFrame(
        rows, "user_id long, seq long, ts timestamp, action string, task_id string, reflection string, interrupted boolean"
    )
    settings = spark.createDataFrame([(u, 2, 1) for u in range(40)], "user_id long, work_mins int, break_mins int")
    got = sorted(
        (r.user_id, r.seq, r.task_id, r.reflection, r.interrupted)
        for r in timer_sessions(events, settings, num_partitions=5).collect()
    )
    assert got == sorted(expected)
    st = timer_status(events, "2030-01-01 00:00:00", settings)
    assert st.count() == 40
    assert st.where(F.col("display").isNull()).count() == 0


def _state_of(st):
    if st.phase == "work":
        if st.run_start is None:
            return ("awaiting", 0, st.task)
        return ("running", st.run_start + st.rem * S, st.task)
    return {"idle": IDLE, "paused": ("paused", st.rem, st.task), "break": ("break", st.break_end, st.task)}[st.phase]


def test_transition_functions_equal_stepping():
    rng = random.Random(13)
    for trial in range(600):
        wm, bm = rng.choice([(25, 5), (1, 1), (2, 3), (60, 30)])
        evs = random_events(rng, rng.randint(2, 60))
        if trial % 2:
            evs = [e for e in evs if e[2] != "stop"] or evs
        if len(evs) < 2:
            continue
        cut = rng.randrange(1, len(evs))
        before, rest = evs[:cut], evs[cut:]
        st = TimerState(wm, bm)
        for t, _, action, task, _, _ in before:
            st.step(t, action, task, None, None)
        entry = _state_of(st)
        summary = json.loads(json.dumps(Stretch([(t, a, task) for t, _, a, task, _, _ in rest], wm * 60, bm * 60).summary()))
        for t, _, action, task, _, _ in rest:
            st.step(t, action, task, None, None)
        want, got = _state_of(st), follow(summary, tuple(entry))
        # time that passes after the last event changes nothing yet
        if want[0] == "idle":
            assert got[0] == "idle", trial
        else:
            assert tuple(got) == want, (trial, entry)


@pytest.mark.parametrize("stops", [True, False])
def test_hot_user_is_split_and_matches_sequential_fold(spark, stops):
    from daybook.operators import timers

    rng = random.Random(11)
    evs = [e for e in random_events(rng, 4000) if stops or e[2] != "stop"]
    st = TimerState(3, 2)
    expected = []
    for t, seq, action, task, refl, intr in evs:
        s = st.step(t, action, task, refl, intr)
        if s is not None:
            expected.append((seq, s[0], s[2], s[3]))
    as_of = evs[-1][0] + 90 * S
    phase, rem, _ = st.status(as_of)
    rows = [(1, seq, pd.Timestamp(t, unit="us").to_pydatetime(), a, task, refl, intr)
            for t, seq, a, task, refl, intr in evs]
    few = [(2, 0, rows[0][2], "start", "t9", None, None), (2, 1, rows[-1][2], "checkin", None, "done", None)]
    events = spark.createDataFrame(
        rows + few, "user_id long, seq long, ts timestamp, action string, task_id string, reflection string, interrupted boolean"
    )
    settings = spark.createDataFrame([(1, 3, 2)], "user_id long, work_mins int, break_mins int")
    cut, _ = timers._segments(timers._timer_input(events.where("user_id = 1"), settings), 8, 100)
    cut = cut.withColumn("entry", F.lit(None).cast("string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    spread = timers._sorted(cut, 8).select(F.spark_partition_id().alias("p")).distinct().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread > 1 and cut.groupBy("seg").count().where("count > 100").count() == 0  # one user, many tasks
    got = timer_sessions(events, settings, num_partitions=8, segment=100).collect()
    assert sorted((r.seq, r.task_id, r.reflection, r.interrupted) for r in got if r.user_id == 1) == sorted(expected)
    assert [(r.seq, r.task_id, r.reflection) for r in got if r.user_id == 2] == [(1, "t9", "done")]
    for segment in (100, timers.SEGMENT):
        status = timer_status(events.where("user_id = 1"), str(pd.Timestamp(as_of, unit="us")), settings, segment=segment)
        assert [(r.phase, r.remaining_s, r.task_id) for r in status.collect()] == [(phase, rem, st.task if phase != "idle" else None)]


def test_notices_at_checkin_and_end_of_break(spark):
    from daybook.operators.timers import timer_notices

    at = lambda m: pd.Timestamp("2024-01-01 23:00:00").to_pydatetime() + pd.Timedelta(minutes=m)
    plan = [(0, "start"), (2, "checkin"), (3, "start"), (5, "checkin"), (5.5, "stop"), (6, "start"), (8, "checkin"), (9, "stop"),
            (70, "start"), (72, "checkin")]
    rows = [(1, i, at(m), a, "t", None, None) for i, (m, a) in enumerate(plan)]
    events = spark.createDataFrame(
        rows, "user_id long, seq long, ts timestamp, action string, task_id string, reflection string, interrupted boolean"
    )
    settings = spark.createDataFrame([(1, 2, 1)], "user_id long, work_mins int, break_mins int")
    got = sorted((r.ts, r.title, r.body) for r in timer_notices(events, settings).collect())
    log = lambda m, n: (at(m), "Pomodoro logged!", f"{n} today. Take a 1-min break.")
    over = lambda m: (at(m), "Break over!", "Ready for your next pomodoro?")
    # the second break is stopped; a stop at the very end of one comes too late; the last session is on the next day
    assert got == sorted([log(2, 1), over(3), log(5, 2), log(8, 3), over(9), log(72, 1), over(73)])
