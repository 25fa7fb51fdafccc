"""Time rules as batch jobs: idle nudges, end-of-day reminders, the focus timer.

The app runs these on wall-clock intervals; here they are computed from event
tables, with the clock (``until``, ``as_of``) as a parameter.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from daybook import constants as K
from daybook.functions import mmss
from daybook.operators.sequence import ordered_scan
from daybook.operators.transitions import IDLE, Stretch, follow
from daybook.session import ensure_checkpoint_dir

_MICROS = 1_000_000


# ------------------------------------------------------------------ T1


def first_nudge(ts: Column, threshold_min: int, grid_min: int) -> Column:
    """First check tick on the epoch-anchored grid at least ``threshold`` after ``ts``."""
    g = grid_min * 60 * _MICROS
    th = threshold_min * 60 * _MICROS
    return F.timestamp_micros(((F.unix_micros(ts) + F.lit(th + g - 1)).cast("long") / g).cast("long") * g)


def idle_nudges(
    activity: DataFrame,
    until: Column,
    threshold_min: int = K.IDLE_THRESHOLD_MINUTES,
    grid_min: int = K.IDLE_CHECK_MINUTES,
) -> DataFrame:
    """Nudges fired while idle.

    A check runs every ``grid_min`` minutes; if at least ``threshold_min``
    minutes passed since the last activity it fires and counts as activity
    itself, so it repeats every ``threshold_min`` minutes.  A check at the
    same instant as an activity fires first.  ``threshold_min`` must be a
    multiple of ``grid_min``.  Output: user_id, idle_since, fire_ts (<= until).
    """
    if threshold_min % grid_min:
        raise ValueError("threshold must be a multiple of the check grid")
    seq = ordered_scan(activity.select("user_id", "ts"), "user_id", ["ts"], lead={"next_ts": "ts"})
    first = first_nudge(F.col("ts"), threshold_min, grid_min)
    stop = F.least(F.coalesce(F.col("next_ts"), until), until)
    step = F.expr(f"INTERVAL {threshold_min} MINUTES")
    return (
        seq.select("user_id", F.col("ts").alias("idle_since"), first.alias("__first"), stop.alias("__stop"))
        .where(F.col("__first") <= F.col("__stop"))
        .select("user_id", "idle_since", F.explode(F.sequence("__first", "__stop", step)).alias("fire_ts"))
    )


# ------------------------------------------------------------------ T3


def eod_hits(ticks: DataFrame, tz: str, hour: int = K.EOD_HOUR, minutes: int = 1) -> DataFrame:
    """Ticks inside the reminder window: local ``hour`` and minute < ``minutes``."""
    local = F.from_utc_timestamp(F.col("ts"), tz)
    return ticks.where((F.hour(local) == hour) & (F.minute(local) < minutes)).select(
        "user_id", "ts", F.to_date("ts").alias("day")
    )


def eod_reminders(ticks: DataFrame, tz: str, hour: int = K.EOD_HOUR, minutes: int = 1) -> DataFrame:
    """End-of-day reminder, at most once per UTC day per user (first hit)."""
    return (
        eod_hits(ticks, tz, hour, minutes)
        .groupBy("user_id", "day")
        .agg(F.min("ts").alias("fire_ts"))
    )


# ------------------------------------------------------------------ T4, T5

SESSION_SCHEMA = StructType(
    [
        StructField("user_id", LongType(), False),
        StructField("seq", LongType(), False),
        StructField("task_id", StringType(), True),
        StructField("duration_minutes", IntegerType(), False),
        StructField("reflection", StringType(), False),
        StructField("interrupted", BooleanType(), False),
        StructField("date", DateType(), False),
        StructField("completed_at", TimestampType(), False),
    ]
)

STATUS_SCHEMA = StructType(
    [
        StructField("user_id", LongType(), False),
        StructField("phase", StringType(), False),
        StructField("remaining_s", LongType(), False),
        StructField("task_id", StringType(), True),
        StructField("awaiting_checkin", BooleanType(), False),
    ]
)


class TimerState:
    """The focus timer of one user, advanced by events in time order.

    Phases: idle, work (running, or at zero awaiting the check-in), paused,
    break.  The clock counts whole seconds from each (re)start, so the part
    of a second before a pause is lost.
    """

    __slots__ = ("work_s", "break_s", "phase", "task", "rem", "run_start", "break_end")

    def __init__(self, work_mins: int, break_mins: int):
        self.work_s = int(work_mins) * 60
        self.break_s = int(break_mins) * 60
        self.phase = "idle"
        self.task = None
        self.rem = 0  # seconds left at run_start (work) or while paused
        self.run_start = None  # micros of the current run segment
        self.break_end = None

    def _remaining(self, t: int) -> int:
        return max(self.rem - (t - self.run_start) // _MICROS, 0)

    def advance(self, t: int) -> None:
        """Let time pass up to ``t`` (ticks at ``t`` happen before events at ``t``)."""
        if self.phase == "work" and self.run_start is not None and self._remaining(t) == 0:
            self.rem, self.run_start = 0, None  # at zero: the check-in is awaited
        elif self.phase == "break" and t >= self.break_end:
            self.phase, self.break_end = "idle", None

    def step(self, t: int, action: str, task_id, reflection, interrupted):
        """Apply one event at micros ``t``; returns a session tuple on check-in."""
        self.advance(t)
        awaiting = self.phase == "work" and self.run_start is None
        if action == "start":
            if self.phase == "idle" and task_id:
                self.phase, self.task, self.rem, self.run_start = "work", task_id, self.work_s, t
        elif action == "pause":
            if self.phase == "work" and not awaiting:
                self.rem, self.run_start, self.phase = self._remaining(t), None, "paused"
        elif action == "resume":
            if self.phase == "paused":
                self.phase, self.run_start = "work", t
        elif action == "stop":
            if self.phase != "idle":
                self.phase, self.run_start, self.break_end, self.rem = "idle", None, None, 0
        elif action == "checkin":
            if awaiting:
                self.phase, self.break_end = "break", t + self.break_s * _MICROS
                return (self.task, self.work_s // 60, reflection or "", bool(interrupted) if interrupted else False)
        return None

    def status(self, t: int) -> tuple[str, int, bool]:
        """(phase, seconds shown, awaiting check-in) at micros ``t``."""
        self.advance(t)
        if self.phase == "work":
            if self.run_start is None:
                return "work", 0, True
            return "work", self._remaining(t), False
        if self.phase == "paused":
            return "paused", self.rem, False
        if self.phase == "break":
            return "break", max(self.break_s - (t - (self.break_end - self.break_s * _MICROS)) // _MICROS, 0), False
        return "idle", self.work_s, False


SEGMENT = 20_000  # events of one user that one task folds at most


def _timer_input(events: DataFrame, settings: DataFrame | None) -> DataFrame:
    """Events with their times in microseconds and the user's ``settings`` (one row per user)."""
    ev = events.select(
        "user_id",
        F.unix_micros("ts").alias("t"),
        "seq",
        "action",
        "task_id",
        (F.col("reflection") if "reflection" in events.columns else F.lit(None).cast("string")).alias("reflection"),
        (F.col("interrupted") if "interrupted" in events.columns else F.lit(None).cast("boolean")).alias("interrupted"),
    )
    if settings is not None:
        ev = ev.join(settings.select("user_id", "work_mins", "break_mins"), "user_id", "left")
    else:
        ev = ev.withColumn("work_mins", F.lit(None)).withColumn("break_mins", F.lit(None))
    return ev.select(
        "user_id", "t", "seq", "action", "task_id", "reflection", "interrupted",
        F.coalesce(F.nullif(F.col("work_mins").cast("int"), F.lit(0)), F.lit(K.DEFAULT_WORK_MINS)).alias("work_mins"),
        F.coalesce(F.nullif(F.col("break_mins").cast("int"), F.lit(0)), F.lit(K.DEFAULT_BREAK_MINS)).alias("break_mins"),
    )


def _sorted(ev: DataFrame, num_partitions: int | None) -> DataFrame:
    """Clustered by (user, segment) and sorted; ``entry`` is the state a segment starts in (null: idle)."""
    n = num_partitions or int(ev.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ev.repartition(n, "user_id", "seg").sortWithinPartitions("user_id", "seg", "t", "seq")


def _whole(ev: DataFrame) -> DataFrame:
    return ev.withColumn("seg", F.lit(0).cast("long")).withColumn("entry", F.lit(None).cast("string"))


def _summaries(batches):
    """A row for each (user, segment): the segment's transition function as JSON."""
    group, rows = None, []

    def done():
        stretch = Stretch(rows, group[2] * 60, group[3] * 60)
        row = (group[0], group[1], json.dumps(stretch.summary()), group[2], group[3])
        return pd.DataFrame([row], columns=["user_id", "seg", "summary", "work_mins", "break_mins"])

    for pdf in batches:
        cols = [pdf[c].to_numpy() for c in ("user_id", "seg", "work_mins", "break_mins", "t", "action", "task_id")]
        for u, seg, work, rest, t, action, task in zip(*cols):
            if group is None or (u, seg) != group[:2]:
                if rows:
                    yield done()
                group, rows = (u, int(seg), int(work), int(rest)), []
            rows.append((int(t), action, task if isinstance(task, str) else None))
    if rows:
        yield done()


def _walk(last_only: bool):
    """The state before each segment of a user, the segments in order; or the one after the last."""

    def run(batches):
        user, state, mins = None, None, None
        for pdf in batches:
            out = []
            cols = [pdf[c].to_numpy() for c in ("user_id", "seg", "summary", "work_mins", "break_mins")]
            for u, seg, summary, work, rest in zip(*cols):
                if user is None or u != user:
                    if last_only and user is not None:
                        out.append((user, json.dumps(state), *mins))
                    user, state, mins = u, IDLE, (int(work), int(rest))
                if not last_only:
                    out.append((u, seg, json.dumps(state)))
                state = follow(json.loads(summary), state)
            yield pd.DataFrame.from_records(out, columns=_LAST if last_only else _ENTRIES)
        if last_only and user is not None:
            yield pd.DataFrame.from_records([(user, json.dumps(state), *mins)], columns=_LAST)

    return run


_ENTRIES, _LAST = ["user_id", "seg", "entry"], ["user_id", "entry", "work_mins", "break_mins"]


def _segments(ev: DataFrame, num_partitions: int | None, segment: int) -> tuple[DataFrame, DataFrame]:
    """Events of users beyond ``segment`` events cut into segments, and the segments' summaries in order.

    Each segment's effect on any state is found on its own (``transitions``); one pass over these
    summaries, a row a segment, then gives the states between the segments (``_walk``).
    """
    placed = ordered_scan(ev, "user_id", ["t", "seq"], position="__pos")
    cut = placed.withColumn("seg", F.floor(F.col("__pos") / segment)).drop("__pos").checkpoint()
    kind = "user_id long, seg long, summary string, work_mins int, break_mins int"
    found = _sorted(cut, num_partitions).mapInPandas(_summaries, kind).checkpoint()
    n = num_partitions or int(ev.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut, found.repartition(n, "user_id").sortWithinPartitions("user_id", "seg")


def _large(events: DataFrame, segment: int) -> DataFrame | None:
    """The users of over ``segment`` events, if there are any."""
    ensure_checkpoint_dir(events.sparkSession)
    counts = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("__n"))
    large = counts.where(F.col("__n") > segment).select("user_id").checkpoint()
    return None if large.isEmpty() else large


def _started(entry: str | None, work_mins: int, break_mins: int) -> TimerState:
    state = TimerState(work_mins, break_mins)
    kind, number, task = json.loads(entry) if isinstance(entry, str) else IDLE
    state.task = task
    if kind == "break":
        state.phase, state.break_end = "break", number
    elif kind == "running":
        state.phase, state.rem, state.run_start = "work", state.work_s, number - state.work_s * _MICROS
    elif kind == "paused":
        state.phase, state.rem = "paused", number
    elif kind == "awaiting":
        state.phase = "work"
    return state


def _fold(emit_status: bool, as_of_us: int | None):
    """Streaming pass over rows clustered by (user, segment), from the state each segment starts in."""

    def run(batches):
        group, user, state = None, None, None

        def finish():
            if emit_status and state is not None:
                ph, rem, aw = state.status(as_of_us)
                out.append((user, ph, rem, state.task if ph != "idle" else None, aw))

        for pdf in batches:
            out = []
            cols = [pdf[c].to_numpy() for c in ("user_id", "seg", "t", "seq", "action", "task_id",
                                                "reflection", "interrupted", "work_mins", "break_mins", "entry")]
            for u, seg, t, seq, action, task_id, refl, intr, wm, bm, entry in zip(*cols):
                if (u, seg) != group:
                    finish()
                    group, user, state = (u, seg), u, _started(entry, int(wm), int(bm))
                t = int(t)
                if as_of_us is not None and t > as_of_us:
                    continue
                s = state.step(t, action, task_id, None if refl is None or pd.isna(refl) else refl,
                               None if intr is None or pd.isna(intr) else bool(intr))
                if s is not None and not emit_status:
                    out.append((u, int(seq), s[0], s[1], s[2], s[3], pd.Timestamp(t, unit="us").date(),
                                pd.Timestamp(t, unit="us")))
            if out:
                yield pd.DataFrame.from_records(out, columns=(STATUS_SCHEMA if emit_status else SESSION_SCHEMA).names)
        out = []
        finish()
        if out:
            yield pd.DataFrame.from_records(out, columns=STATUS_SCHEMA.names)

    return run


def timer_sessions(
    events: DataFrame, settings: DataFrame | None = None, num_partitions: int | None = None, segment: int = SEGMENT
) -> DataFrame:
    """T4: completed focus sessions from start/pause/resume/stop/checkin events.

    Start needs the idle phase and a task; pause stops the clock; stop throws
    the run (or the break) away; after ``work_mins`` of running time the
    check-in is awaited and writes a session of ``work_mins`` at check-in
    time; then ``break_mins`` of break.  ``settings`` (user_id, work_mins,
    break_mins) default to 25 / 5.  Events are folded in (ts, seq) order, a
    user in one streaming pass with constant memory; users of more than
    ``segment`` events are folded in segments (``_segments``).
    """
    ev = _timer_input(events, settings)
    large = _large(events, segment)
    if large is None:
        rows = _whole(ev)
    else:
        cut, summaries = _segments(ev.join(large, "user_id", "left_semi"), num_partitions, segment)
        entries = summaries.mapInPandas(_walk(False), "user_id long, seg long, entry string")
        whole = _whole(ev.join(large, "user_id", "left_anti"))
        rows = whole.unionByName(cut.join(entries, ["user_id", "seg"]))
    return _sorted(rows, num_partitions).mapInPandas(_fold(False, None), SESSION_SCHEMA)


def timer_notices(
    events: DataFrame, settings: DataFrame | None = None, sessions: DataFrame | None = None
) -> DataFrame:
    """T4's notices: ``user_id``, ``seq`` of the check-in, ``ts``, ``title``, ``body``.

    A check-in logs a session and says how many the user has that day; its break is over
    ``break_mins`` later, unless the timer is stopped before.  ``sessions``: what
    :func:`timer_sessions` gave for the same events, if it is at hand.
    """
    if sessions is None:
        sessions = timer_sessions(events, settings)
    mins = settings.select("user_id", "break_mins") if settings is not None else None
    logged = sessions.select("user_id", "seq", "completed_at", F.struct("user_id", "date").alias("__day"))
    logged = ordered_scan(logged, "__day", ["completed_at", "seq"], position="__n").drop("__day")
    rest = F.lit(K.DEFAULT_BREAK_MINS)
    if mins is not None:
        logged = logged.join(mins, "user_id", "left")
        rest = F.coalesce(F.nullif(F.col("break_mins").cast("int"), F.lit(0)), rest)
    count, minutes = (F.col(c).cast("string") for c in ("__n", "__rest"))
    logged = logged.withColumn("__rest", rest).withColumn("__n", F.col("__n") + 1).drop("break_mins")
    head, middle, tail = K.LOGGED_TEXT.split("{}")
    said = logged.select(
        "user_id", "seq", F.col("completed_at").alias("ts"), F.lit(K.LOGGED_TITLE).alias("title"),
        F.concat(F.lit(head), count, F.lit(middle), minutes, F.lit(tail)).alias("body"),
    )
    # the next stop after a check-in: the last one before it, read backwards
    micros = F.unix_micros("ts")
    stops = events.where("action = 'stop'").select("user_id", "seq", micros.alias("t"), micros.alias("__stop"), F.lit(None).cast("int").alias("__rest"))
    ends = logged.select("user_id", "seq", F.unix_micros("completed_at").alias("t"), F.lit(None).cast("long").alias("__stop"), "__rest")
    back = stops.unionByName(ends).withColumn("__t", -F.col("t")).withColumn("__seq", -F.col("seq"))
    seen = ordered_scan(back, "user_id", ["__t", "__seq"], last={"__next": "__stop"}).where(F.col("__rest").isNotNull())
    over = F.col("t") + F.col("__rest") * 60 * _MICROS
    rested = seen.where(F.col("__next").isNull() | (F.col("__next") >= over)).select(
        "user_id", "seq", F.timestamp_micros(over).alias("ts"), F.lit(K.BREAK_OVER_TITLE).alias("title"),
        F.lit(K.BREAK_OVER_TEXT).alias("body"),
    )
    return said.unionByName(rested)


def _status_of(as_of_us: int):
    """Status rows of the states after all events."""

    def run(batches):
        for pdf in batches:
            out = []
            cols = [pdf[c].to_numpy() for c in _LAST]
            for user, entry, work, rest in zip(*cols):
                state = _started(entry, int(work), int(rest))
                phase, left, awaits = state.status(as_of_us)
                out.append((user, phase, left, state.task if phase != "idle" else None, awaits))
            yield pd.DataFrame.from_records(out, columns=STATUS_SCHEMA.names)

    return run


def timer_status(
    events: DataFrame,
    as_of: str,
    settings: DataFrame | None = None,
    num_partitions: int | None = None,
    segment: int = SEGMENT,
) -> DataFrame:
    """T5: phase and the shown ``mm:ss`` per user as of ``as_of`` (events up to it).

    Every user of ``events`` or ``settings`` has a row.
    """
    as_of_us = int(pd.Timestamp(as_of, tz="UTC").value // 1000)
    so_far = events.where(F.col("ts") <= F.lit(as_of).cast("timestamp"))
    # the state at ``as_of`` depends only on the events since the user's last stop
    # by a bounded aggregate; only what follows the stop is folded
    at = F.struct("ts", "seq")
    last = so_far.where("action = 'stop'").groupBy("user_id").agg(F.max(at).alias("__last"))
    since = so_far.join(last, "user_id", "left").where(F.col("__last").isNull() | (at > F.col("__last"))).drop("__last")
    ev, large = _timer_input(since, settings), _large(since, segment)
    few = ev if large is None else ev.join(large, "user_id", "left_anti")
    found = _sorted(_whole(few), num_partitions).mapInPandas(_fold(True, as_of_us), STATUS_SCHEMA)
    if large is not None:
        _, summaries = _segments(ev.join(large, "user_id", "left_semi"), num_partitions, segment)
        after = summaries.mapInPandas(_walk(True), "user_id long, entry string, work_mins int, break_mins int")
        found = found.unionByName(after.mapInPandas(_status_of(as_of_us), STATUS_SCHEMA))
    # users without events up to then show Ready and their work length
    users = events.select("user_id")
    work = F.lit(K.DEFAULT_WORK_MINS)
    if settings is not None:
        users = users.unionByName(settings.select("user_id"))
    users = users.distinct()
    if settings is not None:
        users = users.join(settings.select("user_id", "work_mins"), "user_id", "left")
        work = F.coalesce(F.nullif(F.col("work_mins").cast("int"), F.lit(0)), work)
    st = users.join(found, "user_id", "left").select(
        "user_id",
        F.coalesce("phase", F.lit("idle")).alias("phase"),
        F.coalesce("remaining_s", (work * 60).cast("long")).alias("remaining_s"),
        "task_id",
        F.coalesce("awaiting_checkin", F.lit(False)).alias("awaiting_checkin"),
    )
    label = (
        F.when(F.col("phase") == "idle", "Ready")
        .when(F.col("phase") == "work", "Focus")
        .when(F.col("phase") == "paused", "Paused")
        .otherwise("Break")
    )
    return st.select("user_id", "phase", label.alias("label"), "remaining_s", mmss("remaining_s").alias("display"),
                     "task_id", "awaiting_checkin")
