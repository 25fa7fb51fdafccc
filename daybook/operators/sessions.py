"""Focus-session jobs: new rows, day filters, labels, lookups and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import session_label
from daybook.operators.sequence import ordered_scan


def new_sessions(raw: DataFrame, now: Column) -> DataFrame:
    """A falsy reflection becomes '', a falsy interrupted false; the date is the UTC day of ``now``."""
    ts = now.cast("timestamp")
    return raw.select(
        "user_id",
        "id",
        "task_id",
        "task_title",
        "duration_minutes",
        F.coalesce(F.col("reflection"), F.lit("")).alias("reflection"),
        F.coalesce(F.col("interrupted"), F.lit(False)).alias("interrupted"),
        F.to_date(ts).alias("date"),
        ts.alias("completed_at"),
    )


def sessions_on_date(sessions: DataFrame, day: str) -> DataFrame:
    """Sessions of one UTC day (a pushed-down filter; prunes a ``date`` partition)."""
    return sessions.where(F.col("date") == F.lit(day).cast("date"))


def session_log(sessions: DataFrame) -> DataFrame:
    """O6 + P10: sessions oldest first with their badge and shown reflection.

    ``log_pos`` is the 0-based place in the user's log by (completed_at, id).
    """
    shown = sessions.select("user_id", "id", "task_id", "completed_at", "interrupted", "reflection")
    return ordered_scan(shown, "user_id", ["completed_at", "id"], position="log_pos").select(
        "user_id",
        "id",
        "task_id",
        "log_pos",
        session_label("interrupted").alias("label"),
        F.nullif(F.col("reflection"), F.lit("")).alias("shown_reflection"),
    )


def session_titles(sessions: DataFrame, pending: DataFrame) -> DataFrame:
    """The session's task title among pending tasks, '' when not found.

    ``pending`` has user_id, id, title (the not-done tasks when the timer ran).
    """
    t = pending.select("user_id", F.col("id").alias("task_id"), F.col("title").alias("__title"))
    return (
        sessions.drop("task_title")
        .join(t, ["user_id", "task_id"], "left")
        .withColumn("task_title", F.coalesce(F.col("__title"), F.lit("")))
        .drop("__title")
    )


def task_counts(tasks: DataFrame) -> DataFrame:
    """A1: pending and done counts per user."""
    done = F.coalesce(F.col("done"), F.lit(False))
    return tasks.groupBy("user_id").agg(
        F.count_if(~done).alias("pending"), F.count_if(done).alias("done")
    )


def session_counts(sessions: DataFrame, day: str) -> DataFrame:
    """A2: total, focused and distracted sessions of one day per user."""
    intr = F.coalesce(F.col("interrupted"), F.lit(False))
    return (
        sessions_on_date(sessions, day)
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(~intr).alias("focused"),
            F.count_if(intr).alias("distracted"),
        )
    )


def note_counts(notes: DataFrame) -> DataFrame:
    """A3: all notes per user (not only search hits)."""
    return notes.groupBy("user_id").agg(F.count(F.lit(1)).alias("notes"))
