"""A4 day review and A5 kickoff: per-user prompt texts from the ordered lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import constants as K
from daybook.operators.sequence import chunk_texts, ordered_text
from daybook.operators.sessions import session_counts, task_counts
from daybook.operators.tasks import order_tasks, pending_tasks


def _js(c):
    """How a template string shows a null value."""
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def _joined(parts_col: str, want_done: bool):
    picked = F.filter(F.col(parts_col), lambda x: x["done"] == F.lit(want_done))
    text = F.array_join(F.transform(F.array_sort(picked), lambda x: x["__part"]), "\n")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(K.REVIEW_NONE))


def day_review(tasks: DataFrame, sessions: DataFrame, day: str) -> DataFrame:
    """A4: the end-of-day review text per user.

    Completed: every done task ever (not only today's), ``- title``; still
    pending: ``- [priority] title``; both in list order, ``none`` when empty;
    then the day's session counts.  Users with tasks or sessions that day.
    """
    done = F.coalesce(F.col("done"), F.lit(False))
    line = F.when(done, F.concat(F.lit("- "), _js("title"))).otherwise(
        F.concat(F.lit("- ["), _js("priority"), F.lit("] "), _js("title"))
    )
    lines = order_tasks(tasks).select("user_id", done.alias("done"), "list_pos", line.alias("line"))
    parts = chunk_texts(lines, ["user_id", "done"], "list_pos", "line", "\n")
    lists = parts.groupBy("user_id").agg(
        F.collect_list(F.struct("done", "__chunk", "__part")).alias("__parts")
    )
    counts = session_counts(sessions, day)
    joined = lists.join(counts, "user_id", "full_outer")
    total = F.coalesce(F.col("total"), F.lit(0))
    focused = F.coalesce(F.col("focused"), F.lit(0))
    distracted = F.coalesce(F.col("distracted"), F.lit(0))
    no_parts = F.array().cast("array<struct<done:boolean,__chunk:bigint,__part:string>>")
    joined = joined.withColumn("__parts", F.coalesce(F.col("__parts"), no_parts))
    text = F.concat(
        F.lit(K.REVIEW_HEAD),
        _joined("__parts", True),
        F.lit(K.REVIEW_PENDING),
        _joined("__parts", False),
        F.lit(K.REVIEW_POMODOROS),
        F.format_string("%d total (%d focused, %d distracted)", total, focused, distracted),
        F.lit(K.REVIEW_TAIL),
    )
    return joined.select(
        "user_id",
        total.alias("sessions_total"),
        focused.alias("sessions_focused"),
        distracted.alias("sessions_distracted"),
        text.alias("prompt"),
    )


def kickoff(tasks: DataFrame) -> DataFrame:
    """A5: the morning kickoff text per user with tasks.

    Pending tasks only, in list order, ``i. [priority] title`` from 1.  Users
    without pending tasks get no prompt (null) and the fixed notice instead.
    """
    pend = pending_tasks(tasks)
    line = F.concat((F.col("pos") + 1).cast("string"), F.lit(". ["), _js("priority"), F.lit("] "), _js("title"))
    lists = ordered_text(pend.select("user_id", "pos", line.alias("line")), ["user_id"], "pos", "line", "\n", "__list")
    counts = task_counts(tasks)
    has = F.col("pending") > 0
    return counts.join(lists, "user_id", "left").select(
        "user_id",
        F.col("pending").alias("n_pending"),
        F.when(has, F.concat(F.lit(K.KICKOFF_HEAD), F.col("__list"), F.lit(K.KICKOFF_TAIL))).alias("prompt"),
        F.when(~has, F.lit(K.KICKOFF_EMPTY)).alias("notice"),
    )
