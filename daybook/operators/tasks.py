"""Task jobs: new rows, list order, board columns and folding change logs.

All jobs are keyed by ``user_id``; ids are unique per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.constants import DEFAULT_PRIORITY
from daybook.functions import js_trim, next_priority, priority_class
from daybook.operators.moves import shifts
from daybook.operators.sequence import ordered_scan

TASK_COLUMNS = [
    "user_id",
    "id",
    "title",
    "priority",
    "due_date",
    "done",
    "ord",
    "array_pos",
    "created_at",
    "completed_at",
]


# ---------------------------------------------------------------- P1, O2


def new_tasks(raw: DataFrame, now: Column) -> DataFrame:
    """Validate added tasks.

    ``raw``: user_id, id, title, priority (null -> med), due ('YYYY-MM-DD'; '',
    null or anything else -> no date, which is never overdue), seq (order of
    the adds within a user).
    Blank titles (after JavaScript trim) are dropped.
    """
    title = js_trim("title")
    return raw.where(title != "").select(
        "user_id",
        "id",
        title.alias("title"),
        F.coalesce(F.col("priority"), F.lit(DEFAULT_PRIORITY)).alias("priority"),
        F.nullif(F.col("due"), F.lit("")).try_cast("date").alias("due_date"),
        F.lit(False).alias("done"),
        now.cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("completed_at"),
        F.lit(0).alias("carried_over_count"),
        "seq",
    )


def append_tasks(tasks: DataFrame, new: DataFrame) -> DataFrame:
    """O2: order and array position of tasks appended in ``seq`` order.

    Each add takes max(order, missing counted as 0) over the user's tasks,
    starting from -1, plus one; so the i-th add of a batch gets max + i.
    Returns the new rows with ``ord`` and ``array_pos``.
    """
    existing = tasks.groupBy("user_id").agg(
        F.max(F.coalesce(F.col("ord"), F.lit(0))).alias("__max_ord"),
        F.count(F.lit(1)).alias("__n"),
    )
    ranked = ordered_scan(new, "user_id", ["seq"], position="__i")
    out = ranked.join(existing, "user_id", "left").select(
        *[c for c in new.columns if c != "seq"],
        (F.coalesce(F.col("__max_ord"), F.lit(-1)) + F.col("__i") + 1).alias("ord"),
        (F.coalesce(F.col("__n"), F.lit(0)) + F.col("__i")).alias("array_pos"),
    )
    return out


# ---------------------------------------------------------------- O1, P5-P8


def _filled(tasks: DataFrame) -> DataFrame:
    return tasks.withColumn("ord", F.coalesce(F.col("ord"), F.col("array_pos")))


def _is_done() -> Column:
    return F.coalesce(F.col("done"), F.lit(False))


def order_tasks(tasks: DataFrame) -> DataFrame:
    """O1: back-fill a missing order with the array position, then a stable sort.

    ``list_pos`` is the 0-based place in the user's list; array position breaks
    ties, as back-filled orders can collide with stored ones.
    """
    return ordered_scan(_filled(tasks), "user_id", ["ord", "array_pos"], position="list_pos")


def pending_tasks(tasks: DataFrame) -> DataFrame:
    """P5: not-done tasks in list order; ``pos`` is the place among them."""
    return ordered_scan(_filled(tasks.where(~_is_done())), "user_id", ["ord", "array_pos"], position="pos")


def done_tasks(tasks: DataFrame) -> DataFrame:
    """P5: done tasks in list order; ``pos`` is the place among them."""
    return ordered_scan(_filled(tasks.where(_is_done())), "user_id", ["ord", "array_pos"], position="pos")


def local_midnight(as_of: Column, tz: str) -> Column:
    """Instant of local midnight (in ``tz``) of the local day of ``as_of``."""
    return F.to_utc_timestamp(F.date_trunc("day", F.from_utc_timestamp(as_of, tz)), tz)


def overdue(due_date: Column, done: Column, as_of: Column, tz: str) -> Column:
    """The due date at UTC midnight lies before local midnight of today.

    West of UTC a task due today counts as overdue, as in the app.  No date is
    never overdue; done tasks are not overdue.
    """
    is_over = F.to_timestamp(due_date) < local_midnight(as_of, tz)
    return F.coalesce(is_over, F.lit(False)) & ~F.coalesce(done, F.lit(False))


def overdue_tasks(tasks: DataFrame, as_of: Column, tz: str) -> DataFrame:
    """The overdue rows."""
    return tasks.where(overdue(F.col("due_date"), F.col("done"), as_of, tz))


def task_board(tasks: DataFrame, as_of: Column, tz: str) -> DataFrame:
    """O1 + P6 + P7 + P8: the ordered list with its display columns."""
    return order_tasks(tasks).select(
        "user_id",
        "id",
        "title",
        "priority",
        "done",
        "list_pos",
        overdue(F.col("due_date"), F.col("done"), as_of, tz).alias("overdue"),
        next_priority("priority").alias("next_priority"),
        priority_class("priority").alias("priority_class"),
    )


# ---------------------------------------------------------------- P4


def title_edits(tasks: DataFrame, edits: DataFrame) -> DataFrame:
    """Accepted title edits -> (user_id, task_id, title).

    Kept when the trimmed text is not empty and the raw text differs from the
    stored title; the trimmed text is written.
    """
    t = tasks.select("user_id", F.col("id").alias("task_id"), F.col("title").alias("__old"))
    trimmed = js_trim("raw_title")
    return (
        edits.join(t, ["user_id", "task_id"])
        .where((trimmed != "") & ~F.col("raw_title").eqNullSafe(F.col("__old")))
        .select("user_id", "task_id", "edit_id", trimmed.alias("title"))
    )


# ---------------------------------------------------------------- O3, O4


def apply_reorder(tasks: DataFrame, reorders: DataFrame) -> DataFrame:
    """O3: the i-th listed id gets order i.

    Unknown ids are skipped but use up their index; a repeated id keeps its
    last index; unlisted tasks keep their order.  Several reorders of one user
    apply in (``ts``, ``reorder_id``) order, so the latest one that lists an id
    wins.
    """
    tie = ["reorder_id"] if "reorder_id" in reorders.columns else []
    listed = (
        reorders.select("user_id", "ts", *tie, F.posexplode("ordered_ids").alias("__i", "id"))
        .groupBy("user_id", "id")
        .agg(F.max(F.struct("ts", *tie, "__i"))["__i"].alias("__new"))
    )
    return (
        tasks.join(listed, ["user_id", "id"], "left")
        .withColumn("ord", F.coalesce(F.col("__new").cast("long"), F.col("ord")))
        .drop("__new")
    )


def move_item(tasks: DataFrame, moves: DataFrame) -> DataFrame:
    """Drags within the pending list, each written back as a reorder.

    From index f to index t among pending tasks: the dragged item goes to t,
    items in (f, t] move up one when f < t, items in [t, f) move down one when
    f > t.  A move onto itself or with an id not pending is a no-op.  Then every
    pending task's order becomes its new index; done tasks keep theirs (and
    may collide).  Several moves of one user apply in (``ts``, ``move_id``)
    order, each to the list the one before left.  All moves of a user are composed
    at once (``moves``): the items they name and the runs between those each get
    one shift, which their tasks take by an equality join.
    """
    tie = ["move_id"] if "move_id" in moves.columns else ["drag_id", "over_id"]
    named = moves.select("user_id", F.explode(F.array("drag_id", "over_id")).alias("id")).distinct()
    pending = _filled(tasks.where(~_is_done())).select("user_id", "id", "ord", "array_pos")
    pend = (
        pending.join(moves.select("user_id").distinct(), "user_id", "left_semi")
        .join(named.withColumn("__marked", F.lit(1)), ["user_id", "id"], "left")
        .withColumn("__marked", F.coalesce("__marked", F.lit(0)))
    )
    placed = ordered_scan(
        pend, "user_id", ["ord", "array_pos"], position="pos", running_sum={"__gap": "__marked"}, counted=pending
    )
    found = shifts(placed.where("__marked = 1").select("user_id", "id", "pos"), moves, ["ts", *tie])
    new_ord = placed.join(found, ["user_id", "__gap", "__marked"]).select(
        "user_id", "id", (F.col("pos") + F.col("__shift")).alias("__new")
    )
    return (
        tasks.join(new_ord, ["user_id", "id"], "left")
        .withColumn("ord", F.coalesce(F.col("__new").cast("long"), F.col("ord")))
        .drop("__new")
    )


# ---------------------------------------------------------------- M1, M2


def apply_deletes(table: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """M2: drop rows whose id is deleted; unknown ids are no-ops; no cascade."""
    gone = ids.select("user_id", F.col("task_id").alias(id_col)) if "task_id" in ids.columns else ids
    return table.join(gone, ["user_id", id_col], "left_anti")


def apply_task_changes(tasks: DataFrame, log: DataFrame) -> DataFrame:
    """M1 + M2: fold a change log (``op`` update/delete) into the task snapshot.

    Patches overwrite the fields they carry (an explicit null clears), in
    (ts, change_id) order.  Changes to unknown ids are ignored, a delete is
    final.  ``completed_at``: with L the last ``done=false``, a final done
    false gives null; a final done true gives the first ``done=true`` after L,
    or without any L the stored value if set, else the first ``done=true``.

    The log is read once: an ordered scan gives every ``done=true`` the done change
    before it, and one aggregate a task keeps the last changes and the last ``done=true``
    that follows no other ``done=true``.  That is the first one after L, or without an
    L the first of all.  A hot task is scanned in buckets (``ordered_scan``).
    """
    for c, t in (("set_title", "boolean"), ("title", "string")):
        if c not in log.columns:
            log = log.withColumn(c, F.lit(None).cast(t))
    update = F.col("op") == "update"
    at = F.struct(F.col("ts"), F.col("change_id"))
    changes = log.select(
        F.struct("user_id", "task_id").alias("__task"), "ts", "change_id", "op", "set_title", "title", "set_priority", "priority",
        "set_due", "due_date", "set_done", "done", F.when(update & F.col("set_done"), F.col("done")).alias("__sets"),
    )
    changes = ordered_scan(changes, "__task", ["ts", "change_id"], last={"__before": "__sets"})

    def last_set(flag: str, value: str) -> Column:
        """Latest value among changes that carry the field (null is a value)."""
        return F.max(F.when(update & F.col(flag), F.struct("ts", "change_id", F.col(value).alias("v"))))

    starts = F.col("__sets") & ~F.coalesce("__before", F.lit(False))
    ch = (
        changes.groupBy("__task")
        .agg(
            F.max((F.col("op") == "delete").cast("int")).alias("__gone"),
            last_set("set_title", "title").alias("__title"),
            last_set("set_priority", "priority").alias("__priority"),
            last_set("set_due", "due_date").alias("__due"),
            last_set("set_done", "done").alias("__done"),
            F.max(update & F.col("set_done") & ~F.col("done")).alias("__any_false"),
            F.max(F.when(starts, at))["ts"].alias("__first_true"),
        )
        .select("__task.user_id", F.col("__task.task_id").alias("id"), "*")
        .drop("__task")
    )

    def pick(field: str, col: str) -> Column:
        return F.when(F.col(field).isNotNull(), F.col(field)["v"]).otherwise(F.col(col))

    final_done = pick("__done", "done")
    completed = (
        F.when(F.col("__done").isNull(), F.col("completed_at"))
        .when(~F.coalesce(final_done, F.lit(False)), F.lit(None).cast("timestamp"))
        .when(F.col("__any_false"), F.col("__first_true"))
        .otherwise(F.coalesce(F.col("completed_at"), F.col("__first_true")))
    )
    return tasks.join(ch, ["user_id", "id"], "left").where(F.coalesce(F.col("__gone"), F.lit(0)) == 0).select(
        "user_id",
        "id",
        pick("__title", "title").alias("title"),
        pick("__priority", "priority").alias("priority"),
        pick("__due", "due_date").alias("due_date"),
        final_done.alias("done"),
        "ord",
        "array_pos",
        "created_at",
        completed.alias("completed_at"),
    )
