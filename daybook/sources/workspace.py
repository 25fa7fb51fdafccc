"""The app's workspace document <-> the three tables.

A workspace document holds ``tasks``, ``notes`` and ``focusSessions`` arrays
(and an unused ``dailyPlans``), with the app's camelCase field names and
ISO-8601 UTC time strings.  Two layouts are read:

* ``multiline=True``: the app's own files, one pretty-printed document per
  file named ``<user_id>.json`` (an import; each file is read by one task);
* ``multiline=False``: JSON Lines as written by :func:`write_workspaces`,
  one document per line with an extra ``user_id`` key (splittable, parallel).

A missing or zero-length file gives no rows.  An unparseable document gives empty arrays,
as in the app, and is also listed in the ``corrupt`` output.  ``carriedOverCount``
and ``dailyPlans``, which the app never uses, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Every value is read as text and cast on its own, so that one odd value (a
# fractional number, a wrong type) never loses the record around it.
_FIELDS = {
    "tasks": "id title priority dueDate done order createdAt completedAt carriedOverCount",
    "notes": "id content taskId summary createdAt updatedAt",
    "focusSessions": "id taskId taskTitle durationMinutes reflection interrupted date completedAt",
}
_DOCUMENT = "struct<user_id: string, tasks: string, notes: string, focusSessions: string, dailyPlans: string, end: string>"
# JSON as the app's own parser takes it: no single quotes, no NaN
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


class Workspaces(NamedTuple):
    """What :func:`read_workspaces` returns."""

    tasks: DataFrame
    notes: DataFrame
    sessions: DataFrame
    corrupt: DataFrame  # user_id (if it can be read), file_path
    plans: DataFrame  # user_id, daily_plans: the unused array, as JSON text


_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _parse_ts(field: str) -> Column:
    """ISO-8601 text to an instant; unparseable text becomes null."""
    return F.expr(f"try_cast({field} AS timestamp)")


def _parse_date(field: str) -> Column:
    return F.expr(f"try_cast({field} AS date)")


def _items(docs: DataFrame, field: str) -> DataFrame:
    """(user_id, array_pos, x, __j): the records of one array, each with its fields as text, and as it stands.

    An outer explode, so that no filter repeats the parse below it.
    """
    kind = ", ".join(f"`{f}` string" for f in _FIELDS[field].split())
    return (
        docs.select("user_id", F.posexplode_outer(F.from_json(field, "array<string>")).alias("array_pos", "__j"))
        .where(F.col("array_pos").isNotNull())
        .select("user_id", F.col("array_pos").cast("long").alias("array_pos"), F.from_json("__j", kind).alias("x"), "__j")
    )


def _flag(c: str) -> Column:
    return F.col(c).try_cast("boolean")


def _parsed(text: Column) -> Column:
    """A text as the first of the values of an array whose last one holds a digest of the text.

    The parser stops at the end of the first value, so the text is parsed inside this frame:
    what follows the object would have to close the frame and repeat the digest.
    """
    framed = F.concat(F.lit("["), text, F.lit(',{"end":'), F.xxhash64(text), F.lit("}]"))
    return F.from_json(framed, f"array<{_DOCUMENT}>", _STRICT)


def _documents(parsed: Column, text: Column) -> Column:
    """The fields of a text that is one JSON object and nothing else, as an array of one; else null."""
    whole = (F.size(parsed) == 2) & (F.get(parsed, F.lit(1))["end"] == F.xxhash64(text).cast("string"))
    return F.when(whole & F.get(parsed, F.lit(0)).isNotNull(), F.slice(parsed, 1, 1))


def read_workspaces(spark: SparkSession, path: str, multiline: bool = True) -> Workspaces:
    """The tables of workspace documents.

    Array positions become ``array_pos``; a missing ``order`` stays null (the
    list order back-fills it, O1), any other number is kept as it is.  A document is
    corrupt if it is no JSON object by the strict grammar, or if text follows it;
    that is decided from a full parse, whatever columns are read.
    Inside a good document each value stands alone: one that has the wrong type
    is null, and so is a flag whose text is neither true nor false; minutes may be fractional.
    """
    raw = spark.read.text(path, wholetext=multiline).withColumn("file_path", F.col("_metadata.file_path"))
    from_name = F.regexp_extract(F.col("file_path"), r"(\d+)\.json[^/]*$", 1)
    # the id of a line that cannot be parsed, if it starts with one as written here
    from_text = F.regexp_extract("value", r'^\s*\{\s*"user_id"\s*:\s*(\d+)', 1)
    d = F.col("d")
    parsed = raw.select("value", "file_path", _parsed(F.col("value")).alias("__parsed"))
    # one parse a document: filters on the exploded value stay above the explode
    docs = parsed.select("value", "file_path", F.explode_outer(_documents(F.col("__parsed"), F.col("value"))).alias("d")).select(
        F.coalesce(
            d["user_id"].try_cast("long"), F.nullif(from_text, F.lit("")).cast("long"), F.nullif(from_name, F.lit("")).cast("long")
        ).alias("user_id"),
        "file_path",
        d.isNull().alias("__corrupt"),
        *[d[c].alias(c) for c in (*_FIELDS, "dailyPlans")],
    )
    ok = docs.where(~F.col("__corrupt"))
    # the app fills in a missing order only; a null one sorts as 0
    null_order = F.col("x.order").isNull() & F.array_contains(F.json_object_keys("__j"), "order")
    tasks = _items(docs, "tasks").select(
        "user_id",
        "x.id",
        "x.title",
        "x.priority",
        _parse_date("x.dueDate").alias("due_date"),
        _flag("x.done").alias("done"),
        F.when(null_order, 0.0).otherwise(F.col("x.order").try_cast("double")).alias("ord"),
        "array_pos",
        _parse_ts("x.createdAt").alias("created_at"),
        _parse_ts("x.completedAt").alias("completed_at"),
        F.coalesce(F.col("x.carriedOverCount").try_cast("int"), F.lit(0)).alias("carried_over_count"),
    )
    notes = _items(docs, "notes").select(
        "user_id",
        "x.id",
        "x.content",
        F.col("x.taskId").alias("task_id"),
        "x.summary",
        _parse_ts("x.createdAt").alias("created_at"),
        _parse_ts("x.updatedAt").alias("updated_at"),
        "array_pos",
    )
    sessions = _items(docs, "focusSessions").select(
        "user_id",
        "x.id",
        F.col("x.taskId").alias("task_id"),
        F.col("x.taskTitle").alias("task_title"),
        F.col("x.durationMinutes").try_cast("double").alias("duration_minutes"),
        "x.reflection",
        _flag("x.interrupted").alias("interrupted"),
        _parse_date("x.date").alias("date"),
        _parse_ts("x.completedAt").alias("completed_at"),
        "array_pos",
    )
    corrupt = docs.where("__corrupt").select("user_id", "file_path")
    plans = ok.where(F.col("dailyPlans").isNotNull()).select("user_id", F.col("dailyPlans").alias("daily_plans"))
    return Workspaces(tasks, notes, sessions, corrupt, plans)


def _iso(c: str) -> Column:
    return F.date_format(F.col(c), _ISO)


def _task_json(carried: Column, whole_orders: bool) -> Column:
    record = F.to_json(
        F.struct(
            F.col("id"),
            F.col("title"),
            F.col("priority"),
            F.date_format("due_date", "yyyy-MM-dd").alias("dueDate"),
            F.col("done"),
            F.col("ord").alias("order"),
            _iso("created_at").alias("createdAt"),
            _iso("completed_at").alias("completedAt"),
            carried.cast("int").alias("carriedOverCount"),
        )
    )
    if whole_orders:
        return record
    # whole orders as the app writes them; inside a text the quotes would be escaped
    return F.regexp_replace(record, r'"order":(-?[0-9]+)\.0([,}])', '"order":$1$2')


def _note_json() -> Column:
    return F.to_json(
        F.struct(
            F.col("id"),
            F.col("content"),
            F.col("task_id").alias("taskId"),
            F.col("summary"),
            _iso("created_at").alias("createdAt"),
            _iso("updated_at").alias("updatedAt"),
        )
    )


def _session_json() -> Column:
    return F.to_json(
        F.struct(
            F.col("id"),
            F.col("task_id").alias("taskId"),
            F.col("task_title").alias("taskTitle"),
            F.col("duration_minutes").alias("durationMinutes"),
            F.col("reflection"),
            F.col("interrupted"),
            F.date_format("date", "yyyy-MM-dd").alias("date"),
            _iso("completed_at").alias("completedAt"),
        )
    )


def workspace_documents(
    tasks: DataFrame, notes: DataFrame, sessions: DataFrame, plans: DataFrame | None = None
) -> DataFrame:
    """S2 without the write: ``(user_id, document)``, one JSON document per user.

    Arrays keep the stored order: tasks by ``array_pos``, notes newest first
    (``array_pos`` if present, else created_at desc, id), sessions oldest
    first (``array_pos`` if present, else completed_at, id).  Null fields are
    left out, as an absent ``order`` is what the app back-fills.
    ``carried_over_count`` (if present, else 0) and ``plans`` (user_id,
    daily_plans) pass through.
    """
    carried = F.coalesce("carried_over_count", F.lit(0)) if "carried_over_count" in tasks.columns else F.lit(0)
    no_id = F.lit(None).cast("string")
    if "array_pos" in notes.columns:
        note_at = [F.col("array_pos").cast("long"), no_id]
    else:
        notes = notes.where(F.col("user_id").isNotNull() & F.col("id").isNotNull())
        note_at = [-F.unix_micros("created_at"), F.col("id").cast("string")]
    if "array_pos" in sessions.columns:
        session_at = [F.col("array_pos").cast("long"), no_id]
    else:
        session_at = [F.unix_micros("completed_at"), F.col("id").cast("string")]

    def items(df: DataFrame, kind: int, at: list[Column], record: Column) -> DataFrame:
        return df.select("user_id", F.lit(kind).alias("__kind"), at[0].alias("__at"), at[1].alias("__id"), record.alias("__j"))

    each = (
        items(tasks, 0, [F.col("array_pos").cast("long"), no_id], _task_json(carried, dict(tasks.dtypes)["ord"] in ("int", "bigint")))
        .unionByName(items(notes, 1, note_at, _note_json()))
        .unionByName(items(sessions, 2, session_at, _session_json()))
    )
    bodies = _bodies(each)
    daily = F.lit("[]")
    if plans is not None:
        bodies = bodies.join(plans.select("user_id", "daily_plans"), "user_id", "full_outer")
        bodies = bodies.withColumn("__body", F.coalesce("__body", F.lit(_body([], [], []).decode())))
        daily = F.coalesce("daily_plans", F.lit("[]"))
    doc = F.concat(
        F.lit('{"user_id":'), F.col("user_id").cast("string"), F.lit(","), F.col("__body"), F.lit(',"dailyPlans":'), daily, F.lit("}")
    )
    return bodies.select("user_id", doc.alias("document"))


def _body(*arrays: list[bytes]) -> bytes:
    """The three arrays of a document from their records' JSON."""
    return b",".join(b'"%s":[%s]' % (name.encode(), b",".join(records)) for name, records in zip(_FIELDS, arrays))


def _in_place(notes: list[tuple[str | None, bytes]]) -> list[bytes]:
    """The records of a user's notes, in order; each place of a repeated id takes every record of that id."""
    by_id: dict[str, list[bytes]] = {}
    for own, j in notes:
        if own is not None:
            by_id.setdefault(own, []).append(j)
    if len(by_id) == len(notes) or not by_id:
        return [j for _, j in notes]
    return [j for own, _ in notes for j in sorted(by_id[own])]


def _run_starts(*columns: pa.Array) -> list[int]:
    """Where a row differs from the one before it in some column."""
    n = len(columns[0])
    differs = np.zeros(max(n - 1, 0), dtype=bool)
    for c in columns:
        row, before = c.slice(1), c.slice(0, max(n - 1, 0))
        other = pc.or_(pc.fill_null(pc.not_equal(row, before), False), pc.xor(pc.is_null(row), pc.is_null(before)))
        differs |= other.to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(differs) + 1).tolist()] if n else []


# bytes of documents that a task hands on at once
BATCH_BYTES = 1 << 22


def _bodies(each: DataFrame) -> DataFrame:
    """(user_id, __body): the arrays of every user's document.

    The records are shuffled once, by user, and each task streams its users in order,
    holding the records of one document.
    """
    kind = each.schema["user_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user_type, users, texts, size = None, [], [], 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(users, user_type), pa.array(texts, pa.binary())], names=["user_id", "__body"])

        def close(who, arrays: tuple[list, list, list]) -> None:
            nonlocal size
            users.append(who)
            texts.append(_body(arrays[0], _in_place(arrays[1]), arrays[2]))
            size += len(texts[-1])

        user, arrays = None, None
        for batch in batches:
            user_type = batch.schema.field("user_id").type
            own, j = batch.column("__id"), batch.column("__j")
            starts = _run_starts(batch.column("user_id"), batch.column("__kind"))
            at = pa.array(starts, pa.int32())
            bounds = pa.array([*starts, batch.num_rows], pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(bounds, j), b",").to_pylist()
            whose, kinds = batch.column("user_id").take(at).to_pylist(), batch.column("__kind").take(at).to_pylist()
            for i, (who, which, text) in enumerate(zip(whose, kinds, joined)):
                if arrays is None or who != user:
                    if arrays is not None:
                        close(user, arrays)
                        if size >= BATCH_BYTES:
                            yield done()
                            users, texts, size = [], [], 0
                    user, arrays = who, ([], [], [])
                if which == 1:
                    low, n = starts[i], bounds[i + 1].as_py() - starts[i]
                    arrays[1].extend(zip(own.slice(low, n).to_pylist(), j.slice(low, n).to_pylist()))
                else:
                    arrays[which].append(text)
        if arrays is not None:
            close(user, arrays)
            yield done()

    # by a hash of the user: dealt anew even if all parts are dealt by user already, as their partitions may be merged differently
    dealt = each.repartition(F.xxhash64("user_id")).sortWithinPartitions("user_id", "__kind", "__at", "__id", "__j")
    # the ids only place the records; those of notes also tell repeated ones
    own = F.when(F.col("__kind") == 1, F.col("__id")).alias("__id")
    streamed = dealt.select("user_id", "__kind", own, F.col("__j").cast("binary").alias("__j"))
    return streamed.mapInArrow(run, f"user_id {kind}, __body binary").withColumn("__body", F.col("__body").cast("string"))


def write_workspaces(
    tasks: DataFrame,
    notes: DataFrame,
    sessions: DataFrame,
    path: str,
    plans: DataFrame | None = None,
    compression: str = "none",
) -> None:
    """Write the documents as JSON Lines under ``path`` (parallel, one file per task; a compressed file is read by one task)."""
    workspace_documents(tasks, notes, sessions, plans).select(F.col("document").alias("value")).write.mode(
        "overwrite"
    ).text(path, compression=compression)
