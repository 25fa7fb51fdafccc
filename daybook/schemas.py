"""Explicit schemas of every table the jobs read or write (never inferred)."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


TASKS = _s(
    ("user_id", LongType(), False),
    ("id", StringType(), False),
    ("title", StringType(), True),
    ("priority", StringType(), True),
    ("due_date", DateType(), True),
    ("done", BooleanType(), True),
    ("ord", LongType(), True),
    ("array_pos", LongType(), False),
    ("created_at", TimestampType(), True),
    ("completed_at", TimestampType(), True),
)

NOTES = _s(
    ("user_id", LongType(), False),
    ("id", StringType(), False),
    ("content", StringType(), True),
    ("task_id", StringType(), True),
    ("summary", StringType(), True),
    ("created_at", TimestampType(), True),
    ("updated_at", TimestampType(), True),
)

SESSIONS = _s(
    ("user_id", LongType(), False),
    ("id", StringType(), False),
    ("task_id", StringType(), True),
    ("task_title", StringType(), True),
    ("duration_minutes", IntegerType(), True),
    ("reflection", StringType(), True),
    ("interrupted", BooleanType(), True),
    ("date", DateType(), True),
    ("completed_at", TimestampType(), True),
)

TASK_CHANGES = _s(
    ("user_id", LongType(), False),
    ("change_id", LongType(), False),
    ("ts", TimestampType(), False),
    ("task_id", StringType(), False),
    ("op", StringType(), False),
    ("set_title", BooleanType(), True),
    ("title", StringType(), True),
    ("set_priority", BooleanType(), True),
    ("priority", StringType(), True),
    ("set_due", BooleanType(), True),
    ("due_date", DateType(), True),
    ("set_done", BooleanType(), True),
    ("done", BooleanType(), True),
)

NOTE_CHANGES = _s(
    ("user_id", LongType(), False),
    ("change_id", LongType(), False),
    ("ts", TimestampType(), False),
    ("note_id", StringType(), False),
    ("op", StringType(), False),
    ("set_content", BooleanType(), True),
    ("content", StringType(), True),
    ("set_summary", BooleanType(), True),
    ("summary", StringType(), True),
)

REORDERS = _s(
    ("user_id", LongType(), False),
    ("ts", TimestampType(), False),
    ("ordered_ids", ArrayType(StringType()), True),
)

MOVES = _s(
    ("user_id", LongType(), False),
    ("ts", TimestampType(), False),
    ("drag_id", StringType(), True),
    ("over_id", StringType(), True),
)

TIMER_EVENTS = _s(
    ("user_id", LongType(), False),
    ("seq", LongType(), False),
    ("ts", TimestampType(), False),
    ("action", StringType(), False),
    ("task_id", StringType(), True),
    ("reflection", StringType(), True),
    ("interrupted", BooleanType(), True),
)

SETTINGS = _s(
    ("user_id", LongType(), False),
    ("work_mins", IntegerType(), True),
    ("break_mins", IntegerType(), True),
)

CHAT_TURNS = _s(
    ("conv_id", LongType(), False),
    ("turn", LongType(), False),
    ("role", StringType(), False),
    ("text", StringType(), True),
    ("mode", StringType(), True),
)

ACTIVITY = _s(("user_id", LongType(), False), ("ts", TimestampType(), False))

TICKS = ACTIVITY

RESPONSES = _s(("request_id", StringType(), False), ("text", StringType(), True))
