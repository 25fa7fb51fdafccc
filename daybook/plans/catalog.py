"""Registry of runnable queries: a Spark job per inventory key and its DuckDB oracle.

Every query reads the shared test tables of one scale-factor folder (through
the fixtures, which only reshape rows) and runs the library's own job on all
of it.  Parameters (as-of time, day, time zone, search text) are fixed here.
Timestamp outputs are cast to ``timestamp_ntz`` (UTC wall clock) so they
compare with DuckDB's ``TIMESTAMP``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from daybook import constants as K
from daybook.operators import notes as N
from daybook.operators import sessions as S
from daybook.operators import tasks as T
from daybook.plans import review as R
from daybook.session import apply_required_conf
from daybook.sources import snapshots
from daybook.sources.fixtures import Fixtures, duckdb_fixture, duckdb_with

# ------------------------------------------------------------ parameters

AS_OF = "1998-08-02 03:00:00"  # UTC instant for the task board
TZ = "America/Los_Angeles"  # west of UTC: the overdue quirk shows
DAY = "2024-01-15"  # the review day
NOTES_AS_OF = "2024-01-03 00:00:00"
SEARCH_TEXT = "Die"
NOW = "2024-02-01 09:30:00"


def _ts(s: str):
    return F.lit(s).cast("timestamp")


def _local_midnight_utc(as_of: str, tz: str) -> str:
    """Independent (Python) computation of the instant the oracle compares with."""
    t = datetime.fromisoformat(as_of).replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(tz))
    midnight = t.replace(hour=0, minute=0, second=0, microsecond=0)
    return midnight.astimezone(ZoneInfo("UTC")).strftime("%Y-%m-%d %H:%M:%S")


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def duck_trim(expr: str) -> str:
    """JavaScript trim in DuckDB (RE2 code points are written ``\\x{....}``)."""
    cls = K.JS_WHITESPACE_CLASS
    import re

    cls = re.sub(r"\\u([0-9A-Fa-f]{4})", lambda m: "\\x{" + m.group(1) + "}", cls)
    return f"regexp_replace({expr}, '^{cls}+|{cls}+$', '', 'g')"


# ------------------------------------------------------------ registry

_QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn

    return deco


def _finish(df: DataFrame) -> DataFrame:
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp_ntz"))
    return df


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_required_conf(spark)
            return _finish(fn(Fixtures(spark, sf_dir)))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {k: bind(v) for k, v in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


_ORDERED = """SELECT *, coalesce(ord, array_pos) AS ord_eff,
       row_number() OVER (PARTITION BY user_id ORDER BY coalesce(ord, array_pos), array_pos) - 1 AS list_pos
FROM fx_tasks"""

# ------------------------------------------------------------ tasks


@register(
    "order_tasks",
    duckdb_with(
        ["fx_tasks"],
        f"""SELECT user_id, id, title, priority, due_date, done, ord_eff AS ord, array_pos,
       created_at, completed_at, list_pos
FROM ({_ORDERED})""",
    ),
)
def q_order_tasks(fx: Fixtures) -> DataFrame:
    """O1: back-filled order and list position of every task."""
    return T.order_tasks(fx.tasks())


@register(
    "task_board",
    duckdb_with(
        ["fx_tasks"],
        f"""SELECT user_id, id, title, priority, done, list_pos,
       coalesce(CAST(due_date AS TIMESTAMP) < TIMESTAMP '{_local_midnight_utc(AS_OF, TZ)}', false)
         AND NOT done AS overdue,
       CASE priority WHEN 'high' THEN 'med' WHEN 'med' THEN 'low' WHEN 'low' THEN 'high' END AS next_priority,
       CASE WHEN priority = 'high' THEN 'high' WHEN priority = 'med' THEN 'med' ELSE 'low' END AS priority_class
FROM ({_ORDERED})""",
    ),
)
def q_task_board(fx: Fixtures) -> DataFrame:
    """O1 + P6 + P7 + P8 as of AS_OF in TZ."""
    return T.task_board(fx.tasks(), _ts(AS_OF), TZ)


@register(
    "overdue_tasks",
    duckdb_with(
        ["fx_tasks"],
        f"""SELECT user_id, id, due_date FROM fx_tasks
WHERE CAST(due_date AS TIMESTAMP) < TIMESTAMP '{_local_midnight_utc(AS_OF, TZ)}' AND NOT done""",
    ),
)
def q_overdue_tasks(fx: Fixtures) -> DataFrame:
    """Overdue rows as of AS_OF in TZ."""
    return T.overdue_tasks(fx.tasks(), _ts(AS_OF), TZ).select("user_id", "id", "due_date")


def _sub_list_sql(cond: str) -> str:
    return duckdb_with(
        ["fx_tasks"],
        f"""SELECT user_id, id, title, priority,
       row_number() OVER (PARTITION BY user_id ORDER BY coalesce(ord, array_pos), array_pos) - 1 AS pos
FROM fx_tasks WHERE {cond}""",
    )


@register("pending_tasks", _sub_list_sql("NOT done"))
def q_pending_tasks(fx: Fixtures) -> DataFrame:
    """P5: pending tasks with their place among pending ones."""
    return T.pending_tasks(fx.tasks()).select("user_id", "id", "title", "priority", "pos")


@register("done_tasks", _sub_list_sql("done"))
def q_done_tasks(fx: Fixtures) -> DataFrame:
    """P5: done tasks with their place among done ones."""
    return T.done_tasks(fx.tasks()).select("user_id", "id", "title", "priority", "pos")


_NEW_TASKS = f"""SELECT user_id, id, {duck_trim('title')} AS title, coalesce(priority, 'med') AS priority,
       TRY_CAST(nullif(due, '') AS DATE) AS due_date, false AS done,
       TIMESTAMP '{NOW}' AS created_at, CAST(NULL AS TIMESTAMP) AS completed_at,
       0 AS carried_over_count, seq
FROM fx_raw_tasks WHERE {duck_trim('title')} <> ''"""


@register(
    "new_tasks",
    duckdb_with(["fx_raw_tasks"], f"SELECT * EXCLUDE (seq) FROM ({_NEW_TASKS})"),
)
def q_new_tasks(fx: Fixtures) -> DataFrame:
    """Added tasks validated at NOW."""
    return T.new_tasks(fx.raw_tasks(), _ts(NOW)).drop("seq")


@register(
    "append_tasks",
    duckdb_with(
        ["fx_tasks", "fx_raw_tasks"],
        f"""SELECT n.* EXCLUDE (seq),
       coalesce(e.max_ord, -1) + row_number() OVER (PARTITION BY n.user_id ORDER BY n.seq) AS ord,
       coalesce(e.cnt, 0) + row_number() OVER (PARTITION BY n.user_id ORDER BY n.seq) - 1 AS array_pos
FROM ({_NEW_TASKS}) n
LEFT JOIN (SELECT user_id, max(coalesce(ord, 0)) AS max_ord, count(*) AS cnt FROM fx_tasks GROUP BY user_id) e
  ON n.user_id = e.user_id""",
    ),
)
def q_append_tasks(fx: Fixtures) -> DataFrame:
    """P1 + O2: validated adds appended to the users' lists."""
    return T.append_tasks(fx.tasks(), T.new_tasks(fx.raw_tasks(), _ts(NOW)))


@register(
    "title_edits",
    duckdb_with(
        ["fx_tasks", "fx_title_edits"],
        f"""SELECT e.user_id, e.task_id, e.edit_id, {duck_trim('e.raw_title')} AS title
FROM fx_title_edits e JOIN fx_tasks t ON t.user_id = e.user_id AND t.id = e.task_id
WHERE {duck_trim('e.raw_title')} <> '' AND e.raw_title IS DISTINCT FROM t.title""",
    ),
)
def q_title_edits(fx: Fixtures) -> DataFrame:
    """Accepted title edits."""
    return T.title_edits(fx.tasks(), fx.title_edits())


_FOLD_SQL = """
upd AS (SELECT * FROM fx_task_changes WHERE op = 'update'),
f AS (
  SELECT user_id, task_id,
         max(CASE WHEN set_priority THEN struct_pack(ts := ts, cid := change_id, v := priority) END) AS p,
         max(CASE WHEN set_due THEN struct_pack(ts := ts, cid := change_id, v := due_date) END) AS d,
         max(CASE WHEN set_done THEN struct_pack(ts := ts, cid := change_id, v := done) END) AS dn,
         max(CASE WHEN set_done AND NOT done THEN struct_pack(ts := ts, cid := change_id) END) AS lf
  FROM upd GROUP BY user_id, task_id),
ft AS (
  SELECT u.user_id, u.task_id, min(struct_pack(ts := u.ts, cid := u.change_id)).ts AS first_true
  FROM upd u JOIN f ON f.user_id = u.user_id AND f.task_id = u.task_id
  WHERE u.set_done AND u.done AND (f.lf IS NULL OR struct_pack(ts := u.ts, cid := u.change_id) > f.lf)
  GROUP BY u.user_id, u.task_id),
del AS (SELECT DISTINCT user_id, task_id FROM fx_task_changes WHERE op = 'delete')"""


@register(
    "apply_task_changes",
    duckdb_with(
        ["fx_tasks", "fx_task_changes"],
        f""", {_FOLD_SQL.strip()}
SELECT t.user_id, t.id, t.title,
       CASE WHEN f.p IS NOT NULL THEN f.p.v ELSE t.priority END AS priority,
       CASE WHEN f.d IS NOT NULL THEN f.d.v ELSE t.due_date END AS due_date,
       CASE WHEN f.dn IS NOT NULL THEN f.dn.v ELSE t.done END AS done,
       t.ord, t.array_pos, t.created_at,
       CASE WHEN f.dn IS NULL THEN t.completed_at
            WHEN NOT f.dn.v THEN NULL
            WHEN f.lf IS NOT NULL THEN ft.first_true
            ELSE coalesce(t.completed_at, ft.first_true) END AS completed_at
FROM fx_tasks t
LEFT JOIN f ON f.user_id = t.user_id AND f.task_id = t.id
LEFT JOIN ft ON ft.user_id = t.user_id AND ft.task_id = t.id
WHERE NOT EXISTS (SELECT 1 FROM del WHERE del.user_id = t.user_id AND del.task_id = t.id)""",
    ).replace("\n, upd AS", ",\nupd AS").replace(")\n, upd", "),\nupd"),
)
def q_apply_task_changes(fx: Fixtures) -> DataFrame:
    """M1 + M2: the task snapshot after the change log."""
    return T.apply_task_changes(fx.tasks(), fx.task_changes())


@register(
    "apply_deletes",
    duckdb_with(
        ["fx_tasks", "fx_task_changes"],
        """SELECT t.* FROM fx_tasks t
WHERE NOT EXISTS (SELECT 1 FROM fx_task_changes c
                  WHERE c.op = 'delete' AND c.user_id = t.user_id AND c.task_id = t.id)""",
    ),
)
def q_apply_deletes(fx: Fixtures) -> DataFrame:
    """M2: tasks without the deleted ids."""
    ch = fx.task_changes().where(F.col("op") == "delete")
    return T.apply_deletes(fx.tasks(), ch)


# ------------------------------------------------------------ sessions and counts


@register(
    "task_counts",
    duckdb_with(
        ["fx_tasks"],
        """SELECT user_id, count(*) FILTER (WHERE NOT done) AS pending, count(*) FILTER (WHERE done) AS done
FROM fx_tasks GROUP BY user_id""",
    ),
)
def q_task_counts(fx: Fixtures) -> DataFrame:
    """A1: pending and done counts."""
    return S.task_counts(fx.tasks())


_SESSION_COUNTS = f"""SELECT user_id, count(*) AS total,
       count(*) FILTER (WHERE NOT interrupted) AS focused,
       count(*) FILTER (WHERE interrupted) AS distracted
FROM fx_sessions WHERE date = DATE '{DAY}' GROUP BY user_id"""


@register("session_counts", duckdb_with(["fx_sessions"], _SESSION_COUNTS))
def q_session_counts(fx: Fixtures) -> DataFrame:
    """A2: session counts of DAY."""
    return S.session_counts(fx.sessions(), DAY)


@register(
    "sessions_on_date",
    duckdb_with(["fx_sessions"], f"SELECT * FROM fx_sessions WHERE date = DATE '{DAY}'"),
)
def q_sessions_on_date(fx: Fixtures) -> DataFrame:
    """Sessions of DAY."""
    return S.sessions_on_date(fx.sessions(), DAY)


def _stored_sessions(fx: Fixtures) -> DataFrame:
    """The sessions written by day and read again."""
    sessions = fx.sessions()
    path = f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/sessions-{uuid.uuid4().hex}"
    snapshots.write_sessions(sessions, path)
    return snapshots.read_sessions(fx.spark, path, sessions.schema)


@register(
    "stored_sessions_on_date",
    duckdb_with(["fx_sessions"], f"SELECT * FROM fx_sessions WHERE date = DATE '{DAY}'"),
)
def q_stored_sessions_on_date(fx: Fixtures) -> DataFrame:
    """Sessions of DAY from the snapshot by day; only that day's files are read."""
    return S.sessions_on_date(_stored_sessions(fx), DAY)


@register("stored_session_counts", duckdb_with(["fx_sessions"], _SESSION_COUNTS))
def q_stored_session_counts(fx: Fixtures) -> DataFrame:
    """A2: session counts of DAY from the snapshot by day."""
    return S.session_counts(_stored_sessions(fx), DAY)


@register(
    "session_log",
    duckdb_with(
        ["fx_sessions"],
        """SELECT user_id, id, task_id,
       row_number() OVER (PARTITION BY user_id ORDER BY completed_at, id) - 1 AS log_pos,
       CASE WHEN interrupted THEN 'distracted' ELSE 'focused' END AS label,
       nullif(reflection, '') AS shown_reflection
FROM fx_sessions""",
    ),
)
def q_session_log(fx: Fixtures) -> DataFrame:
    """O6 + P10: the session log, oldest first, with badges."""
    return S.session_log(fx.sessions())


@register(
    "session_titles",
    duckdb_with(
        ["fx_sessions", "fx_tasks"],
        """SELECT s.user_id, s.id, s.task_id, s.duration_minutes, s.reflection, s.interrupted, s.date,
       s.completed_at, coalesce(t.title, '') AS task_title
FROM fx_sessions s LEFT JOIN (SELECT * FROM fx_tasks WHERE NOT done) t
  ON t.user_id = s.user_id AND t.id = s.task_id""",
    ),
)
def q_session_titles(fx: Fixtures) -> DataFrame:
    """Session task titles looked up among pending tasks."""
    pending = fx.tasks().where(~F.col("done")).select("user_id", "id", "title")
    return S.session_titles(fx.sessions(), pending)


# ------------------------------------------------------------ flagship plans

_REVIEW_LINES = """t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(ord, array_pos), array_pos) AS rn
      FROM fx_tasks),
l AS (SELECT user_id,
             string_agg(CASE WHEN done THEN '- ' || coalesce(title, 'null') END, chr(10) ORDER BY rn) AS done_text,
             string_agg(CASE WHEN NOT done THEN '- [' || coalesce(priority, 'null') || '] ' || coalesce(title, 'null') END,
                        chr(10) ORDER BY rn) AS pend_text
      FROM t GROUP BY user_id)"""


@register(
    "day_review",
    duckdb_with(
        ["fx_tasks", "fx_sessions"],
        "",
    )
    + f""", {_REVIEW_LINES},
c AS ({_SESSION_COUNTS})
SELECT coalesce(l.user_id, c.user_id) AS user_id,
       coalesce(c.total, 0) AS sessions_total,
       coalesce(c.focused, 0) AS sessions_focused,
       coalesce(c.distracted, 0) AS sessions_distracted,
       {sql_str(K.REVIEW_HEAD)} || coalesce(l.done_text, {sql_str(K.REVIEW_NONE)})
       || {sql_str(K.REVIEW_PENDING)} || coalesce(l.pend_text, {sql_str(K.REVIEW_NONE)})
       || {sql_str(K.REVIEW_POMODOROS)} || coalesce(c.total, 0) || ' total (' || coalesce(c.focused, 0)
       || ' focused, ' || coalesce(c.distracted, 0) || ' distracted)' || {sql_str(K.REVIEW_TAIL)} AS prompt
FROM l FULL OUTER JOIN c ON l.user_id = c.user_id""",
)
def q_day_review(fx: Fixtures) -> DataFrame:
    """A4 (flagship): end-of-day review prompts for DAY."""
    return R.day_review(fx.tasks(), fx.sessions(), DAY)


@register(
    "kickoff",
    duckdb_with(["fx_tasks"], "")
    + f""", p AS (
  SELECT user_id,
         string_agg(rn || '. [' || coalesce(priority, 'null') || '] ' || coalesce(title, 'null'), chr(10) ORDER BY rn) AS list
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(ord, array_pos), array_pos) AS rn
        FROM fx_tasks WHERE NOT done)
  GROUP BY user_id),
c AS (SELECT user_id, count(*) FILTER (WHERE NOT done) AS n_pending FROM fx_tasks GROUP BY user_id)
SELECT c.user_id, c.n_pending,
       CASE WHEN c.n_pending > 0 THEN {sql_str(K.KICKOFF_HEAD)} || p.list || {sql_str(K.KICKOFF_TAIL)} END AS prompt,
       CASE WHEN c.n_pending = 0 THEN {sql_str(K.KICKOFF_EMPTY)} END AS notice
FROM c LEFT JOIN p ON p.user_id = c.user_id""",
)
def q_kickoff(fx: Fixtures) -> DataFrame:
    """A5: morning kickoff prompts."""
    return R.kickoff(fx.tasks())


@register(
    "apply_reorder",
    duckdb_with(
        ["fx_tasks", "fx_reorders"],
        """, l AS (
  SELECT user_id, id, max(struct_pack(ts := ts, rid := reorder_id, i := i)).i AS new_ord
  FROM (SELECT user_id, ts, reorder_id, unnest(ordered_ids) AS id,
               unnest(generate_series(0, len(ordered_ids) - 1)) AS i FROM fx_reorders)
  GROUP BY user_id, id)
SELECT t.user_id, t.id, t.title, t.priority, t.due_date, t.done, coalesce(l.new_ord, t.ord) AS ord,
       t.array_pos, t.created_at, t.completed_at
FROM fx_tasks t LEFT JOIN l ON l.user_id = t.user_id AND l.id = t.id""",
    ),
)
def q_apply_reorder(fx: Fixtures) -> DataFrame:
    """O3: orders after the reorder calls."""
    return T.apply_reorder(fx.tasks(), fx.reorders())


# a list a user, spliced move by move
_MOVES_SQL = """, mv AS (
  SELECT user_id, drag_id, over_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, move_id) AS k FROM fx_moves
), steps AS (
  SELECT user_id, 0 AS k, list(id ORDER BY coalesce(ord, array_pos), array_pos) AS ids, false AS moved
  FROM fx_tasks WHERE NOT done GROUP BY user_id
  UNION ALL
  SELECT user_id, k,
         CASE WHEN ok THEN list_filter(ids, lambda x: x <> drag_id)[1:t - 1] || [drag_id]
                           || list_filter(ids, lambda x: x <> drag_id)[t:] ELSE ids END,
         moved OR ok
  FROM (SELECT s.user_id, m.k, s.ids, s.moved, m.drag_id, list_position(s.ids, m.over_id) AS t,
               coalesce(m.drag_id <> m.over_id AND list_contains(s.ids, m.drag_id) AND list_contains(s.ids, m.over_id), false) AS ok
        FROM steps s JOIN mv m ON m.user_id = s.user_id AND m.k = s.k + 1)
), placed AS (
  SELECT user_id, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS pos
  FROM (SELECT user_id, arg_max(ids, k) AS ids, arg_max(moved, k) AS moved FROM steps GROUP BY user_id) WHERE moved)
SELECT t.user_id, t.id, t.title, t.priority, t.due_date, t.done, coalesce(p.pos, t.ord) AS ord,
       t.array_pos, t.created_at, t.completed_at
FROM fx_tasks t LEFT JOIN placed p ON p.user_id = t.user_id AND p.id = t.id"""


@register(
    "move_item",
    duckdb_with(["fx_tasks", "fx_moves"], _MOVES_SQL, recursive=True),
)
def q_move_item(fx: Fixtures) -> DataFrame:
    """Orders after up to 50 drags per user within the pending list."""
    return T.move_item(fx.tasks(), fx.moves())


@register(
    "new_sessions",
    duckdb_with(
        ["fx_raw_sessions"],
        f"""SELECT user_id, id, task_id, task_title, duration_minutes, coalesce(reflection, '') AS reflection,
       coalesce(interrupted, false) AS interrupted, CAST(TIMESTAMP '{NOW}' AS DATE) AS date,
       TIMESTAMP '{NOW}' AS completed_at
FROM fx_raw_sessions""",
    ),
)
def q_new_sessions(fx: Fixtures) -> DataFrame:
    """Logged sessions with defaults at NOW."""
    return S.new_sessions(fx.raw_sessions(), _ts(NOW))


# ------------------------------------------------------------ notes

_NOTES = "(SELECT *, created_at AS updated_at FROM fx_notes)"


@register(
    "new_notes",
    duckdb_with(
        ["fx_raw_notes"],
        f"""SELECT user_id, id, {duck_trim('content')} AS content, CAST(NULL AS VARCHAR) AS task_id,
       CAST(NULL AS VARCHAR) AS summary, TIMESTAMP '{NOW}' AS created_at, TIMESTAMP '{NOW}' AS updated_at
FROM fx_raw_notes WHERE {duck_trim('content')} <> ''""",
    ),
)
def q_new_notes(fx: Fixtures) -> DataFrame:
    """Added notes validated at NOW."""
    return N.new_notes(fx.raw_notes(), _ts(NOW))


@register(
    "note_list",
    duckdb_with(
        ["fx_notes"],
        f"""SELECT user_id, id,
       row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, id) - 1 AS list_pos,
       CASE WHEN d < 60 THEN 'just now'
            WHEN d < 3600 THEN CAST(floor(d / 60) AS BIGINT) || 'm ago'
            WHEN d < 86400 THEN CAST(floor(d / 3600) AS BIGINT) || 'h ago'
            ELSE CAST(floor(d / 86400) AS BIGINT) || 'd ago' END AS age
FROM (SELECT *, floor((epoch_us(TIMESTAMP '{NOTES_AS_OF}') - epoch_us(created_at)) / 1000000) AS d FROM fx_notes)""",
    ),
)
def q_note_list(fx: Fixtures) -> DataFrame:
    """O5 + P11: notes newest first with their age at NOTES_AS_OF."""
    return N.note_list(fx.notes(), _ts(NOTES_AS_OF))


@register(
    "search_notes",
    duckdb_with(
        ["fx_notes"],
        f"""SELECT user_id, id FROM fx_notes WHERE contains(lower(content), lower({sql_str(SEARCH_TEXT)}))""",
    ),
)
def q_search_notes(fx: Fixtures) -> DataFrame:
    """Literal case-insensitive search for SEARCH_TEXT."""
    return N.search_notes(fx.notes(), SEARCH_TEXT).select("user_id", "id")


@register(
    "note_counts",
    duckdb_with(["fx_notes"], "SELECT user_id, count(*) AS notes FROM fx_notes GROUP BY user_id"),
)
def q_note_counts(fx: Fixtures) -> DataFrame:
    """A3: notes per user."""
    return S.note_counts(fx.notes())


@register(
    "apply_note_changes",
    duckdb_with(
        ["fx_notes", "fx_note_changes"],
        f""", c AS (
  SELECT user_id, note_id,
         max(CASE WHEN set_content THEN struct_pack(ts := ts, cid := change_id, v := content) END) AS c,
         max(CASE WHEN set_summary THEN struct_pack(ts := ts, cid := change_id, v := summary) END) AS s,
         max(ts) AS upd
  FROM fx_note_changes WHERE op = 'update' GROUP BY user_id, note_id)
SELECT n.user_id, n.id,
       CASE WHEN c.c IS NOT NULL THEN c.c.v ELSE n.content END AS content,
       n.task_id,
       CASE WHEN c.s IS NOT NULL THEN c.s.v ELSE n.summary END AS summary,
       n.created_at, coalesce(c.upd, n.updated_at) AS updated_at
FROM {_NOTES} n LEFT JOIN c ON c.user_id = n.user_id AND c.note_id = n.id
WHERE NOT EXISTS (SELECT 1 FROM fx_note_changes d
                  WHERE d.op = 'delete' AND d.user_id = n.user_id AND d.note_id = n.id)""",
    ),
)
def q_apply_note_changes(fx: Fixtures) -> DataFrame:
    """M3 + M2: notes after the change log."""
    return N.apply_note_changes(fx.notes(), fx.note_changes())


_BLOCKS = f"""b AS (
  SELECT user_id, note_id, line_no, line,
         CASE WHEN {duck_trim('line')} = '' THEN 'blank'
              WHEN starts_with(line, '### ') THEN 'h3'
              WHEN starts_with(line, '## ') THEN 'h2'
              WHEN starts_with(line, '# ') THEN 'h1'
              WHEN regexp_matches(line, '^[-*] ') THEN 'bullet'
              WHEN regexp_matches(line, '^[0-9]+\\. ') THEN 'numbered'
              ELSE 'line' END AS kind
  FROM (SELECT user_id, id AS note_id, unnest(string_split(content, chr(10))) AS line,
               unnest(generate_series(0, len(string_split(content, chr(10))) - 1)) AS line_no
        FROM fx_notes)),
blocks AS (
  SELECT user_id, note_id, line_no, kind,
         CASE kind WHEN 'blank' THEN '' WHEN 'h3' THEN substr(line, 5) WHEN 'h2' THEN substr(line, 4)
                   WHEN 'h1' THEN substr(line, 3) WHEN 'bullet' THEN substr(line, 3) ELSE line END AS text
  FROM b)"""


@register("note_blocks", duckdb_with(["fx_notes"], f", {_BLOCKS}\nSELECT * FROM blocks"))
def q_note_blocks(fx: Fixtures) -> DataFrame:
    """Markdown blocks of every note."""
    return N.note_blocks(fx.notes())


def _duck_spans(src: str, keys: str, pattern: str, italic: bool) -> str:
    it = "WHEN starts_with(piece, '_') AND ends_with(piece, '_') THEN 'italic'" if italic else ""
    closed = "AND ends_with(piece, '**')" if italic else ""
    return f"""pieces AS (
  SELECT {keys}, unnest(regexp_split_to_array(text, '{pattern}')) AS piece,
         unnest(generate_series(0, len(regexp_split_to_array(text, '{pattern}')) - 1)) * 2 AS span_no
  FROM {src} WHERE kind <> 'blank'
  UNION ALL
  SELECT {keys}, unnest(regexp_extract_all(text, '{pattern}')) AS piece,
         unnest(generate_series(0, len(regexp_extract_all(text, '{pattern}')) - 1)) * 2 + 1 AS span_no
  FROM {src} WHERE kind <> 'blank'),
kinds AS (
  SELECT *, CASE WHEN starts_with(piece, '**') {closed} THEN 'bold' {it} END AS kind
  FROM pieces)
SELECT {keys}, span_no, kind,
       CASE WHEN kind = 'bold' THEN (CASE WHEN length(piece) >= 4 THEN substr(piece, 3, length(piece) - 4) ELSE '' END)
            ELSE (CASE WHEN length(piece) >= 2 THEN substr(piece, 2, length(piece) - 2) ELSE '' END) END AS text
FROM kinds WHERE kind IS NOT NULL"""


@register(
    "note_spans",
    duckdb_with(
        ["fx_notes"],
        f", {_BLOCKS},\n" + _duck_spans("blocks", "user_id, note_id, line_no", N.NOTE_INLINE, True),
    ),
)
def q_note_spans(fx: Fixtures) -> DataFrame:
    """Bold and italic spans of every note block."""
    return N.note_spans(N.note_blocks(fx.notes()))


# ------------------------------------------------------------ chat requests

from daybook.operators import chat as C  # noqa: E402

MODELS = {"default": "model-default", "large": "model-large"}


def _duck_js(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'null')"


def _duck_single(prompt: str) -> str:
    return f"to_json([struct_pack(role := 'user', content := {prompt})])::VARCHAR"


_DRIFT = f"""SELECT user_id, ask_id,
       {sql_str(K.DRIFT_HEAD)} || {_duck_js('current_task')} || {sql_str(K.DRIFT_MID)} || {duck_trim('question')}
       || {sql_str(K.DRIFT_TAIL)} AS prompt
FROM fx_asks WHERE {duck_trim('question')} <> ''"""

_SUMMARY = f"""SELECT user_id, id AS note_id, {sql_str(K.SUMMARY_HEAD)} || {_duck_js('content')} AS prompt FROM fx_notes"""

_DRAFT = f"""SELECT user_id, draft_id, context,
       {sql_str(K.DRAFT_HEAD)} || {_duck_js('channel')} || {sql_str(K.DRAFT_CONTEXT)} || context
       || {sql_str(K.DRAFT_TONE)} || coalesce(nullif(tone, ''), {sql_str(K.DEFAULT_TONE)}) || {sql_str(K.DRAFT_TAIL)} AS prompt
FROM fx_drafts WHERE {duck_trim('context')} <> ''"""


@register("drift_requests", duckdb_with(["fx_asks"], _DRIFT))
def q_drift_requests(fx: Fixtures) -> DataFrame:
    """Drift-check prompts."""
    return C.drift_requests(fx.asks())


@register("summary_requests", duckdb_with(["fx_notes"], _SUMMARY))
def q_summary_requests(fx: Fixtures) -> DataFrame:
    """Note summary prompts."""
    return C.summary_requests(fx.notes())


@register("draft_requests", duckdb_with(["fx_drafts"], _DRAFT))
def q_draft_requests(fx: Fixtures) -> DataFrame:
    """Message draft prompts."""
    return C.draft_requests(fx.drafts())


@register(
    "drift_verdicts",
    duckdb_with(
        ["fx_responses"],
        """SELECT request_id, coalesce(starts_with(upper(text), 'DRIFTING'), false) AS drifting
FROM fx_responses WHERE starts_with(request_id, 'drift:')""",
    ),
)
def q_drift_verdicts(fx: Fixtures) -> DataFrame:
    """Verdicts of the drift replies."""
    return C.drift_verdicts(fx.responses().where(F.col("request_id").startswith("drift:")))


_SEGMENTS = f"""seg AS (
  SELECT conv_id, turn, role, text, mode, failed,
         NOT failed AND (role = 'assistant' OR (role = 'user' AND {duck_trim('text')} <> '')) AS recorded,
         sum(CASE WHEN prev_mode IS NOT NULL AND prev_mode IS DISTINCT FROM mode THEN 1 ELSE 0 END)
           OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
  FROM (SELECT *, lag(mode) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_mode FROM fx_chat))"""


@register(
    "history_segments",
    duckdb_with(["fx_chat"], f", {_SEGMENTS}\nSELECT * REPLACE (CAST(seg AS BIGINT) AS seg) FROM seg"),
)
def q_history_segments(fx: Fixtures) -> DataFrame:
    """History segments of every conversation."""
    return C.history_segments(fx.chat())


_FOLLOWUPS = f"""rec AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, seg ORDER BY turn) AS rn FROM seg WHERE recorded),
fu AS (
  SELECT u.conv_id, u.turn, u.seg, count(*) AS n_history,
         to_json(list_concat(list(struct_pack(role := h.role, content := CASE WHEN h.role = 'user' AND h.rn > 1
                                                                         THEN {duck_trim('h.text')} ELSE h.text END)
                                  ORDER BY h.turn),
                             [struct_pack(role := 'user', content := {duck_trim('u.text')})]))::VARCHAR AS messages,
         {duck_trim('u.text')} AS record_text
  FROM seg u JOIN rec h ON h.conv_id = u.conv_id AND h.seg = u.seg AND h.turn < u.turn
  WHERE u.role = 'user' AND {duck_trim('u.text')} <> ''
  GROUP BY u.conv_id, u.turn, u.seg, u.text)"""


@register(
    "chat_history",
    duckdb_with(
        ["fx_chat"],
        f", {_SEGMENTS},\n{_FOLLOWUPS}\nSELECT conv_id, turn, CAST(seg AS BIGINT) AS seg, n_history, messages, record_text FROM fu",
    ),
)
def q_chat_history(fx: Fixtures) -> DataFrame:
    """R2: follow-up requests with their histories."""
    return C.chat_history(fx.chat())


@register(
    "chat_messages",
    duckdb_with(
        ["fx_chat"],
        f""", {_SEGMENTS}
SELECT conv_id, CAST(seg AS BIGINT) AS seg, row_number() OVER (PARTITION BY conv_id, seg ORDER BY turn) - 1 AS place, role,
       CASE WHEN role = 'user' AND row_number() OVER (PARTITION BY conv_id, seg ORDER BY turn) > 1
            THEN {duck_trim('text')} ELSE text END AS content
FROM seg WHERE recorded""",
    ),
)
def q_chat_messages(fx: Fixtures) -> DataFrame:
    """R2: every message of the histories once, by segment and place."""
    return C.chat_log(fx.chat()).messages


@register(
    "chat_followups",
    duckdb_with(
        ["fx_chat"],
        f""", {_SEGMENTS}
SELECT * EXCLUDE (role) FROM (
  SELECT conv_id, turn, CAST(seg AS BIGINT) AS seg, role, {duck_trim('text')} AS record_text,
         CAST(count(*) FILTER (recorded) OVER (PARTITION BY conv_id, seg ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              AS BIGINT) AS n_history
  FROM seg) WHERE role = 'user' AND record_text <> '' AND n_history > 0""",
    ),
)
def q_chat_followups(fx: Fixtures) -> DataFrame:
    """R2: the follow-up requests as ranges over the messages."""
    return C.chat_log(fx.chat()).requests


def _all_requests(fx: Fixtures) -> DataFrame:
    return C.chat_requests(
        kickoff=R.kickoff(fx.tasks()),
        review=R.day_review(fx.tasks(), fx.sessions(), DAY),
        drift=C.drift_requests(fx.asks()),
        summary=C.summary_requests(fx.notes()),
        draft=C.draft_requests(fx.drafts()),
        followup=C.chat_history(fx.chat()),
        models=MODELS,
    )


def _duck_requests() -> str:
    d, l_ = sql_str(MODELS["default"]), sql_str(MODELS["large"])
    sysp = sql_str(K.SYSTEM_PROMPT)

    def row(kind, rid, owner, model, messages, record, note="NULL"):
        return (
            f"SELECT {sql_str(kind + ':')} || {rid} AS request_id, CAST({owner} AS BIGINT) AS owner_id, "
            f"{sql_str(kind)} AS kind, {model} AS model, {K.MAX_TOKENS} AS max_tokens, {sysp} AS system, "
            f"{messages} AS messages, CAST({record} AS VARCHAR) AS record_text, CAST({note} AS VARCHAR) AS note_id"
        )

    return duckdb_with(
        ["fx_tasks", "fx_sessions", "fx_asks", "fx_notes", "fx_drafts", "fx_chat"],
        f""", {_REVIEW_LINES},
c AS ({_SESSION_COUNTS}),
review AS (
SELECT coalesce(l.user_id, c.user_id) AS user_id,
       {sql_str(K.REVIEW_HEAD)} || coalesce(l.done_text, {sql_str(K.REVIEW_NONE)})
       || {sql_str(K.REVIEW_PENDING)} || coalesce(l.pend_text, {sql_str(K.REVIEW_NONE)})
       || {sql_str(K.REVIEW_POMODOROS)} || coalesce(c.total, 0) || ' total (' || coalesce(c.focused, 0)
       || ' focused, ' || coalesce(c.distracted, 0) || ' distracted)' || {sql_str(K.REVIEW_TAIL)} AS prompt
FROM l FULL OUTER JOIN c ON l.user_id = c.user_id),
kick AS (
  SELECT user_id,
         {sql_str(K.KICKOFF_HEAD)} || string_agg(rn || '. [' || coalesce(priority, 'null') || '] ' || coalesce(title, 'null'),
                    chr(10) ORDER BY rn) || {sql_str(K.KICKOFF_TAIL)} AS prompt
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(ord, array_pos), array_pos) AS rn
        FROM fx_tasks WHERE NOT done)
  GROUP BY user_id),
drift AS ({_DRIFT}),
summ AS ({_SUMMARY}),
draft AS ({_DRAFT}),
{_SEGMENTS},
{_FOLLOWUPS}
{row('kickoff', "CAST(user_id AS VARCHAR)", 'user_id', d, _duck_single('prompt'), repr(K.KICKOFF_HISTORY_TEXT))} FROM kick
UNION ALL {row('review', "CAST(user_id AS VARCHAR)", 'user_id', l_, _duck_single('prompt'), repr(K.REVIEW_HISTORY_TEXT))} FROM review
UNION ALL {row('drift', "user_id || ':' || ask_id", 'user_id', d, _duck_single('prompt'), 'NULL')} FROM drift
UNION ALL {row('summary', "user_id || ':' || note_id", 'user_id', d, _duck_single('prompt'), 'NULL', 'note_id')} FROM summ
UNION ALL {row('draft', "user_id || ':' || draft_id", 'user_id', l_, _duck_single('prompt'), 'context')} FROM draft
UNION ALL {row('followup', "CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)", 'conv_id', d, 'messages', 'record_text')} FROM fu""",
    )


_REQUESTS_SQL = _duck_requests()


@register("chat_requests", _REQUESTS_SQL)
def q_chat_requests(fx: Fixtures) -> DataFrame:
    """Every request of the batch (kickoff, review, drift, summary, draft, follow-ups)."""
    return _all_requests(fx)


def _with_requests(extra_fx: list[str], body: str) -> str:
    """The requests SQL as a CTE ``req`` plus more fixtures."""
    head, _, tail = _REQUESTS_SQL.partition("\nSELECT 'kickoff:'")
    union = "SELECT 'kickoff:'" + tail
    more = ",\n".join(f"{n} AS ({duckdb_fixture(n)})" for n in extra_fx)
    return f"{head},\n{more},\nreq AS ({union})\n{body}"


@register(
    "apply_responses",
    _with_requests(
        ["fx_responses"],
        """SELECT r.request_id, r.owner_id, r.kind, m.msg_no, m.role, m.content
FROM req r JOIN fx_responses s ON s.request_id = r.request_id,
     (SELECT 0 AS msg_no, 'user' AS role UNION ALL SELECT 1, 'assistant') m0,
     LATERAL (SELECT m0.msg_no, m0.role, CASE WHEN m0.msg_no = 0 THEN r.record_text ELSE s.text END AS content) m
WHERE r.kind IN ('kickoff', 'review', 'draft', 'followup')""",
    ),
)
def q_apply_responses(fx: Fixtures) -> DataFrame:
    """History rows added by the replies."""
    history, _ = C.apply_responses(_all_requests(fx), fx.responses(), _ts(NOW))
    return history


@register(
    "summary_notes",
    duckdb_with(
        ["fx_notes", "fx_responses"],
        f"""SELECT n.user_id, n.id, n.content, n.task_id, coalesce(s.text, n.summary) AS summary, n.created_at,
       CASE WHEN s.text IS NOT NULL OR s.request_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE n.created_at END AS updated_at
FROM fx_notes n LEFT JOIN fx_responses s ON s.request_id = 'summary:' || n.user_id || ':' || n.id""",
    ),
)
def q_summary_notes(fx: Fixtures) -> DataFrame:
    """R5 + M3: notes after the summary replies are written back."""
    req = C.chat_requests(summary=C.summary_requests(fx.notes()), models=MODELS)
    _, changes = C.apply_responses(req, fx.responses(), _ts(NOW))
    return N.apply_note_changes(fx.notes(), changes)


_RESPONSE_BLOCKS = f"""b AS (
  SELECT request_id, line_no, line,
         CASE WHEN {duck_trim('line')} = '' THEN 'blank'
              WHEN regexp_matches(line, '^#{{1,3}} ') THEN 'heading'
              WHEN regexp_matches(line, '^[-*] ') THEN 'bullet'
              WHEN regexp_matches(line, '^[0-9]+\\. ') THEN 'numbered'
              ELSE 'line' END AS kind
  FROM (SELECT request_id, unnest(string_split(text, chr(10))) AS line,
               unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no
        FROM fx_responses)),
blocks AS (
  SELECT request_id, line_no, kind,
         CASE kind WHEN 'blank' THEN '' WHEN 'heading' THEN regexp_replace(line, '^#+\\s', '')
                   WHEN 'bullet' THEN substr(line, 3) ELSE line END AS text
  FROM b)"""


@register("response_blocks", duckdb_with(["fx_responses"], f", {_RESPONSE_BLOCKS}\nSELECT * FROM blocks"))
def q_response_blocks(fx: Fixtures) -> DataFrame:
    """Line blocks of every reply."""
    return N.response_blocks(fx.responses())


@register(
    "response_spans",
    duckdb_with(
        ["fx_responses"],
        f", {_RESPONSE_BLOCKS},\n" + _duck_spans("(SELECT * FROM blocks WHERE kind <> 'heading')", "request_id, line_no", N.REPLY_INLINE, False),
    ),
)
def q_response_spans(fx: Fixtures) -> DataFrame:
    """Bold spans of every reply line."""
    return N.response_spans(N.response_blocks(fx.responses()))


# ------------------------------------------------------------ time rules

from daybook.operators import timers as TM  # noqa: E402

NUDGE_UNTIL = "2024-01-04 00:00:00"
NUDGE_CLOSE = "2024-01-04 00:10:01"  # the stream's last instant: the watermark then passes NUDGE_UNTIL
EOD_TZ = "Asia/Kolkata"  # a half-hour offset east of UTC
EOD_WINDOW_MIN = 60
TIMER_AS_OF = "2024-01-01 12:00:00"


@register(
    "idle_nudges",
    duckdb_with(
        ["fx_activity"],
        f""", a AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts FROM fx_activity),
f AS (SELECT user_id, ts,
             make_timestamp(((epoch_us(ts) + {K.IDLE_THRESHOLD_MINUTES * 60_000_000} + {K.IDLE_CHECK_MINUTES * 60_000_000} - 1)
                             // {K.IDLE_CHECK_MINUTES * 60_000_000}) * {K.IDLE_CHECK_MINUTES * 60_000_000}) AS first_fire,
             least(coalesce(next_ts, TIMESTAMP '{NUDGE_UNTIL}'), TIMESTAMP '{NUDGE_UNTIL}') AS stop
      FROM a)
SELECT user_id, ts AS idle_since,
       unnest(generate_series(first_fire, stop, INTERVAL {K.IDLE_THRESHOLD_MINUTES} MINUTE)) AS fire_ts
FROM f WHERE first_fire <= stop""",
    ),
)
def q_idle_nudges(fx: Fixtures) -> DataFrame:
    """Idle nudges up to NUDGE_UNTIL (45 min threshold, 5 min checks)."""
    return TM.idle_nudges(fx.activity(), _ts(NUDGE_UNTIL))


def _eod_sql(tz: str, window: int) -> str:
    return duckdb_with(
        ["fx_ticks"],
        f""", l AS (SELECT user_id, ts, timezone({sql_str(tz)}, ts AT TIME ZONE 'UTC') AS lt FROM fx_ticks)
SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS fire_ts
FROM l WHERE hour(lt) = {K.EOD_HOUR} AND minute(lt) < {window}
GROUP BY user_id, CAST(ts AS DATE)""",
    )


@register("eod_reminders", _eod_sql("UTC", 1))
def q_eod_reminders(fx: Fixtures) -> DataFrame:
    """Reminders at 17:00 UTC (the app's minute rule), once per UTC day."""
    return TM.eod_reminders(fx.ticks(), "UTC", K.EOD_HOUR, 1)


@register("eod_reminders_window", _eod_sql(EOD_TZ, EOD_WINDOW_MIN))
def q_eod_reminders_window(fx: Fixtures) -> DataFrame:
    """Reminders in the local 17:00 hour of EOD_TZ, once per UTC day."""
    return TM.eod_reminders(fx.ticks(), EOD_TZ, K.EOD_HOUR, EOD_WINDOW_MIN)


_US = 1_000_000


def _timer_fold(until: str = "") -> str:
    """DuckDB: the timer's state after every event of a user (recursive, one event a step)."""
    return f""", ev AS (
  SELECT e.user_id, e.seq, e.ts, epoch_us(e.ts) AS t, e.action, e.task_id,
         CAST(coalesce(nullif(s.work_mins, 0), {K.DEFAULT_WORK_MINS}) * 60 AS BIGINT) AS ws,
         CAST(coalesce(nullif(s.break_mins, 0), {K.DEFAULT_BREAK_MINS}) * 60 AS BIGINT) AS bs,
         row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.seq) AS rn
  FROM fx_timer_events e LEFT JOIN fx_settings s ON s.user_id = e.user_id {until}),
f AS (
  SELECT user_id, 0::BIGINT AS rn, 'idle' AS phase, NULL::VARCHAR AS task, 0::BIGINT AS rem,
         NULL::BIGINT AS run, NULL::BIGINT AS stop, false AS logged, NULL::BIGINT AS seq, NULL::TIMESTAMP AS ts,
         0::BIGINT AS ws, 0::BIGINT AS bs
  FROM (SELECT DISTINCT user_id FROM ev)
  UNION ALL
  SELECT user_id, rn,
         CASE WHEN go THEN CASE action WHEN 'start' THEN 'work' WHEN 'pause' THEN 'paused' WHEN 'resume' THEN 'work'
                                       WHEN 'stop' THEN 'idle' ELSE 'break' END ELSE ph END,
         CASE WHEN go AND action = 'start' THEN task_id ELSE task END,
         CASE WHEN go AND action = 'start' THEN ws WHEN go AND action = 'pause' THEN clock
              WHEN go AND action = 'stop' THEN 0 ELSE rm END,
         CASE WHEN go AND action IN ('start', 'resume') THEN t WHEN go AND action IN ('pause', 'stop') THEN NULL ELSE rn_us END,
         CASE WHEN go AND action = 'checkin' THEN t + bs * {_US} WHEN go AND action = 'stop' THEN NULL ELSE stop END,
         go AND action = 'checkin', seq, ts, ws, bs
  FROM (
    SELECT *, CASE action WHEN 'start' THEN ph = 'idle' AND coalesce(task_id, '') <> ''
                          WHEN 'pause' THEN ph = 'work' AND rn_us IS NOT NULL
                          WHEN 'resume' THEN ph = 'paused'
                          WHEN 'stop' THEN ph <> 'idle'
                          WHEN 'checkin' THEN ph = 'work' AND rn_us IS NULL ELSE false END AS go
    FROM (
      SELECT *, CASE WHEN phase = 'break' AND t >= stop THEN 'idle' ELSE phase END AS ph,
             CASE WHEN phase = 'work' AND clock = 0 THEN NULL ELSE run END AS rn_us,
             CASE WHEN phase = 'work' AND run IS NOT NULL AND clock = 0 THEN 0 ELSE rem END AS rm
      FROM (SELECT f.user_id, e.rn, f.phase, f.task, f.rem, f.run, f.stop, e.seq, e.ts, e.t, e.action, e.task_id, e.ws, e.bs,
                   greatest(f.rem - (e.t - f.run) // {_US}, 0) AS clock
            FROM f JOIN ev e ON e.user_id = f.user_id AND e.rn = f.rn + 1))))"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


_TIMER_SESSIONS = _recursive(
    duckdb_with(
        ["fx_timer_events", "fx_settings"],
        _timer_fold()
        + """
SELECT user_id, seq, task AS task_id, CAST(ws // 60 AS INTEGER) AS duration_minutes, '' AS reflection, false AS interrupted,
       CAST(ts AS DATE) AS date, ts AS completed_at
FROM f WHERE logged""",
    )
)


@register("timer_sessions", _TIMER_SESSIONS)
def q_timer_sessions(fx: Fixtures) -> DataFrame:
    """T4: sessions completed by the timer events (settings per user, defaults 25/5)."""
    return TM.timer_sessions(fx.timer_events(), fx.settings())


@register(
    "timer_notices",
    _recursive(
        duckdb_with(
            ["fx_timer_events", "fx_settings"],
            _timer_fold()
            + f""",
said AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, seq) AS n FROM f WHERE logged)
SELECT user_id, seq, ts, {sql_str(K.LOGGED_TITLE)} AS title, n || ' today. Take a ' || CAST(bs // 60 AS VARCHAR) || '-min break.' AS body FROM said
UNION ALL
SELECT user_id, seq, make_timestamp(epoch_us(ts) + bs * {_US}) AS ts, {sql_str(K.BREAK_OVER_TITLE)} AS title, {sql_str(K.BREAK_OVER_TEXT)} AS body
FROM said s WHERE NOT EXISTS (
  SELECT 1 FROM fx_timer_events e WHERE e.user_id = s.user_id AND e.action = 'stop' AND (e.ts > s.ts OR (e.ts = s.ts AND e.seq > s.seq))
    AND epoch_us(e.ts) < epoch_us(s.ts) + s.bs * {_US})""",
        )
    ),
)
def q_timer_notices(fx: Fixtures) -> DataFrame:
    """T4: the notices of the timer, at check-in and at the end of a break."""
    return TM.timer_notices(fx.timer_events(), fx.settings())


@register(
    "timer_status",
    _recursive(
        duckdb_with(
            ["fx_timer_events", "fx_settings"],
            _timer_fold(f"WHERE e.ts <= TIMESTAMP '{TIMER_AS_OF}'")
            + f""",
last AS (
  SELECT *, greatest(rem - (now - run) // {_US}, 0) AS clock
  FROM (SELECT *, epoch_us(TIMESTAMP '{TIMER_AS_OF}') AS now FROM f
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) = 1)),
u AS (SELECT user_id FROM fx_timer_events UNION SELECT user_id FROM fx_settings),
st AS (
  SELECT u.user_id,
         CASE WHEN l.phase IS NULL OR (l.phase = 'break' AND l.now >= l.stop) THEN 'idle' ELSE l.phase END AS phase,
         l.phase = 'work' AND (l.run IS NULL OR l.clock = 0) AS waiting, l.task, l.clock, l.rem, l.stop, l.now, l.bs,
         CAST(coalesce(nullif(s.work_mins, 0), {K.DEFAULT_WORK_MINS}) * 60 AS BIGINT) AS ws
  FROM u LEFT JOIN last l ON l.user_id = u.user_id LEFT JOIN fx_settings s ON s.user_id = u.user_id),
r AS (
  SELECT *, CAST(CASE phase WHEN 'work' THEN CASE WHEN waiting THEN 0 ELSE clock END WHEN 'paused' THEN rem
                            WHEN 'break' THEN greatest(bs - (now - (stop - bs * {_US})) // {_US}, 0) ELSE ws END AS BIGINT) AS remaining_s
  FROM st)
SELECT user_id, phase,
       CASE phase WHEN 'idle' THEN 'Ready' WHEN 'work' THEN 'Focus' WHEN 'paused' THEN 'Paused' ELSE 'Break' END AS label,
       remaining_s,
       lpad(CAST(remaining_s // 60 AS VARCHAR), CAST(greatest(2, length(CAST(remaining_s // 60 AS VARCHAR))) AS INTEGER), '0') || ':'
         || lpad(CAST(remaining_s % 60 AS VARCHAR), 2, '0') AS display,
       CASE WHEN phase <> 'idle' THEN task END AS task_id,
       coalesce(phase = 'work' AND waiting, false) AS awaiting_checkin
FROM r""",
        )
    ),
)
def q_timer_status(fx: Fixtures) -> DataFrame:
    """T5: timer phase and display per user at TIMER_AS_OF."""
    return TM.timer_status(fx.timer_events(), TIMER_AS_OF, fx.settings())


# ------------------------------------------------------------ workspace files

import uuid  # noqa: E402

from daybook.session import ensure_checkpoint_dir  # noqa: E402
from daybook.sources import workspace as W  # noqa: E402


def _workspace_inputs(fx: Fixtures) -> tuple[DataFrame, DataFrame, DataFrame]:
    pending = fx.tasks().where(~F.col("done")).select("user_id", "id", "title")
    return fx.tasks(), fx.notes(), S.session_titles(fx.sessions(), pending)


def _roundtrip(fx: Fixtures) -> W.Workspaces:
    """S2 then S1 through a folder under the session's checkpoint directory; every query writes its own."""
    path = f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/workspaces-{uuid.uuid4().hex}"
    W.write_workspaces(*_workspace_inputs(fx), path, compression="lz4")
    return W.read_workspaces(fx.spark, path, multiline=False)


def _json_object(fields: dict[str, str]) -> str:
    """DuckDB: a JSON object without its null fields."""
    parts = ", ".join(f"""'"{k}":' || {v}""" for k, v in fields.items())
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


def _json_text(c: str) -> str:
    return f"CAST(to_json({c}) AS VARCHAR)"


def _json_time(c: str) -> str:
    return f"""'"' || strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ') || '"'"""


def _json_day(c: str) -> str:
    return f"""'"' || strftime({c}, '%Y-%m-%d') || '"'"""


def _json_array(name: str, source: str, order: str, fields: dict[str, str]) -> str:
    return f"{name} AS (SELECT user_id, string_agg({_json_object(fields)}, ',' ORDER BY {order}) AS j FROM {source} GROUP BY user_id)"


_DOCUMENTS_SQL = duckdb_with(
    ["fx_tasks", "fx_notes", "fx_sessions"],
    f""", titled AS (
  SELECT s.*, coalesce(t.title, '') AS task_title
  FROM fx_sessions s LEFT JOIN (SELECT * FROM fx_tasks WHERE NOT done) t ON t.user_id = s.user_id AND t.id = s.task_id),
{_json_array("t", "fx_tasks", "array_pos", {
    "id": _json_text("id"), "title": _json_text("title"), "priority": _json_text("priority"),
    "dueDate": _json_day("due_date"), "done": "done", "order": "ord", "createdAt": _json_time("created_at"),
    "completedAt": _json_time("completed_at"), "carriedOverCount": "0"})},
{_json_array("n", "fx_notes", "created_at DESC, id", {
    "id": _json_text("id"), "content": _json_text("content"), "taskId": _json_text("task_id"),
    "summary": _json_text("summary"), "createdAt": _json_time("created_at"), "updatedAt": _json_time("created_at")})},
{_json_array("s", "titled", "completed_at, id", {
    "id": _json_text("id"), "taskId": _json_text("task_id"), "taskTitle": _json_text("task_title"),
    "durationMinutes": "duration_minutes", "reflection": _json_text("reflection"), "interrupted": "interrupted",
    "date": _json_day("date"), "completedAt": _json_time("completed_at")})},
u AS (SELECT user_id FROM t UNION SELECT user_id FROM n UNION SELECT user_id FROM s)
SELECT u.user_id, '{{"user_id":' || u.user_id || ',"tasks":[' || coalesce(t.j, '') || '],"notes":[' || coalesce(n.j, '')
       || '],"focusSessions":[' || coalesce(s.j, '') || '],"dailyPlans":[]}}' AS document
FROM u LEFT JOIN t ON t.user_id = u.user_id LEFT JOIN n ON n.user_id = u.user_id LEFT JOIN s ON s.user_id = u.user_id""",
)


@register("write_workspaces", _DOCUMENTS_SQL)
def q_write_workspaces(fx: Fixtures) -> DataFrame:
    """One workspace JSON document per user (tasks, notes, sessions in stored order)."""
    return W.workspace_documents(*_workspace_inputs(fx))


@register("read_workspaces", duckdb_with(["fx_tasks"], "SELECT * REPLACE (CAST(ord AS DOUBLE) AS ord), 0 AS carried_over_count FROM fx_tasks"))
def q_read_workspaces(fx: Fixtures) -> DataFrame:
    """S1 after S2: the tasks read back from the written documents."""
    return _roundtrip(fx).tasks


@register("corrupt_workspaces", duckdb_with(["fx_tasks", "fx_notes", "fx_sessions"], """
SELECT user_id, 1 AS broken FROM fx_tasks UNION SELECT user_id, 1 FROM fx_notes UNION SELECT user_id, 1 FROM fx_sessions"""))
def q_corrupt_workspaces(fx: Fixtures) -> DataFrame:
    """Documents that were cut off while written, as the import reports them (one for every user)."""
    path = f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    docs = W.workspace_documents(*_workspace_inputs(fx))
    docs.select(F.expr("substring(document, 1, length(document) - 1)").alias("value")).write.text(path, compression="lz4")
    return W.read_workspaces(fx.spark, path, multiline=False).corrupt.select("user_id", F.lit(1).alias("broken"))


@register(
    "read_workspaces_notes",
    duckdb_with(
        ["fx_notes"],
        """SELECT user_id, id, content, task_id, summary, created_at, created_at AS updated_at,
       row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, id) - 1 AS array_pos
FROM fx_notes""",
    ),
)
def q_read_workspaces_notes(fx: Fixtures) -> DataFrame:
    """S1 after S2: the notes read back, newest first."""
    return _roundtrip(fx).notes


@register(
    "read_workspaces_sessions",
    duckdb_with(
        ["fx_sessions", "fx_tasks"],
        """SELECT s.user_id, s.id, s.task_id, coalesce(t.title, '') AS task_title,
       CAST(s.duration_minutes AS DOUBLE) AS duration_minutes, s.reflection, s.interrupted, s.date, s.completed_at,
       row_number() OVER (PARTITION BY s.user_id ORDER BY s.completed_at, s.id) - 1 AS array_pos
FROM fx_sessions s LEFT JOIN (SELECT * FROM fx_tasks WHERE NOT done) t ON t.user_id = s.user_id AND t.id = s.task_id""",
    ),
)
def q_read_workspaces_sessions(fx: Fixtures) -> DataFrame:
    """S1 after S2: the sessions read back, oldest first."""
    return _roundtrip(fx).sessions


# ------------------------------------------------------------ single-rule columns

from daybook.functions import next_priority, note_age, priority_class, session_label  # noqa: E402


@register(
    "next_priority",
    duckdb_with(
        ["fx_tasks"],
        """SELECT user_id, id, priority,
       CASE priority WHEN 'high' THEN 'med' WHEN 'med' THEN 'low' WHEN 'low' THEN 'high' END AS next_priority
FROM fx_tasks""",
    ),
)
def q_next_priority(fx: Fixtures) -> DataFrame:
    """The priority a click moves to."""
    return fx.tasks().select("user_id", "id", "priority", next_priority("priority").alias("next_priority"))


@register(
    "priority_class",
    duckdb_with(
        ["fx_tasks"],
        """SELECT user_id, id, priority,
       CASE WHEN priority = 'high' THEN 'high' WHEN priority = 'med' THEN 'med' ELSE 'low' END AS priority_class
FROM fx_tasks""",
    ),
)
def q_priority_class(fx: Fixtures) -> DataFrame:
    """The badge class of the priority."""
    return fx.tasks().select("user_id", "id", "priority", priority_class("priority").alias("priority_class"))


@register(
    "session_labels",
    duckdb_with(
        ["fx_sessions"],
        """SELECT user_id, id, CASE WHEN interrupted THEN 'distracted' ELSE 'focused' END AS label,
       nullif(reflection, '') AS shown_reflection
FROM fx_sessions""",
    ),
)
def q_session_labels(fx: Fixtures) -> DataFrame:
    """P10: session badges and the reflection shown."""
    return fx.sessions().select(
        "user_id", "id", session_label("interrupted").alias("label"),
        F.nullif(F.col("reflection"), F.lit("")).alias("shown_reflection"),
    )


@register(
    "note_ages",
    duckdb_with(
        ["fx_notes"],
        f"""SELECT user_id, id,
       CASE WHEN d < 60 THEN 'just now'
            WHEN d < 3600 THEN CAST(floor(d / 60) AS BIGINT) || 'm ago'
            WHEN d < 86400 THEN CAST(floor(d / 3600) AS BIGINT) || 'h ago'
            ELSE CAST(floor(d / 86400) AS BIGINT) || 'd ago' END AS age
FROM (SELECT *, floor((epoch_us(TIMESTAMP '{NOTES_AS_OF}') - epoch_us(created_at)) / 1000000) AS d FROM fx_notes)""",
    ),
)
def q_note_ages(fx: Fixtures) -> DataFrame:
    """Note ages at NOTES_AS_OF."""
    return fx.notes().select("user_id", "id", note_age("created_at", _ts(NOTES_AS_OF)).alias("age"))


# ------------------------------------------------------------ streams run to completion

from daybook import streaming as ST  # noqa: E402

STREAM_DELAY = "10 minutes"


def _write_slices(df: DataFrame, path: str, slices: int, files: int) -> None:
    """Write ``df`` in time order: each slice's files are newer than the one before's."""
    at = F.unix_micros("ts")
    cuts = df.select(F.percentile_approx(at, [i / slices for i in range(1, slices)])).first()[0] or []
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds, bounds[1:]):
        part = df if lo is None else df.where(at > lo)
        part = part if hi is None else part.where(at <= hi)
        part.repartition(files).write.mode("append").parquet(path)


def _closing_row(df: DataFrame, ts: str) -> DataFrame:
    """A row of user -1 at ``ts``, so that the watermark passes every real row."""
    known = {"user_id": F.lit(CLOSING_USER), "ts": F.lit(ts), "seq": F.lit(-1)}
    return df.sparkSession.range(1).select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


CLOSING_USER = -1
STREAM_SLICES, SLICE_FILES = 2, 4


def _run_stream(fx: Fixtures, name: str, build, rows: DataFrame, close: str) -> DataFrame:
    """Stream ``rows`` through ``build`` in several micro-batches and read the result back.

    The rows go to the shared checkpoint folder in time slices, a slice a
    trigger, and a closing row at ``close`` ends the stream, so the result holds
    all that the batch job gives.  Input and state are deleted afterwards.
    """
    spark = fx.spark
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex}"
    _write_slices(rows, f"{base}/in", STREAM_SLICES, SLICE_FILES)
    _closing_row(rows, close).write.mode("append").parquet(f"{base}/in")
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", SLICE_FILES).parquet(f"{base}/in")
    out = build(source)
    q = (
        out.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/state")
        .outputMode("append")
        .start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    _delete(spark, f"{base}/in")
    _delete(spark, f"{base}/state")
    return spark.read.schema(out.schema).parquet(f"{base}/out").where(F.col("user_id") != CLOSING_USER)


STREAM_END = "2025-01-01 00:00:00"  # after all events


@register("idle_nudges_stream", _ORACLE["idle_nudges"])
def q_idle_nudges_stream(fx: Fixtures) -> DataFrame:
    """Idle nudges from the activity stream, up to NUDGE_UNTIL."""
    got = _run_stream(
        fx, "nudges", lambda a: ST.idle_nudges_stream(a, delay=STREAM_DELAY), fx.activity(), NUDGE_CLOSE
    )
    return got.where(F.col("fire_ts") <= _ts(NUDGE_UNTIL))


@register("eod_reminders_stream", _ORACLE["eod_reminders"])
def q_eod_reminders_stream(fx: Fixtures) -> DataFrame:
    """T3 on a stream: the earliest 17:00 UTC hit per user and UTC day."""
    return _run_stream(
        fx, "eod", lambda ticks: ST.eod_reminders_stream(ticks, "UTC", K.EOD_HOUR, 1), fx.ticks(), STREAM_END
    )


@register("timer_sessions_stream", _TIMER_SESSIONS)
def q_timer_sessions_stream(fx: Fixtures) -> DataFrame:
    """T4 on a stream: all sessions checked in (settings as a static table)."""
    settings = fx.settings()
    return _run_stream(
        fx,
        "timer",
        lambda events: ST.timer_sessions_stream(events, settings, delay=STREAM_DELAY),
        fx.timer_events(),
        STREAM_END,
    )
