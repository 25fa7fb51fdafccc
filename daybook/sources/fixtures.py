"""Stand-in inputs derived from the shared test tables.

Each fixture only maps test-table rows into the schema a job expects; none of
them does any of the jobs' work.  The SQL text is shared by Spark (tables bound
as DataFrame arguments) and DuckDB (tables are views of the same name), except
for two time rescalings that need engine-specific functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Users of notes: about seven documents each, so their number grows with the table.
# Note ids are numbered within a user, so different users have equal note ids.
_NOTE_USERS = "(SELECT CAST(floor(max(doc_id) / 7.0) AS BIGINT) + 1 FROM {documents})"
# All events, spread over all orders / documents by multiplying the event id.
_EVENT_ORDERS = """(SELECT *, (event_id * 7) % (SELECT max(o_orderkey) + 1 FROM {orders}) AS okey FROM {events}) e
JOIN {orders} o ON o.o_orderkey = e.okey"""
_DOCS = f"""(SELECT *, doc_id % {_NOTE_USERS} AS user_id,
        concat('n', CAST(CAST(floor(doc_id / {_NOTE_USERS}) AS BIGINT) AS STRING)) AS note_id FROM {{documents}})"""
_N_CONV = "(SELECT max(conv_id) + 1 FROM {conversations})"
_TURNS = """(SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i,
        count(*) OVER (PARTITION BY conv_id) AS n FROM {conversations})"""
_MODE = """CASE CAST(floor(turn / (2.0 + conv_id % 9)) AS BIGINT) % 3
            WHEN 0 THEN 'kickoff' WHEN 1 THEN 'review' ELSE 'draft' END"""

# Code points above U+00FF are written into the text as characters (Spark's
# chr() only covers 0-255).
_PLACED_ORDERS = """SELECT o_custkey AS user_id, concat('t', CAST(o_orderkey AS STRING)) AS id,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM {orders}"""

FIXTURE_SQL: dict[str, str] = {
    "fx_tasks": """
SELECT o_custkey AS user_id,
       concat('t', CAST(o_orderkey AS STRING)) AS id,
       concat('Order ', CAST(o_orderkey AS STRING)) AS title,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'med' ELSE 'low' END AS priority,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS due_date,
       o_orderstatus = 'F' AS done,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            ELSE CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS BIGINT) END AS ord,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS BIGINT) AS array_pos,
       o_orderdate - INTERVAL 7 DAY AS created_at,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS completed_at
FROM {orders}""",
    "fx_sessions": f"""
SELECT o.o_custkey AS user_id,
       concat('s', CAST(e.event_id AS STRING)) AS id,
       concat('t', CAST(o.o_orderkey AS STRING)) AS task_id,
       25 AS duration_minutes,
       CASE WHEN event_type = 'view' THEN 'blocked' ELSE '' END AS reflection,
       event_type = 'error' AS interrupted,
       CAST(e.ts AS DATE) AS date,
       e.ts AS completed_at
FROM {_EVENT_ORDERS}""",
    "fx_notes": f"""
SELECT user_id,
       note_id AS id,
       concat('# Note ', CAST(doc_id AS STRING), chr(10), chr(10), '1. **bold** and _it_', chr(10),
              replace(text, '. ', concat('.', chr(10), '- '))) AS content,
       CAST(NULL AS STRING) AS task_id,
       CAST(NULL AS STRING) AS summary,
       TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 MINUTE AS created_at
FROM {_DOCS}""",
    "fx_task_changes": f"""
SELECT o.o_custkey AS user_id, e.event_id AS change_id, e.ts,
       concat('t', CAST(o.o_orderkey AS STRING)) AS task_id,
       CASE WHEN e.event_type = 'error' AND e.event_id % 4 = 0 THEN 'delete' ELSE 'update' END AS op,
       e.event_type = 'click' AS set_priority,
       CASE WHEN e.event_type = 'click' THEN 'high' END AS priority,
       e.event_type = 'view' AS set_due,
       CAST(NULL AS DATE) AS due_date,
       e.event_type IN ('signup', 'purchase') AS set_done,
       CASE WHEN e.event_type = 'signup' THEN true WHEN e.event_type = 'purchase' THEN false END AS done
FROM {_EVENT_ORDERS}""",
    # every turn, some untrimmed, some with a failed call, and a blank user turn beside each user turn
    "fx_chat": f"""
SELECT conv_id, turn * 2 AS turn, role,
       CASE WHEN role = 'user' AND conv_id % 2 = 0 THEN concat('  ', text, '\u00a0') ELSE text END AS text,
       {_MODE} AS mode, (conv_id + CAST(floor(turn / 2.0) AS BIGINT)) % 11 = 3 AS failed
FROM {{conversations}}
UNION ALL
SELECT conv_id, turn * 2 + 1, role, ' \u00a0', {_MODE}, false
FROM {{conversations}} WHERE role = 'user'""",
    "fx_ticks": """
SELECT user_id, ts FROM {events}""",
    # a real title for every order, and blank titles beside some; a few due dates are no dates
    "fx_raw_tasks": """
SELECT o_custkey AS user_id,
       concat('n', CAST(o_orderkey AS STRING)) AS id,
       concat('\t New ', CAST(o_orderkey AS STRING), '\ufeff') AS title,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL
            WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' ELSE 'low' END AS priority,
       CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 13 = 1 THEN 'soon'
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS due,
       o_orderkey * 2 AS seq
FROM {orders}
UNION ALL
SELECT o_custkey, concat('b', CAST(o_orderkey AS STRING)), '\u00a0 \u3000', NULL, NULL, o_orderkey * 2 + 1
FROM {orders} WHERE o_orderstatus = 'P'""",
    "fx_title_edits": """
SELECT o_custkey AS user_id,
       concat('t', CAST(o_orderkey AS STRING)) AS task_id,
       o_orderkey AS edit_id,
       CASE WHEN o_orderstatus = 'F' THEN concat('Order ', CAST(o_orderkey AS STRING))
            WHEN o_orderstatus = 'O' THEN concat(' Order ', CAST(o_orderkey AS STRING), '\u00a0')
            ELSE concat('Renamed ', CAST(o_orderkey AS STRING)) END AS raw_title
FROM {orders}
UNION ALL
SELECT o_custkey, concat('t', CAST(o_orderkey AS STRING)), -1 - o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN '\u2028\u00a0\u200b' ELSE '\u2028\u00a0' END
FROM {orders} WHERE o_orderstatus = 'P'""",
    # every document, and blank notes beside the short ones
    "fx_raw_notes": f"""
SELECT user_id, concat('m', CAST(doc_id AS STRING)) AS id, concat('\ufeff ', text, '\n') AS content
FROM {_DOCS}
UNION ALL
SELECT user_id, concat('b', CAST(doc_id AS STRING)), '\u00a0\n \u3000' FROM {_DOCS} WHERE n_chars < 400""",
    "fx_note_changes": f"""
SELECT d.user_id, e.event_id AS change_id, e.ts,
       d.note_id,
       CASE WHEN e.event_type = 'error' AND e.event_id % 5 = 0 THEN 'delete' ELSE 'update' END AS op,
       e.event_type = 'view' AS set_content,
       CASE WHEN e.event_type = 'view' THEN concat('## Edited ', CAST(e.event_id AS STRING)) END AS content,
       e.event_type IN ('click', 'purchase') AS set_summary,
       CASE WHEN e.event_type = 'click' THEN concat('- ', e.props) END AS summary
FROM (SELECT *, (event_id * 13) % (SELECT max(doc_id) + 1 FROM {{documents}}) AS dkey FROM {{events}}) e
JOIN {_DOCS} d ON d.doc_id = e.dkey""",
    # 0 to 50 moves a user, among all tasks of the user: open and done ones, some onto themselves
    "fx_moves": f"""
SELECT u.user_id, TIMESTAMP '1999-01-01 00:00:00' AS ts, k.move_id, a.id AS drag_id, b.id AS over_id
FROM (SELECT o_custkey AS user_id, count(*) AS n FROM {{orders}} GROUP BY o_custkey) u
JOIN (VALUES {", ".join(f"({i})" for i in range(1, 51))}) AS k(move_id) ON k.move_id <= u.user_id % 51
JOIN ({_PLACED_ORDERS}) a ON a.user_id = u.user_id AND a.i = (k.move_id * 7 + u.user_id) % u.n
JOIN ({_PLACED_ORDERS}) b ON b.user_id = u.user_id AND b.i = (k.move_id * k.move_id * 3 + 1) % u.n""",
    "fx_raw_sessions": """
SELECT user_id, concat('r', CAST(event_id AS STRING)) AS id,
       concat('t', CAST(event_id * 7 AS STRING)) AS task_id,
       '' AS task_title, 25 AS duration_minutes,
       CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN '' ELSE props END AS reflection,
       CASE event_type WHEN 'error' THEN true WHEN 'purchase' THEN NULL ELSE false END AS interrupted
FROM {events}""",
    "fx_asks": f"""
SELECT o.o_custkey AS user_id, e.event_id AS ask_id,
       concat('Order ', CAST(o.o_orderkey AS STRING)) AS current_task,
       CASE WHEN e.event_type = 'view' THEN ' \u00a0' ELSE concat(' ', e.props, ' ') END AS question
FROM {_EVENT_ORDERS}""",
    # every document, and blank contexts beside the short ones
    "fx_drafts": f"""
SELECT user_id, doc_id AS draft_id,
       CASE lang WHEN 'en' THEN 'slack' WHEN 'de' THEN 'email' ELSE 'text' END AS channel,
       text AS context,
       CASE lang WHEN 'fr' THEN 'warm' WHEN 'es' THEN '' END AS tone
FROM {_DOCS}
UNION ALL
SELECT user_id, -1 - doc_id, 'slack', '\u3000', '' FROM {_DOCS} WHERE n_chars < 400""",
    # a reply for every customer (twice), every document (twice), every user turn and every question
    "fx_responses": f"""
SELECT concat('kickoff:', CAST(c.c_custkey AS STRING)) AS request_id,
       concat('## Plan **now**', chr(10), '1. **First** thing', chr(10), '- plain bullet', chr(10),
              '* **bold** bullet', chr(10), '**open', chr(10), v.text) AS text
FROM (SELECT *, c_custkey % {_N_CONV} AS k FROM {{customer}}) c
JOIN {_TURNS} v ON v.conv_id = c.k AND v.i = c.c_custkey % v.n
UNION ALL
SELECT concat('review:', CAST(c.c_custkey AS STRING)),
       concat('### Today', chr(10), '#### not a heading', chr(10), '-no space', chr(10), v.text)
FROM (SELECT *, (c_custkey * 3) % {_N_CONV} AS k FROM {{customer}}) c
JOIN {_TURNS} v ON v.conv_id = c.k AND v.i = (c.c_custkey * 3) % v.n
UNION ALL
SELECT concat('summary:', CAST(d.user_id AS STRING), ':', d.note_id), concat('- ', v.text)
FROM (SELECT *, doc_id % {_N_CONV} AS k FROM {_DOCS}) d
JOIN {_TURNS} v ON v.conv_id = d.k AND v.i = d.doc_id % v.n
UNION ALL
SELECT concat('draft:', CAST(d.user_id AS STRING), ':', CAST(d.doc_id AS STRING)), concat('Option A: ', v.text)
FROM (SELECT *, (doc_id * 7) % {_N_CONV} AS k FROM {_DOCS}) d
JOIN {_TURNS} v ON v.conv_id = d.k AND v.i = (d.doc_id * 7) % v.n
UNION ALL
SELECT concat('followup:', CAST(conv_id AS STRING), ':', CAST(turn * 2 AS STRING)), concat('Re: ', text)
FROM {{conversations}} WHERE role = 'user'
UNION ALL
SELECT concat('drift:', CAST(o.o_custkey AS STRING), ':', CAST(event_id AS STRING)),
       CASE event_id % 4 WHEN 0 THEN 'DRIFTING: refocus' WHEN 1 THEN ' DRIFTING: space first'
                         WHEN 2 THEN 'drifting - lower case' ELSE 'ON TRACK: fine' END
FROM {_EVENT_ORDERS}""",
    "fx_settings": """
SELECT c_custkey AS user_id,
       CASE c_custkey % 4 WHEN 0 THEN 120 WHEN 1 THEN 50 END AS work_mins,
       CASE c_custkey % 3 WHEN 0 THEN 10 END AS break_mins
FROM {customer}""",
}

# time rescalings: activity at 1/10 and timer clicks at 1/30 of the time since 2024-01-01
SPARK_ONLY_SQL: dict[str, str] = {
    # the rows of fx_moves from one pass over the orders: a user's order keys as an array, null ones first
    "fx_moves": """
SELECT user_id, TIMESTAMP '1999-01-01 00:00:00' AS ts, move_id,
       concat('t', CAST(CASE WHEN a >= n_null THEN get(keys, CAST(a - n_null AS INT)) END AS STRING)) AS drag_id,
       concat('t', CAST(CASE WHEN b >= n_null THEN get(keys, CAST(b - n_null AS INT)) END AS STRING)) AS over_id
FROM (SELECT user_id, keys, n - size(keys) AS n_null, move_id,
             (move_id * 7 + user_id) % n AS a, (move_id * move_id * 3 + 1) % n AS b
      FROM (SELECT o_custkey AS user_id, count(*) AS n, sort_array(collect_list(o_orderkey)) AS keys
            FROM {orders} WHERE o_custkey % 51 >= 1 GROUP BY o_custkey)
      LATERAL VIEW explode(sequence(1, CAST(user_id % 51 AS INT))) AS move_id)""",
    "fx_reorders": """
SELECT o_custkey AS user_id, o_orderkey AS reorder_id, CAST(o_orderdate AS TIMESTAMP) AS ts,
       array(concat('t', CAST(o_orderkey AS STRING)), concat('t', CAST(o_orderkey + 1 AS STRING)), 'tnone',
             concat('t', CAST(o_orderkey AS STRING))) AS ordered_ids
FROM {orders}""",
    "fx_activity": """
SELECT user_id,
       timestamp_micros(1704067200000000 + (unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 10) AS ts
FROM {events}""",
    "fx_timer_events": """
SELECT user_id, event_id AS seq,
       timestamp_micros(1704067200000000 + (unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 30) AS ts,
       CASE event_type WHEN 'signup' THEN 'start' WHEN 'purchase' THEN 'pause' WHEN 'view' THEN 'resume'
            WHEN 'click' THEN 'checkin' ELSE 'stop' END AS action,
       concat('t', CAST(event_id * 7 AS STRING)) AS task_id
FROM {events}""",
}

DUCKDB_ONLY_SQL: dict[str, str] = {
    "fx_reorders": """
SELECT o_custkey AS user_id, o_orderkey AS reorder_id, o_orderdate AS ts,
       [concat('t', CAST(o_orderkey AS STRING)), concat('t', CAST(o_orderkey + 1 AS STRING)), 'tnone',
        concat('t', CAST(o_orderkey AS STRING))] AS ordered_ids
FROM orders""",
    "fx_activity": """
SELECT user_id,
       make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 10) AS ts
FROM events""",
    "fx_timer_events": """
SELECT user_id, event_id AS seq,
       make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 30) AS ts,
       CASE event_type WHEN 'signup' THEN 'start' WHEN 'purchase' THEN 'pause' WHEN 'view' THEN 'resume'
            WHEN 'click' THEN 'checkin' ELSE 'stop' END AS action,
       concat('t', CAST(event_id * 7 AS STRING)) AS task_id
FROM events""",
}

_TABLES = ("orders", "events", "documents", "conversations", "customer")


def duckdb_fixture(name: str) -> str:
    """The fixture's SQL for DuckDB, where the test tables are views."""
    if name in DUCKDB_ONLY_SQL:
        return DUCKDB_ONLY_SQL[name]
    sql = FIXTURE_SQL[name]
    for t in _TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql


def duckdb_with(names: list[str], body: str, recursive: bool = False) -> str:
    """``WITH fx_a AS (...), fx_b AS (...) <body>`` for the DuckDB oracle."""
    ctes = ",\n".join(f"{n} AS ({duckdb_fixture(n)})" for n in names)
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


class Fixtures:
    """Loads the test tables of one scale-factor folder and builds fixtures lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def get(self, name: str) -> DataFrame:
        sql = SPARK_ONLY_SQL.get(name) or FIXTURE_SQL[name]
        args = {t: self.table(t) for t in _TABLES if "{" + t + "}" in sql}
        df = self.spark.sql(sql, **args)
        # the jobs work on instants (timestamp, session time zone UTC)
        for f in df.schema.fields:
            if isinstance(f.dataType, TimestampNTZType):
                df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
        return df

    def tasks(self) -> DataFrame:
        return self.get("fx_tasks")

    def sessions(self) -> DataFrame:
        return self.get("fx_sessions")

    def notes(self) -> DataFrame:
        return self.get("fx_notes").withColumn("updated_at", F.col("created_at"))

    def raw_tasks(self) -> DataFrame:
        return self.get("fx_raw_tasks")

    def title_edits(self) -> DataFrame:
        return self.get("fx_title_edits")

    def raw_notes(self) -> DataFrame:
        return self.get("fx_raw_notes")

    def note_changes(self) -> DataFrame:
        return self.get("fx_note_changes")

    def reorders(self) -> DataFrame:
        return self.get("fx_reorders")

    def moves(self) -> DataFrame:
        return self.get("fx_moves")

    def raw_sessions(self) -> DataFrame:
        return self.get("fx_raw_sessions")

    def asks(self) -> DataFrame:
        return self.get("fx_asks")

    def drafts(self) -> DataFrame:
        return self.get("fx_drafts")

    def responses(self) -> DataFrame:
        return self.get("fx_responses")

    def settings(self) -> DataFrame:
        return self.get("fx_settings")

    def task_changes(self) -> DataFrame:
        return self.get("fx_task_changes")

    def chat(self) -> DataFrame:
        return self.get("fx_chat")

    def ticks(self) -> DataFrame:
        return self.get("fx_ticks")

    def activity(self) -> DataFrame:
        return self.get("fx_activity")

    def timer_events(self) -> DataFrame:
        return self.get("fx_timer_events")
