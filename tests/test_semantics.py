"""Hand-worked cases, one per quirk of the app's rules."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from daybook import constants as K
from daybook.functions import contains_literal_ci, drift_verdict, js_trim, mmss, next_priority, note_age, priority_class
from daybook.operators import chat as C
from daybook.operators import notes as N
from daybook.operators import sessions as S
from daybook.operators import tasks as T
from daybook.plans import review as R
from daybook.schemas import MOVES, REORDERS, TASK_CHANGES, TASKS
from daybook.sources import workspace as W

UTC = dt.timezone.utc


def ts(s):
    return dt.datetime.fromisoformat(s)


def task(uid, tid, title="x", done=False, ord_=None, pos=0, due=None, prio="med", completed=None):
    return (uid, tid, title, prio, due, done, ord_, pos, ts("2024-01-01 00:00:00"), completed)


def tasks_df(spark, rows):
    return spark.createDataFrame(rows, TASKS)


# ---------------------------------------------------------------- text


def test_js_trim_unicode_white_space(spark):
    rows = [("  a b﻿",), ("　 ",), ("​z",), ("\t\n x \r",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(js_trim("s")).collect()]
    assert got == ["a b", "", "​z", "x"]


def test_search_is_literal_and_case_insensitive(spark):
    df = spark.createDataFrame([("50% off",), ("5x off",), ("a_b",), ("Über",)], "c string")
    assert df.where(contains_literal_ci("c", "%")).count() == 1
    assert df.where(contains_literal_ci("c", "a_b")).count() == 1
    assert df.where(contains_literal_ci("c", "über")).count() == 1
    assert df.where(contains_literal_ci("c", "")).count() == 4


def test_mmss_does_not_cut_minutes(spark):
    got = [r[0] for r in spark.createDataFrame([(7200,), (65,), (0,)], "s long").select(mmss("s")).collect()]
    assert got == ["120:00", "01:05", "00:00"]


def test_priority_cycle_and_class(spark):
    df = spark.createDataFrame([("high",), ("med",), ("low",), ("urgent",), (None,)], "p string")
    got = [(r[0], r[1]) for r in df.select(next_priority("p"), priority_class("p")).collect()]
    assert got == [("med", "high"), ("low", "med"), ("high", "low"), (None, "low"), (None, "low")]


def test_drift_verdicts(spark):
    df = spark.createDataFrame([("DRIFTING: x",), (" DRIFTING",), ("drifting",), ("ON TRACK",), (None,)], "t string")
    got = [r[0] for r in df.select(drift_verdict("t")).collect()]
    assert got == [True, False, True, False, False]


def test_note_age(spark):
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp")
    rows = [(ts("2024-01-02 00:00:30"),), (ts("2024-01-01 23:59:01"),), (ts("2024-01-01 23:00:00"),),
            (ts("2024-01-01 00:00:00"),), (ts("2023-12-01 00:00:00"),)]
    got = [r[0] for r in spark.createDataFrame(rows, "c timestamp").select(note_age("c", as_of)).collect()]
    assert got == ["just now", "just now", "1h ago", "1d ago", "32d ago"]


# ---------------------------------------------------------------- tasks


def test_missing_order_and_collisions(spark):
    # positions 0..3; task b has no order (-> 1), collides with c's stored 1
    rows = [task(1, "a", ord_=5, pos=0), task(1, "b", pos=1), task(1, "c", ord_=1, pos=2), task(1, "d", ord_=0, pos=3)]
    got = [r.id for r in T.order_tasks(tasks_df(spark, rows)).orderBy("list_pos").collect()]
    assert got == ["d", "b", "c", "a"]


def test_new_tasks_blank_titles_and_defaults(spark):
    raw = spark.createDataFrame(
        [(1, "n1", " ﻿", None, "", 1), (1, "n2", " hi　", None, "2024-05-01", 2), (1, "n3", "x", "high", None, 3)],
        "user_id long, id string, title string, priority string, due string, seq long",
    )
    out = {r.id: r for r in T.new_tasks(raw, F.lit("2024-01-01 00:00:00").cast("timestamp")).collect()}
    assert set(out) == {"n2", "n3"}
    assert out["n2"].title == "hi" and out["n2"].priority == "med" and out["n2"].due_date == dt.date(2024, 5, 1)
    assert out["n3"].due_date is None and out["n3"].done is False


def test_append_counts_missing_order_as_zero(spark):
    existing = tasks_df(spark, [task(1, "a", pos=0), task(1, "b", pos=1)])  # both without order
    new = spark.createDataFrame([(1, "n1", 1), (1, "n2", 2), (2, "m", 1)], "user_id long, id string, seq long")
    out = {r.id: (r.ord, r.array_pos) for r in T.append_tasks(existing, new).collect()}
    assert out == {"n1": (1, 2), "n2": (2, 3), "m": (0, 0)}


def test_title_edit_rules(spark):
    t = tasks_df(spark, [task(1, "a", title="Plan")])
    edits = spark.createDataFrame(
        [(1, "a", 1, "Plan"), (1, "a", 2, " Plan "), (1, "a", 3, " "), (1, "a", 4, "New"), (1, "zz", 5, "X")],
        "user_id long, task_id string, edit_id long, raw_title string",
    )
    got = sorted((r.edit_id, r.title) for r in T.title_edits(t, edits).collect())
    assert got == [(2, "Plan"), (4, "New")]


def test_overdue_west_and_east_of_utc(spark):
    rows = [task(1, "today", due=dt.date(2024, 3, 10)), task(1, "past", due=dt.date(2024, 3, 9)),
            task(1, "none"), task(1, "done", due=dt.date(2024, 3, 1), done=True)]
    df = tasks_df(spark, rows)
    as_of = F.lit("2024-03-10 12:00:00").cast("timestamp")  # Tokyo: 21:00, New York: 08:00
    west = {r.id for r in T.overdue_tasks(df, as_of, "America/New_York").collect()}
    east = {r.id for r in T.overdue_tasks(df, as_of, "Asia/Tokyo").collect()}
    utc = {r.id for r in T.overdue_tasks(df, as_of, "UTC").collect()}
    assert west == {"today", "past"}  # due today is already overdue west of UTC
    assert east == {"past"}
    assert utc == {"past"}


def test_reorder_unknown_and_repeated_ids(spark):
    t = tasks_df(spark, [task(1, "a", ord_=0, pos=0), task(1, "b", ord_=1, pos=1), task(1, "c", ord_=2, pos=2)])
    r = spark.createDataFrame([(1, ts("2024-01-01 00:00:00"), ["c", "zz", "a", "c"])], REORDERS)
    out = {x.id: x.ord for x in T.apply_reorder(t, r).collect()}
    assert out == {"a": 2, "b": 1, "c": 3}


def _moves(spark, rows):
    return spark.createDataFrame([(u, ts("2024-01-01 00:00:00"), d, o) for u, d, o in rows], MOVES)


def test_move_down_up_self_and_done(spark):
    base = [task(1, "a", ord_=0, pos=0), task(1, "b", ord_=1, pos=1), task(1, "c", ord_=2, pos=2),
            task(1, "d", ord_=3, pos=3), task(1, "x", ord_=1, pos=4, done=True)]
    t = tasks_df(spark, base)

    def order(moves):
        out = T.move_item(t, _moves(spark, moves))
        return [r.id for r in T.pending_tasks(out).orderBy("pos").collect()], {r.id: r.ord for r in out.collect()}

    assert order([(1, "a", "c")])[0] == ["b", "c", "a", "d"]
    assert order([(1, "d", "b")])[0] == ["a", "d", "b", "c"]
    assert order([(1, "b", "b")])[1] == {r[1]: r[6] for r in base}  # self: no-op
    assert order([(1, "a", "x")])[1] == {r[1]: r[6] for r in base}  # done target: no-op
    assert order([(1, "a", "c")])[1]["x"] == 1  # done task keeps its (colliding) order


def _log(spark, rows):
    full = []
    for r in rows:
        d = dict(set_title=None, title=None, set_priority=False, priority=None, set_due=False, due_date=None,
                 set_done=False, done=None)
        d.update(r)
        full.append((1, d["cid"], ts(d["ts"]), d["task"], d.get("op", "update"), d["set_title"], d["title"],
                     d["set_priority"], d["priority"], d["set_due"], d["due_date"], d["set_done"], d["done"]))
    return spark.createDataFrame(full, TASK_CHANGES)


def test_null_patch_clears_and_absent_keeps(spark):
    t = tasks_df(spark, [task(1, "a", due=dt.date(2024, 1, 5), prio="low")])
    log = _log(spark, [dict(cid=1, ts="2024-01-02 00:00:00", task="a", set_due=True, due_date=None),
                       dict(cid=2, ts="2024-01-03 00:00:00", task="a", set_priority=True, priority="high")])
    r = T.apply_task_changes(t, log).first()
    assert r.due_date is None and r.priority == "high"


def test_toggle_twice_and_completed_at(spark):
    t = tasks_df(spark, [task(1, "a"), task(1, "b", done=True, completed=ts("2023-12-31 00:00:00")),
                         task(1, "c", done=True, completed=ts("2023-12-31 00:00:00"))])
    log = _log(spark, [
        dict(cid=1, ts="2024-01-02 00:00:00", task="a", set_done=True, done=True),
        dict(cid=2, ts="2024-01-03 00:00:00", task="a", set_done=True, done=True),
        dict(cid=3, ts="2024-01-02 00:00:00", task="b", set_done=True, done=False),
        dict(cid=4, ts="2024-01-04 00:00:00", task="b", set_done=True, done=True),
        dict(cid=5, ts="2024-01-05 00:00:00", task="b", set_done=True, done=True),
        dict(cid=6, ts="2024-01-02 00:00:00", task="c", set_done=True, done=True),
    ])
    out = {r.id: (r.done, r.completed_at) for r in T.apply_task_changes(t, log).collect()}
    assert out["a"] == (True, ts("2024-01-02 00:00:00"))  # first true sets it, second keeps it
    assert out["b"] == (True, ts("2024-01-04 00:00:00"))  # cleared by false, set by first true after
    assert out["c"] == (True, ts("2023-12-31 00:00:00"))  # stored value kept


def test_hot_task_keeps_one_row_of_bounded_size(spark):
    t = tasks_df(spark, [task(1, "a"), task(1, "b")])
    log = _log(spark, [
        dict(cid=i, ts=f"2024-01-02 {i // 60:02}:{i % 60:02}:00", task="a", set_done=True, done=i != 700)
        for i in range(1, 1200)
    ] + [dict(cid=2000, ts="2024-01-03 00:00:00", task="b", set_done=True, done=True)])
    df = T.apply_task_changes(t, log)
    out = {r.id: (r.done, r.completed_at) for r in df.collect()}
    assert out == {"a": (True, ts("2024-01-02 11:41:00")), "b": (True, ts("2024-01-03 00:00:00"))}
    # no group is collected
    assert "collect_" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_delete_then_update_and_unknown_ids(spark):
    t = tasks_df(spark, [task(1, "a"), task(1, "b")])
    log = _log(spark, [dict(cid=1, ts="2024-01-02 00:00:00", task="a", op="delete"),
                       dict(cid=2, ts="2024-01-03 00:00:00", task="a", set_priority=True, priority="high"),
                       dict(cid=3, ts="2024-01-03 00:00:00", task="zz", set_priority=True, priority="high")])
    out = {r.id for r in T.apply_task_changes(t, log).collect()}
    assert out == {"b"}


def test_review_and_kickoff_texts(spark):
    t = tasks_df(spark, [task(1, "a", title="Write", ord_=1, pos=0, prio="high"),
                         task(1, "b", title="Read", ord_=0, pos=1, done=True),
                         task(2, "c", title="Done", done=True)])
    sessions = spark.createDataFrame(
        [(1, "s1", "a", "", 25, "", False, dt.date(2024, 1, 2), ts("2024-01-02 10:00:00")),
         (1, "s2", "a", "", 25, "", True, dt.date(2024, 1, 2), ts("2024-01-02 11:00:00")),
         (3, "s3", "q", "", 25, "", False, dt.date(2024, 1, 2), ts("2024-01-02 11:00:00"))],
        "user_id long, id string, task_id string, task_title string, duration_minutes int, reflection string,"
        " interrupted boolean, date date, completed_at timestamp",
    )
    rev = {r.user_id: r.prompt for r in R.day_review(t, sessions, "2024-01-02").collect()}
    assert rev[1] == (K.REVIEW_HEAD + "- Read" + K.REVIEW_PENDING + "- [high] Write" + K.REVIEW_POMODOROS
                      + "2 total (1 focused, 1 distracted)" + K.REVIEW_TAIL)
    assert rev[2].startswith(K.REVIEW_HEAD + "- Done" + K.REVIEW_PENDING + "none")
    assert rev[3] == (K.REVIEW_HEAD + "none" + K.REVIEW_PENDING + "none" + K.REVIEW_POMODOROS
                      + "1 total (1 focused, 0 distracted)" + K.REVIEW_TAIL)
    kick = {r.user_id: (r.prompt, r.notice) for r in R.kickoff(t).collect()}
    assert kick[1] == (K.KICKOFF_HEAD + "1. [high] Write" + K.KICKOFF_TAIL, None)
    assert kick[2] == (None, K.KICKOFF_EMPTY)


# ---------------------------------------------------------------- notes


def test_note_blocks_and_spans(spark):
    text = "# Title\n\n## Sub\n### Small\n- item _it_\n* **b** x\n12. step **z**\n****\n####x"
    notes = spark.createDataFrame([(1, "n", text)], "user_id long, id string, content string")
    blocks = [(r.kind, r.text) for r in N.note_blocks(notes).orderBy("line_no").collect()]
    assert blocks == [("h1", "Title"), ("blank", ""), ("h2", "Sub"), ("h3", "Small"), ("bullet", "item _it_"),
                      ("bullet", "**b** x"), ("numbered", "12. step **z**"), ("line", "****"), ("line", "####x")]
    spans = [(r.line_no, r.kind, r.text) for r in N.note_spans(N.note_blocks(notes)).orderBy("line_no", "span_no").collect()]
    assert spans == [(4, "italic", "it"), (5, "bold", "b"), (6, "bold", "z"), (7, "bold", "")]


def test_response_blocks_keep_plain_bullets(spark):
    r = spark.createDataFrame([("r", "## Head\n- plain\n* **b** rest\n1. one\n")], "request_id string, text string")
    got = [(x.kind, x.text) for x in N.response_blocks(r).orderBy("line_no").collect()]
    assert got == [("heading", "Head"), ("bullet", "plain"), ("bullet", "**b** rest"), ("numbered", "1. one"),
                   ("blank", "")]


def test_note_changes_update_time(spark):
    notes = spark.createDataFrame(
        [(1, "n", "c", None, None, ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:00"))],
        "user_id long, id string, content string, task_id string, summary string, created_at timestamp, updated_at timestamp",
    )
    log = spark.createDataFrame(
        [(1, 1, ts("2024-01-03 00:00:00"), "n", "update", False, None, True, "- s"),
         (1, 2, ts("2024-01-04 00:00:00"), "n", "update", False, None, False, None)],
        "user_id long, change_id long, ts timestamp, note_id string, op string, set_content boolean, content string,"
        " set_summary boolean, summary string",
    )
    r = N.apply_note_changes(notes, log).first()
    assert r.summary == "- s" and r.updated_at == ts("2024-01-04 00:00:00") and r.content == "c"


# ---------------------------------------------------------------- chat


def test_chat_segments_and_followups(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "p", "kickoff"), (1, 1, "assistant", "r", "kickoff"), (1, 2, "user", " more ", "kickoff"),
         (1, 3, "assistant", "r2", "kickoff"), (1, 4, "user", "d", "draft"), (1, 5, "assistant", "r3", "draft"),
         (1, 6, "user", " ", "draft")],
        "conv_id long, turn long, role string, text string, mode string",
    )
    segs = [r.seg for r in C.history_segments(turns).orderBy("turn").collect()]
    assert segs == [0, 0, 0, 0, 1, 1, 1]
    fu = C.chat_history(turns).collect()
    assert [(r.turn, r.n_history) for r in fu] == [(2, 2)]
    assert json.loads(fu[0].messages) == [
        {"role": "user", "content": "p"}, {"role": "assistant", "content": "r"}, {"role": "user", "content": "more"}]


def test_draft_default_tone_and_blank_context(spark):
    drafts = spark.createDataFrame(
        [(1, 1, "slack", "ship it", ""), (1, 2, "email", "　", "warm"), (1, 3, "text", "x", "warm")],
        "user_id long, draft_id long, channel string, context string, tone string",
    )
    out = {r.draft_id: r.prompt for r in C.draft_requests(drafts).collect()}
    assert set(out) == {1, 3}
    assert out[1] == K.DRAFT_HEAD + "slack" + K.DRAFT_CONTEXT + "ship it" + K.DRAFT_TONE + K.DEFAULT_TONE + K.DRAFT_TAIL


def test_responses_record_literals(spark):
    req = C.chat_requests(
        kickoff=spark.createDataFrame([(1, "P")], "user_id long, prompt string"),
        review=spark.createDataFrame([(1, "R")], "user_id long, prompt string"),
        models={"default": "m1", "large": "m2"},
    )
    models = {r.kind: r.model for r in req.collect()}
    assert models == {"kickoff": "m1", "review": "m2"}
    resp = spark.createDataFrame([("kickoff:1", "ok"), ("review:1", "fine")], "request_id string, text string")
    hist, _ = C.apply_responses(req, resp, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    got = sorted((r.kind, r.msg_no, r.content) for r in hist.collect())
    assert got == [("kickoff", 0, K.KICKOFF_HISTORY_TEXT), ("kickoff", 1, "ok"),
                   ("review", 0, K.REVIEW_HISTORY_TEXT), ("review", 1, "fine")]


# ---------------------------------------------------------------- workspace files


def test_read_good_corrupt_empty_and_missing_order(spark):
    d = tempfile.mkdtemp(prefix="ws-")
    good = {"tasks": [{"id": "a", "title": "A", "priority": "med", "dueDate": None, "done": False,
                       "createdAt": "2024-01-01T00:00:00.000Z", "completedAt": None, "carriedOverCount": 0},
                      {"id": "b", "title": "B", "priority": "high", "dueDate": "2024-02-01", "done": True, "order": 0,
                       "createdAt": "2024-01-01T00:00:00.000Z", "completedAt": "2024-01-02T10:00:00.000Z"}],
            "notes": [], "focusSessions": [], "dailyPlans": []}
    with open(os.path.join(d, "7.json"), "w") as f:
        json.dump(good, f, indent=2)
    with open(os.path.join(d, "8.json"), "w") as f:
        f.write("{ not json")
    with open(os.path.join(d, "9.json"), "w") as f:
        json.dump({"tasks": [], "notes": [], "focusSessions": [], "dailyPlans": []}, f)
    tasks, notes, sessions, corrupt, _ = W.read_workspaces(spark, d, multiline=True)
    rows = {r.id: r for r in tasks.collect()}
    assert set(rows) == {"a", "b"} and rows["a"].ord is None and rows["b"].ord == 0 and rows["a"].user_id == 7
    assert rows["b"].due_date == dt.date(2024, 2, 1) and rows["b"].completed_at == ts("2024-01-02 10:00:00")
    # a is back-filled with its position 0 and ties with b (stored 0): the stable sort keeps a first
    assert [r.id for r in T.order_tasks(tasks).orderBy("list_pos").collect()] == ["a", "b"]
    assert [r.user_id for r in corrupt.collect()] == [8]
    assert notes.count() == 0 and sessions.count() == 0


def test_import_keeps_odd_values_and_unused_fields(spark, tmp_path):
    d = tmp_path / "ws"
    d.mkdir()
    doc = {
        "tasks": [
            {"id": "a", "title": "A", "order": 1.5, "done": False, "carriedOverCount": 3},
            {"id": "b", "title": "B", "order": 0.5, "done": "maybe", "dueDate": "soon"},
            {"id": "c", "title": 7},
        ],
        "notes": [{"id": "n", "content": "x", "createdAt": "never"}],
        "focusSessions": [{"id": "s", "taskId": "a", "durationMinutes": 1.5}, {"id": "r", "durationMinutes": 25}],
        "dailyPlans": [{"day": 1}],
    }
    (d / "7.json").write_text(json.dumps(doc, indent=2))
    (d / "8.json").write_text("{ not json")
    (d / "9.json").write_text(" \n")
    w = W.read_workspaces(spark, str(d), multiline=True)
    tasks = {r.id: r for r in w.tasks.collect()}
    assert {k: (r.ord, r.array_pos) for k, r in tasks.items()} == {"a": (1.5, 0), "b": (0.5, 1), "c": (None, 2)}
    assert tasks["a"].carried_over_count == 3 and tasks["b"].due_date is None and tasks["c"].title == "7"
    assert [r.content for r in w.notes.collect()] == ["x"]
    assert {r.id: r.duration_minutes for r in w.sessions.collect()} == {"s": 1.5, "r": 25.0}
    # the report does not depend on the columns read
    assert sorted(r.user_id for r in w.corrupt.select("user_id").collect()) == [8, 9]
    assert sorted(r.user_id for r in w.corrupt.collect()) == [8, 9]
    # a rewrite passes the unused fields through
    out = str(tmp_path / "out")
    W.write_workspaces(w.tasks, w.notes, w.sessions, out, w.plans)
    again = W.read_workspaces(spark, out, multiline=False)
    assert {r.id: r.carried_over_count for r in again.tasks.collect()} == {"a": 3, "b": 0, "c": 0}
    assert [json.loads(r.daily_plans) for r in again.plans.collect()] == [[{"day": 1}]]
    assert {r.id: r.duration_minutes for r in again.sessions.collect()} == {"s": 1.5, "r": 25.0}


def test_only_strict_documents_are_read(spark, tmp_path):
    good = '{"user_id": %d, "tasks": [{"id": "t", "title": "A"}], "notes": [{"id": "n"}], "focusSessions": []}'
    texts = {
        1: good % 1, 2: good % 2 + " trailing", 3: (good % 3).replace('"', "'"), 4: "NaN", 5: good % 5 + "]", 6: good % 6 + "]}",
        7: good % 7 + ", " + good % 7, 8: "[" + good % 8 + "]", 9: '"text"', 10: "null", 11: (good % 11).replace("[]", "[],"),
        12: (good % 12).replace("[]", "NaN"), 13: " \t" + good % 13 + " \n", 14: good % 14 + '],"end":1}', 15: "// note " + good % 15,
        16: (good % 16).replace("}", "}", 1)[:-1], 17: '{"tasks": [], "tasks": [{"id": "last"}]}', 18: "\ufeff" + good % 18,
    }
    for u, text in texts.items():
        (tmp_path / f"{u}.json").write_text(text)
    w = W.read_workspaces(spark, str(tmp_path))
    assert sorted((r.user_id, r.id) for r in w.tasks.collect()) == [(1, "t"), (13, "t"), (17, "last")]
    assert sorted(r.user_id for r in w.notes.collect()) == [1, 13]
    assert sorted(r.user_id for r in w.corrupt.collect()) == sorted(set(texts) - {1, 13, 17})


def test_order_values_survive_import_and_writing(spark, tmp_path):
    doc = {"tasks": [{"id": "a", "title": 'say "order":2.0,', "order": 0.5}, {"id": "b", "title": "B", "order": 2}, {"id": "c", "order": -1e9},
                     {"id": "d", "order": None}, {"id": "e"}]}
    (tmp_path / "7.json").write_text(json.dumps(doc))
    w = W.read_workspaces(spark, str(tmp_path))
    assert {r.id: r.ord for r in w.tasks.collect()} == {"a": 0.5, "b": 2, "c": -1e9, "d": 0, "e": None}
    new = spark.createDataFrame([(7, "n", 0), (7, "m", 1)], "user_id long, id string, seq long")
    assert {r.id: r.ord for r in T.append_tasks(w.tasks, new).collect()} == {"n": 3, "m": 4}
    text = W.workspace_documents(w.tasks, w.notes, w.sessions).first().document
    assert '"order":2,' in text and '"order":0.5,' in text
    assert {t["id"]: (t.get("order"), t.get("title")) for t in json.loads(text)["tasks"]} == {
        "a": (0.5, 'say "order":2.0,'), "b": (2, "B"), "c": (-1e9, None), "d": (0, None), "e": (None, None)
    }


def test_documents_are_shuffled_once_and_parsed_once(spark, tmp_path):
    """Both failed before: records went through a shuffle by chunk and one by user, a document through several parses."""
    at = ts("2024-01-01 00:00:00")
    tasks = spark.createDataFrame(
        [(u, f"t{i}", "A", "low", None, False, None, i, at, None) for u in (1, 2) for i in range(12)],
        "user_id long, id string, title string, priority string, due_date date, done boolean, ord long, array_pos long, created_at timestamp, completed_at timestamp")
    notes = spark.createDataFrame(
        [(1, i, f"{i}{k}", None, None, at + dt.timedelta(minutes=m), at) for i, k, m in (("a", 0, 0), ("b", 0, 1), ("a", 1, 2))] + [(3, "n", "x", None, None, None, at)],
        "user_id long, id string, content string, task_id string, summary string, created_at timestamp, updated_at timestamp")
    sessions = spark.createDataFrame(
        [(2, f"s{i}", "t0", 25, "", False, dt.date(2024, 1, 1), at - dt.timedelta(minutes=i), "A") for i in range(3)],
        "user_id long, id string, task_id string, duration_minutes int, reflection string, interrupted boolean, date date, completed_at timestamp, task_title string")
    docs = W.workspace_documents(tasks, notes, sessions)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    read = {r.user_id: json.loads(r.document) for r in docs.collect()}
    assert [t["id"] for t in read[1]["tasks"]] == [f"t{i}" for i in range(12)] and read[3]["tasks"] == []
    # newest first; each place of a repeated id takes every record of the id
    assert [n["content"] for n in read[1]["notes"]] == ["a0", "a1", "b0", "a0", "a1"] and len(read[3]["notes"]) == 1
    assert [s["id"] for s in read[2]["focusSessions"]] == ["s2", "s1", "s0"]
    W.write_workspaces(tasks, notes, sessions, str(tmp_path / "w"), compression="lz4")
    w = W.read_workspaces(spark, str(tmp_path / "w"), multiline=False)
    assert w.tasks.count() == 24 and w.corrupt.count() == 0
    for part, parses in ((w.corrupt, 1), (w.sessions, 3)):
        assert part._jdf.queryExecution().executedPlan().toString().count("from_json(") == parses


def test_several_moves_of_one_user(spark):
    t = tasks_df(spark, [task(1, x, ord_=i, pos=i) for i, x in enumerate("abc")] + [task(2, "z", ord_=0, pos=0)])
    moves = spark.createDataFrame(
        [(1, ts("2024-01-01 00:00:02"), "b", "a"), (1, ts("2024-01-01 00:00:01"), "a", "c"),
         (1, ts("2024-01-01 00:00:03"), "zz", "a")], MOVES)
    out = T.move_item(t, moves).collect()
    # abc -> bca -> cab
    assert len(out) == 4 and {r.id: r.ord for r in out} == {"c": 0, "a": 1, "b": 2, "z": 0}


def test_bad_due_date_is_no_date(spark):
    raw = spark.createDataFrame(
        [(1, "n1", "x", None, "soon", 1), (1, "n2", "y", None, "2024-02-30", 2), (1, "n3", "z", None, "2024-02-28", 3)],
        "user_id long, id string, title string, priority string, due string, seq long")
    out = {r.id: r.due_date for r in T.new_tasks(raw, F.lit("2024-01-01 00:00:00").cast("timestamp")).collect()}
    assert out == {"n1": None, "n2": None, "n3": dt.date(2024, 2, 28)}


def test_reply_headings_are_raw_and_open_bold_counts(spark):
    r = spark.createDataFrame([("r", "## Plan **now**\n**open text\na **b** c\n** **")], "request_id string, text string")
    got = [(x.line_no, x.text) for x in N.response_spans(N.response_blocks(r)).orderBy("line_no", "span_no").collect()]
    assert got == [(1, "open te"), (2, "b"), (3, " ")]


def test_history_trims_skips_and_fails(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "sys", "draft", None), (1, 1, "user", " first ", "draft", None), (1, 2, "assistant", "r1", "draft", None),
         (1, 3, "user", "  ", "draft", None), (1, 4, "user", " second ", "draft", True), (1, 5, "assistant", "lost", "draft", True),
         (1, 6, "user", " third ", "draft", False), (1, 7, "assistant", "r3", "draft", False), (1, 8, "user", "last", "draft", False)],
        "conv_id long, turn long, role string, text string, mode string, failed boolean")
    out = {r.turn: [m["content"] for m in json.loads(r.messages)] for r in C.chat_history(turns).collect()}
    assert out == {4: [" first ", "r1", "second"], 6: [" first ", "r1", "third"],
                   8: [" first ", "r1", "third", "r3", "last"]}


def test_replies_reach_their_own_user(spark):
    notes = spark.createDataFrame(
        [(u, "n:1", "c", None, None, ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:00")) for u in (1, 2)],
        "user_id long, id string, content string, task_id string, summary string, created_at timestamp, updated_at timestamp")
    req = C.chat_requests(summary=C.summary_requests(notes), models={"default": "m", "large": "l"})
    resp = spark.createDataFrame([("summary:2:n:1", "short")], "request_id string, text string")
    _, changes = C.apply_responses(req, resp, F.lit("2024-01-02 00:00:00").cast("timestamp"))
    assert {r.user_id: r.summary for r in N.apply_note_changes(notes, changes).collect()} == {1: None, 2: "short"}


def test_no_history_is_collected_for_replies(spark, sf_dir):
    from daybook.plans import catalog

    plan = catalog.queries()["apply_responses"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    # the quadratic window collects (role, content) structs
    assert "collect_list(CASE WHEN recorded" not in plan


def test_note_list_does_not_read_texts(spark, sf_dir):
    from daybook.plans import catalog

    plan = catalog.queries()["note_list"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    schemas = [x for x in plan.splitlines() if "ReadSchema" in x]
    assert schemas and not any("text:string" in x for x in schemas)
