"""Change logs folded in one pass (M1) against the stepwise rule, with a task that holds most of the log."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import chat as C
from daybook.operators import sequence
from daybook.operators import tasks as T

BASE = dt.datetime(2024, 1, 1)
TASK = (
    "user_id long, id string, title string, priority string, due_date date, done boolean, ord long, array_pos long, "
    "created_at timestamp, completed_at timestamp"
)
LOG = (
    "user_id long, task_id string, ts timestamp, change_id long, op string, set_title boolean, title string, "
    "set_priority boolean, priority string, set_due boolean, due_date date, set_done boolean, done boolean"
)


def stepwise(task, log):
    """The app's rule, change by change."""
    task = dict(task)
    for c in sorted(log, key=lambda c: (c["ts"], c["change_id"])):
        if c["op"] == "delete":
            return None
        for flag, field in (("set_title", "title"), ("set_priority", "priority"), ("set_due", "due_date")):
            if c[flag]:
                task[field] = c[field]
        if c["set_done"]:
            task["done"] = c["done"]
            if c["done"]:
                task["completed_at"] = task["completed_at"] or c["ts"]
            else:
                task["completed_at"] = None
    return task


@pytest.fixture(params=[None, 50])
def hot(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(sequence, "HOT_ROWS", request.param)


@pytest.mark.parametrize("seed", [1, 2])
def test_log_in_one_read_equals_stepwise(spark, hot, seed):
    rng = random.Random(seed)
    tasks, log = [], []
    for u in range(2):
        for i in range(25):
            done = rng.random() < 0.3
            at = BASE if done and rng.random() < 0.9 else None
            tasks.append((u, f"t{i}", f"title {i}", "med", None, done, i, i, BASE, at))
    for k in range(1_500):
        u, i = (0, 3) if rng.random() < 0.6 else (rng.randrange(2), rng.randrange(28))
        done = rng.random() < 0.5
        ts = BASE + dt.timedelta(seconds=rng.randrange(400))
        op = "delete" if rng.random() < 0.002 and (u, i) != (0, 3) else "update"
        sets = rng.random() < 0.7
        log.append(
            (u, f"t{i}", ts, k, op, rng.random() < 0.2, f"n{k}", rng.random() < 0.2, rng.choice(["low", None]), rng.random() < 0.2,
             dt.date(2024, 2, 1) if rng.random() < 0.5 else None, sets, done if sets else None)
        )
    tdf, ldf = spark.createDataFrame(tasks, TASK), spark.createDataFrame(log, LOG)
    got = {(r.user_id, r.id): r for r in T.apply_task_changes(tdf, ldf).collect()}
    names = [c.split()[0] for c in LOG.split(", ")]
    rows = [dict(zip(names, r)) for r in log]
    for t in tasks:
        own = [r for r in rows if (r["user_id"], r["task_id"]) == t[:2]]
        want = stepwise(dict(zip([c.split()[0] for c in TASK.split(", ")], t)), own)
        assert (t[:2] in got) == (want is not None)
        if want:
            assert {c: got[t[:2]][c] for c in want} == want


def test_log_is_read_once(spark, sf_dir, tmp_path):
    log = spark.createDataFrame([(0, "t", BASE, 0, "update", False, None, False, None, False, None, True, True)], LOG)
    log.write.parquet(str(tmp_path / "log"))
    df = T.apply_task_changes(spark.createDataFrame([], TASK), spark.read.parquet(str(tmp_path / "log")))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_segments_of_a_hot_conversation(spark, hot):
    rng = random.Random(4)
    rows = [(c, t, "user", "x", rng.choice(["chat", "plan", None]), rng.random() < 0.1) for c, n in ((1, 600), (2, 30), (3, 1)) for t in range(n)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mode string, cleared boolean")
    got = {(r.conv_id, r.turn): r.seg for r in C.history_segments(turns).collect()}
    seg = {}
    for c, t, _, _, mode, cleared in rows:
        before = rows[rows.index((c, t, "user", "x", mode, cleared)) - 1] if t else None
        now = bool(cleared) or bool(before and before[4] is not None and before[4] != mode)
        seg[c, t] = (seg[c, t - 1] if t else 0) + now
    assert got == seg
    scans = C.history_segments(turns.withColumn("turn", F.col("turn") + 1)).select("seg")
    assert scans.count() == len(rows)


def test_chat_log_expands_to_the_histories(spark, hot):
    import json

    rng = random.Random(6)
    said = [" a ", "b", " ", "c\"d", None]
    rows = [
        (c, t, rng.choice(["user", "user", "assistant", "system"]), rng.choice(said), "chat" if rng.random() < 0.97 else "plan", rng.random() < 0.1)
        for c, n in ((1, 700), (2, 60), (3, 1))
        for t in range(n)
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mode string, failed boolean")
    log = C.chat_log(turns)
    assert log.messages.count() + log.requests.count() <= 2 * len(rows)
    got = {(r.conv_id, r.turn): (r.n_history, json.loads(r.messages)) for r in C.expand(log, chunk=16).collect()}
    want, history, before = {}, [], None
    for c, t, role, text, mode, failed in rows:
        if before is None or before[0] != c or before[1] != mode:
            history = []
        before = c, mode
        text_now = (text or "").strip() if role == "user" and history else text
        if role == "user" and history and (text or "").strip():
            want[c, t] = (len(history), [*history, {"role": "user", "content": text.strip()}])
        if not failed and (role == "assistant" or (role == "user" and (text or "").strip())):
            history = [*history, {"role": role} | ({} if text_now is None else {"content": text_now})]
    assert got == want and len(want) > 100
