"""Properties over the fixture tables (fixed data, whole tables)."""

from pyspark.sql import functions as F

from daybook.operators import sessions as S
from daybook.operators import tasks as T
from daybook.plans.catalog import DAY
from daybook.sources import workspace as W
from daybook.sources.fixtures import Fixtures


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_pending_plus_done_is_all(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    c = S.task_counts(fx.tasks()).agg(F.sum("pending"), F.sum("done")).first()
    assert c[0] + c[1] == fx.tasks().count()


def test_focused_plus_distracted_is_total(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    bad = S.session_counts(fx.sessions(), DAY).where(F.col("focused") + F.col("distracted") != F.col("total"))
    assert bad.count() == 0


def test_reorder_is_idempotent(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    once = T.apply_reorder(fx.tasks(), fx.reorders())
    twice = T.apply_reorder(once, fx.reorders())
    assert _rows(once, ["user_id", "id", "ord"]) == _rows(twice, ["user_id", "id", "ord"])


def test_move_then_inverse_is_identity_on_pending_order(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    tasks = fx.tasks()
    moves = fx.moves().where("move_id = 1")
    # cut the lineage between the chained jobs (the plan would grow with each level)
    moved = T.move_item(tasks, moves).checkpoint()
    back_moves = moves.select(
        "user_id", "ts", F.col("over_id").alias("drag_id"), F.col("drag_id").alias("over_id")
    )
    # the inverse of "drag f onto t" is "drag the item now at t onto the item now at f"
    pend = T.pending_tasks(moved).select("user_id", "id", "pos")
    before = T.pending_tasks(tasks).select("user_id", "id", F.col("pos").alias("pos0"))
    m = moves.alias("m")
    f_pos = before.select("user_id", F.col("id").alias("drag_id"), F.col("pos0").alias("f"))
    t_pos = before.select("user_id", F.col("id").alias("over_id"), F.col("pos0").alias("t"))
    inv = (
        m.join(f_pos, ["user_id", "drag_id"]).join(t_pos, ["user_id", "over_id"])
        .join(pend.select("user_id", F.col("id").alias("inv_drag"), F.col("pos").alias("t")), ["user_id", "t"])
        .join(pend.select("user_id", F.col("id").alias("inv_over"), F.col("pos").alias("f")), ["user_id", "f"])
        .select("user_id", "ts", F.col("inv_drag").alias("drag_id"), F.col("inv_over").alias("over_id"))
    )
    restored = T.move_item(moved, inv)
    a = _rows(T.pending_tasks(restored), ["user_id", "id", "pos"])
    b = _rows(T.pending_tasks(tasks), ["user_id", "id", "pos"])
    assert a == b
    assert back_moves.count() == moves.count()


def test_fold_of_whole_log_equals_fold_of_halves(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    log = fx.task_changes()
    cut = log.agg(F.expr("percentile_approx(unix_micros(ts), 0.5)")).first()[0]
    first = log.where(F.unix_micros("ts") <= cut)
    second = log.where(F.unix_micros("ts") > cut)
    cols = ["user_id", "id", "title", "priority", "due_date", "done", "ord", "array_pos", "completed_at"]
    whole = T.apply_task_changes(fx.tasks(), log)
    halves = T.apply_task_changes(T.apply_task_changes(fx.tasks(), first), second)
    assert _rows(whole, cols) == _rows(halves, cols)


def test_write_then_read_is_identity(spark, sf_dir, tmp_path):
    fx = Fixtures(spark, sf_dir)
    pending = fx.tasks().where(~F.col("done")).select("user_id", "id", "title")
    sessions = S.session_titles(fx.sessions(), pending)
    path = str(tmp_path / "ws")
    W.write_workspaces(fx.tasks(), fx.notes(), sessions, path)
    tasks, notes, sess, corrupt, _ = W.read_workspaces(spark, path, multiline=False)
    cols = fx.tasks().columns
    assert _rows(tasks, cols) == _rows(fx.tasks(), cols)
    assert corrupt.count() == 0
    assert notes.count() == fx.notes().count() and sess.count() == sessions.count()


def test_every_input_row_reaches_a_query(spark, sf_dir):
    """The stand-in inputs cut nothing: all events, documents, customers, orders and turns are there."""
    fx = Fixtures(spark, sf_dir)
    events, docs, customers = (fx.table(t).count() for t in ("events", "documents", "customer"))
    for df in (fx.sessions(), fx.task_changes(), fx.note_changes(), fx.asks(), fx.raw_sessions(), fx.timer_events()):
        assert df.count() == events
    assert fx.notes().count() == docs
    assert fx.raw_notes().where("id like 'm%'").count() == docs
    assert fx.drafts().where("draft_id >= 0").count() == docs
    replies = fx.responses().groupBy(F.split("request_id", ":")[0].alias("kind")).count().collect()
    n = {r["kind"]: r["count"] for r in replies}
    assert (n["kickoff"], n["review"], n["summary"], n["draft"], n["drift"]) == (customers, customers, docs, docs, events)
    whole = fx.table("conversations").agg(F.max(F.length("text"))).first()[0]
    assert fx.responses().where("request_id like 'summary:%'").agg(F.max(F.length("text"))).first()[0] > min(whole, 200)
    assert fx.chat().count() == fx.table("conversations").count() + fx.table("conversations").where("role = 'user'").count()
    orders = fx.table("orders").agg(F.count("*"), F.max("o_orderkey")).first()
    reached = fx.sessions().select("task_id").distinct().count()
    assert reached == min(events, orders[1] + 1) or reached > 0.9 * min(events, orders[0])
