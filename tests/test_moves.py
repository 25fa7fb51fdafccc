"""Many moves of one user (O4) against splicing a list move by move."""

import datetime as dt
import random
from time import perf_counter

from pyspark.sql import functions as F

from daybook.operators import tasks as T
from daybook.operators.moves import compose


def splice(ids, drags):
    ids = list(ids)
    for drag, over in drags:
        if drag != over and drag in ids and over in ids:
            t = ids.index(over)
            ids.remove(drag)
            ids.insert(t, drag)
    return ids


def test_compose_equals_splicing():
    rng = random.Random(3)
    for n, m in [(1, 5), (2, 9), (7, 40), (40, 200), (3_000, 1_000), (5_000, 20_000)]:
        ids = [f"t{i}" for i in range(n)]
        drags = [(f"t{rng.randrange(n + 2)}", f"t{rng.randrange(n + 2)}") for _ in range(m)]
        drags += [(None, "t0"), ("t0", None)]
        named = sorted({int(x[1:]) for d in drags for x in d if x is not None and int(x[1:]) < n})
        shifts = compose([f"t{i}" for i in named], named, drags)
        if n == 1:
            assert shifts is None
            continue
        places, runs = {}, 0
        for i in range(n):
            marked = i in set(named[runs : runs + 1])
            runs += marked
            places[ids[i]] = i + shifts[2 * runs - 1 if marked else 2 * runs]
        want = splice(ids, drags) if n < 5_000 else None
        assert sorted(places.values()) == list(range(n))
        if want:
            assert sorted(places, key=places.get) == want


def _tables(spark, sizes, moves):
    tasks = spark.createDataFrame(
        [(u, f"t{i}", i * 2, i, i % 11 == 10) for u, n in sizes.items() for i in range(n)],
        "user_id long, id string, ord long, array_pos long, done boolean",
    )
    at = dt.datetime(2024, 1, 1)
    rows = [(u, at + dt.timedelta(seconds=k // 3), k, d, o) for u, of in moves.items() for k, (d, o) in enumerate(of)]
    return tasks, spark.createDataFrame(rows, "user_id long, ts timestamp, move_id long, drag_id string, over_id string")


def test_many_moves_of_one_user_in_one_pass(spark):
    rng = random.Random(5)
    sizes = {1: 40, 2: 700, 3: 5, 4: 9}
    pick = lambda n: (f"t{rng.randrange(n + 1)}", f"t{rng.randrange(n + 1)}")
    moves = {1: [pick(40) for _ in range(200)], 2: [pick(700) for _ in range(1_000)], 3: [("t1", "t1"), ("t9", "t1")]}
    tasks, log = _tables(spark, sizes, moves)
    start = perf_counter()
    got = {(r.user_id, r.id): r.ord for r in T.move_item(tasks, log).collect()}
    assert perf_counter() - start < 10
    for u, n in sizes.items():
        pending = [f"t{i}" for i in range(n) if i % 11 != 10]
        want = {f"t{i}": i * 2 for i in range(n)}
        if u < 3:
            want |= {t: i for i, t in enumerate(splice(pending, moves[u]))}
        assert {t: got[u, t] for t in want} == want


def test_no_moves(spark):
    tasks, log = _tables(spark, {1: 3}, {})
    assert {r.id: r.ord for r in T.move_item(tasks, log).collect()} == {"t0": 0, "t1": 2, "t2": 4}


def test_moves_dealt_by_user_already_are_read_once_for_the_places(spark):
    """Failed before: the places were counted with all joins in, and tasks and moves dealt alike met no shuffle of their own."""
    rows = [(u, f"t{i}", False, None, i) for u in range(60) for i in range(6)]
    tasks = spark.createDataFrame(rows, "user_id long, id string, done boolean, ord long, array_pos long")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    moves = (
        spark.range(120).groupBy((F.col("id") % 60).alias("user_id")).agg(F.collect_list("id").alias("k"))
        .select("user_id", at.alias("ts"), F.posexplode("k").alias("move_id", "k"))
        .select("user_id", "ts", "move_id", F.lit("t0").alias("drag_id"), F.lit("t5").alias("over_id"))
    )
    df = T.move_item(tasks, moves)
    assert "xxhash64(user_id" in df._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in df.collect():
        got.setdefault(r.user_id, {})[r.id] = r.ord
    # t0 goes behind t5, then in front of it again
    assert len(got) == 60 and all(g == {"t1": 0, "t2": 1, "t3": 2, "t4": 3, "t0": 4, "t5": 5} for g in got.values())
