"""Hard negatives (op13) and top-k (op4) against brute force on awkward vectors."""

import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from daybook.llm import hard_negatives, pairing, topk
from tests.oracle import canon

INF, NAN = float("inf"), float("nan")


def awkward(spark, copies=1):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(0, 260):
        centre = np.eye(8)[i % 3]
        rows.append((i, [float(x) for x in centre + rng.normal(0, 0.2, 8)], i % 4))
    rows += [(300, [], 1), (301, [], 1), (302, [], 2), (400, [], 1)]  # empty vectors
    rows += [(500, [0.0] * 8, 1), (501, [0.0] * 8, 2), (600, [0.5, 0.5], 0), (601, [0.5, 0.25], 0), (602, [0.5, 0.25], 3)]
    rows += [(700, None, 1), (None, [0.1] * 8, 1), (800, [0.1] * 8, None), (900, [NAN] + [0.1] * 7, 1)]
    rows += [(1000, [INF] + [0.1] * 7, 1), (1100, [None] + [0.1] * 7, 1)]
    rows += [(1000 + i, [1.0] + [0.0] * 7, 2) for i in range(101, 140)]  # one vector in many rows
    rows += [rows[0], rows[3], rows[100], (100, [0.25] * 8, 3), (3, [0.9] * 8, 3)]  # repeated ids
    return spark.createDataFrame(
        [(i, None if v is None else v, lab, "x", 1) for i, v, lab in rows * copies],
        "vec_id long, embedding array<float>, label int, akey string, slot int",
    )


def oracle(df, sql):
    con = duckdb.connect()
    embeddings = df.select("vec_id", "embedding", "label").toArrow()  # noqa: F841
    return con.sql(sql)


def same(got, rel):
    cols = sorted(rel.columns)
    want = sorted("|".join(canon(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert sorted("|".join(canon(r[c]) for c in cols) for r in got.collect()) == want
    return len(want)


def mined(df, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(df, label, **more)


def test_hard_negatives_awkward_rows(spark):
    df = awkward(spark)
    assert same(mined(df), oracle(df, hard_negatives.ORACLE)) > 50
    assert same(mined(df, block=2), oracle(df, hard_negatives.ORACLE)) > 50  # many blocks of anchors


def test_several_cells_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(pairing, "GROUP_ROWS", 50)
    monkeypatch.setattr(pairing, "MOST_PARTITIONS", 3)
    df = awkward(spark)
    assert same(mined(df, block=2), oracle(df, hard_negatives.ORACLE)) > 50
    assert same(topk.top_k(df, block=2), oracle(df, topk.ORACLE)) > 20


def test_hard_negatives_repeats_and_empty(spark):
    df = awkward(spark, 2)
    same(mined(df), oracle(df, hard_negatives.ORACLE))
    assert mined(df.limit(0)).collect() == []


def test_topk_awkward_rows(spark):
    df = awkward(spark)
    assert same(topk.top_k(df), oracle(df, topk.ORACLE)) > 20
    assert same(topk.top_k(df, block=2), oracle(df, topk.ORACLE)) > 20


def test_ranges_hold_all_rows_above_the_need():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, 6)) + np.eye(6)[rng.integers(0, 6, 400)] * 4
    x = np.floor(x * 64).astype(np.int64)
    bucket = hard_negatives.Bucket(x)
    q = x[:20]
    scores = q @ x.T
    low = np.sort(scores, axis=1)[:, -6:-5]
    anchors = hard_negatives.Anchors(
        np.arange(20), np.zeros(20), q, low, np.full((20, 1), hard_negatives.MOST), True, 5
    )
    alive = anchors.feasible(bucket, slice(0, 20), 400)
    assert alive[scores >= low].all()
    assert alive.mean() < 0.5  # the ranges do prune
    assert math.isclose(bucket.longest, np.sqrt((x.astype(float) ** 2).sum(axis=1)).max())
