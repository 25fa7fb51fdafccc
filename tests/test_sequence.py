"""The skew-safe ordered scan against pandas, with one key holding 40% of rows."""

import numpy as np
import pandas as pd
import pytest

from daybook.operators.sequence import ordered_scan, ordered_text


@pytest.mark.parametrize("hot,seed", [(10_000, 0), (500, 1), (200, 2), (30, 3)])
@pytest.mark.parametrize("reuse,aqe", [("true", "true"), ("false", "true"), ("false", "false"), ("true", "false")])
def test_ordered_scan_matches_pandas(spark, hot, seed, reuse, aqe):
    confs = {"spark.sql.exchange.reuse": reuse, "spark.sql.adaptive.enabled": aqe, "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        check_scan(spark, hot, seed)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def check_scan(spark, hot, seed):
    rng = np.random.default_rng(seed)
    n = 3000
    keys = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 30, n)).astype("int64")
    pdf = pd.DataFrame(
        {
            "k": keys,
            "o": rng.permutation(n).astype("int64"),
            "v": rng.integers(0, 5, n).astype("int64"),
            "s": [f"x{i}" if i % 11 else None for i in range(n)],
        }
    )
    df = spark.createDataFrame(pdf, "k long, o long, v long, s string")
    got = ordered_scan(
        df, "k", ["o"], position="pos", lag={"prev_s": "s"}, lead={"next_o": "o"},
        running_sum={"cs": "v"}, last={"filled": "s"},
        switches={"sw": (["v"], lambda before, row: before["v"] != row["v"])}, hot_rows=hot,
    ).toPandas()
    exp = pdf.sort_values(["k", "o"]).copy()
    g = exp.groupby("k")
    exp["pos"] = g.cumcount()
    exp["prev_s"] = g["s"].shift(1)
    exp["next_o"] = g["o"].shift(-1)
    exp["cs"] = g["v"].cumsum()
    exp["filled"] = g["s"].transform(lambda x: x.ffill().shift(1))
    exp["sw"] = g["v"].transform(lambda x: (x != x.shift(1)).cumsum() - 1)
    m = got.merge(exp, on=["k", "o"], suffixes=("", "_e"))
    assert len(m) == n == len(got)
    assert (m.pos == m.pos_e).all()
    assert (m.cs == m.cs_e).all()
    assert (m.sw == m.sw_e).all()
    assert (m.filled.fillna("~") == m.filled_e.fillna("~")).all()
    assert (m.prev_s.fillna("~") == m.prev_s_e.fillna("~")).all()
    assert (m.next_o.fillna(-1).astype("int64") == m.next_o_e.fillna(-1).astype("int64")).all()


def test_ordered_scan_empty(spark):
    df = spark.createDataFrame([], "k long, o long")
    assert ordered_scan(df, "k", ["o"], position="pos").count() == 0


def test_ordered_text_two_levels(spark):
    rows = [(1, i, f"l{i}") for i in range(250)] + [(2, 0, "only")]
    df = spark.createDataFrame(rows, "k long, pos long, t string")
    out = {r.k: r.txt for r in ordered_text(df, ["k"], "pos", "t", "\n", "txt", chunk_rows=16).collect()}
    assert out[1] == "\n".join(f"l{i}" for i in range(250))
    assert out[2] == "only"


def test_hot_key_has_few_bounds_and_linear_time(spark):
    from time import perf_counter

    from pyspark.sql import functions as F

    from daybook.operators import sequence

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        seconds = {}
        for n in (20_000, 320_000):  # 200 and 3,200 times hot_rows, one key
            df = spark.range(n).select(F.lit(1).alias("k"), ((F.col("id") * 7919) % n).alias("o"))
            bounds = sequence._hot_bounds(df, "k", ["o"], 4, 100)[0].collect()
            assert len(bounds) == 1 and 2 <= len(bounds[0]["__bounds"]) <= 12
            start = perf_counter()
            got = ordered_scan(df, "k", ["o"], position="pos", running_sum={"s": "o"}, hot_rows=100)
            assert got.where("pos <> o or s <> o * (o + 1) / 2").count() == 0 and got.count() == n
            seconds[n] = perf_counter() - start
        assert seconds[320_000] < 16 * seconds[20_000]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ordinary_keys_have_no_bounds(spark):
    from daybook.operators import sequence

    df = spark.range(1_000).selectExpr("id % 50 as k", "id as o")
    assert sequence._hot_bounds(df, "k", ["o"], 8, 200) is None
    assert sequence._hot_bounds(df, "k", ["o"], 8, 10) is None  # above hot_rows, below twice a partition's share
