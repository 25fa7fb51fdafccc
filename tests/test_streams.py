"""Batch = stream for the time rules, with the input cut into several micro-batches."""

import pytest
from pyspark.sql import functions as F

from daybook.operators.timers import eod_reminders, idle_nudges, timer_sessions
from daybook.sources.fixtures import Fixtures
from daybook.streaming import eod_reminders_stream, idle_nudges_stream, timer_sessions_stream


def _as_stream(spark, df, folder, parts):
    lo, hi = df.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / parts
    for i in range(parts):
        a, b = lo + step * i, lo + step * (i + 1)
        part = df.where((F.col("ts") >= a) & ((F.col("ts") < b) if i < parts - 1 else F.lit(True)))
        part.coalesce(1).write.parquet(f"{folder}/p{i:02d}")
    return (
        spark.readStream.schema(df.schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(folder)
    )


def _run(spark, sdf, name, ckpt):
    q = sdf.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", ckpt).start()
    q.processAllAvailable()
    wm = q.lastProgress["eventTime"].get("watermark").replace("T", " ").replace("Z", "")
    q.stop()
    return set(map(tuple, spark.table(name).collect())), wm


@pytest.mark.parametrize("parts", [2, 5])
def test_idle_nudges_stream_equals_batch(spark, sf_dir, tmp_path, parts):
    act = Fixtures(spark, sf_dir).activity()
    got, wm = _run(spark, idle_nudges_stream(_as_stream(spark, act, str(tmp_path / "in"), parts)),
                   f"nudges{parts}", str(tmp_path / "ck"))
    want = set(map(tuple, idle_nudges(act, F.lit(wm).cast("timestamp")).collect()))
    assert got == want and len(got) > 0


def test_timer_stream_equals_batch(spark, sf_dir, tmp_path):
    fx = Fixtures(spark, sf_dir)
    ev, st = fx.timer_events(), fx.settings()
    got, wm = _run(spark, timer_sessions_stream(_as_stream(spark, ev, str(tmp_path / "in"), 4), st),
                   "timer", str(tmp_path / "ck"))
    want = timer_sessions(ev, st).where(F.col("completed_at") <= F.lit(wm).cast("timestamp"))
    assert got == set(map(tuple, want.collect()))


def test_eod_stream_equals_batch(spark, sf_dir, tmp_path):
    tk = Fixtures(spark, sf_dir).ticks()
    got, _ = _run(spark, eod_reminders_stream(_as_stream(spark, tk, str(tmp_path / "in"), 3), "UTC", 17, 1),
                  "eod", str(tmp_path / "ck"))
    assert got == set(map(tuple, eod_reminders(tk, "UTC", 17, 1).collect()))


def test_eod_stream_first_arrival_equals_batch_for_ordered_input(spark, sf_dir, tmp_path):
    tk = Fixtures(spark, sf_dir).ticks()
    sdf = eod_reminders_stream(_as_stream(spark, tk, str(tmp_path / "in"), 3), "UTC", 17, 1, delay="2 minutes",
                               exact=False)
    got, _ = _run(spark, sdf, "eod_first", str(tmp_path / "ck"))
    assert got == set(map(tuple, eod_reminders(tk, "UTC", 17, 1).collect()))
