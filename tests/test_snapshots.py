"""Session snapshots by day."""

import datetime as dt

from pyspark.sql import functions as F

from daybook.operators import sessions as S
from daybook.sources import snapshots

SCHEMA = "user_id long, id string, date date, n int"


def test_only_the_day_is_read(spark, tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(5)] + [None]
    rows = [(u, f"s{i}", days[(u * i) % 6], i) for u in range(40) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path / "s")
    snapshots.write_sessions(df, path)
    stored = snapshots.read_sessions(spark, path, df.schema)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(rows, key=str)
    for day in ("2024-01-01", "2024-01-04", "2030-01-01"):
        got = S.sessions_on_date(stored, day)
        assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if str(r[2]) == day)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(date" in plan and day in plan
        assert all(f"date={day}" in r[0] for r in got.select(F.input_file_name()).distinct().collect())


def test_days_can_be_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    first = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1), 1), (1, "b", dt.date(2024, 1, 2), 1)], SCHEMA)
    snapshots.write_sessions(first, path)
    snapshots.write_sessions(first.where("id = 'b'").withColumn("n", F.lit(2)), path, replace_days=True)
    got = snapshots.read_sessions(spark, path, first.schema)
    assert sorted((r.id, r.n) for r in got.collect()) == [("a", 1), ("b", 2)]
