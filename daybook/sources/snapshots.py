"""Session snapshots stored by day, so that the jobs of one day read that day's files only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_sessions(sessions: DataFrame, path: str, replace_days: bool = False) -> None:
    """Write sessions below ``path``, a folder a day.

    Rows are dealt by ranges of (date, user), so a busy day is written by several tasks and a
    quiet one shares a task with its neighbours; each folder gets a few files, sorted by user.
    ``replace_days``: the days that ``sessions`` holds are replaced and all others stay;
    else the whole snapshot is.
    """
    dealt = sessions.repartitionByRange("date", "user_id", "id").sortWithinPartitions("date", "user_id", "id")
    writer = dealt.write.mode("overwrite").partitionBy("date")
    writer.option("partitionOverwriteMode", "dynamic" if replace_days else "static").parquet(path)


def read_sessions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored sessions with the columns of ``schema``; a filter on ``date`` prunes folders."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
