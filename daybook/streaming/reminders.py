"""T3 on a stream: the end-of-day reminder, once per UTC day."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import BooleanType, DateType, LongType, StructField, StructType, TimestampType

from daybook import constants as K
from daybook.operators.timers import eod_hits

OUTPUT = StructType(
    [
        StructField("user_id", LongType(), False),
        StructField("day", DateType(), False),
        StructField("fire_ts", TimestampType(), False),
    ]
)
STATE = StructType(
    [
        StructField("fired", BooleanType(), False),
        StructField("earliest_us", LongType(), True),  # earliest hit seen, not yet sent
    ]
)
_DAY_US = 86_400_000_000


def _first_hit(key, pdfs, state):
    uid, day = int(key[0]), key[1]
    if isinstance(day, pd.Timestamp):
        day = day.date()
    wm = state.getCurrentWatermarkMs() * 1000
    fired, earliest = state.get if state.exists else (False, None)
    if not state.hasTimedOut:
        for pdf in pdfs:
            if len(pdf):
                m = int(pdf["ts"].astype("int64").min() // 1000)
                earliest = m if earliest is None else min(earliest, m)
    day_end = int((dt.datetime(day.year, day.month, day.day) - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    day_end += _DAY_US
    out = None
    if not fired and earliest is not None and earliest <= wm:
        out = pd.DataFrame({"user_id": [uid], "day": [day], "fire_ts": [pd.Timestamp(earliest, unit="us")]})
        fired = True
    if fired and wm >= day_end:
        state.remove()  # no row of this day can still arrive
    else:
        state.update((fired, earliest))
        due = day_end if fired else earliest
        state.setTimeoutTimestamp(max(due // 1000, wm // 1000) + 1)
    if out is not None:
        yield out


def eod_reminders_stream(
    ticks: DataFrame,
    tz: str,
    hour: int = K.EOD_HOUR,
    minutes: int = 1,
    delay: str = "2 minutes",
    exact: bool = True,
) -> DataFrame:
    """T3 on a stream: one reminder per user and UTC day.

    ``exact=True``: the earliest hit of the day, sent once the watermark has
    passed it (a delay of ``delay``); equals the batch job for any arrival
    order within the delay.  ``exact=False``: the first hit to *arrive*, sent
    at once (``dropDuplicatesWithinWatermark``; ``delay`` must then exceed the
    firing window); equal to the batch job when hits arrive in time order.
    """
    # the watermark follows every tick, not only the hits, so a day closes on time
    hits = eod_hits(ticks.withWatermark("ts", delay), tz, hour, minutes)
    if not exact:
        return hits.dropDuplicatesWithinWatermark(["user_id", "day"]).select(
            "user_id", "day", F.col("ts").alias("fire_ts")
        )
    return hits.groupBy("user_id", "day").applyInPandasWithState(
        _first_hit, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
