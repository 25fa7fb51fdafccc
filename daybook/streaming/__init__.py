"""Structured Streaming versions of the time rules (T2, T3 stream, T4 stream).

Each takes a streaming DataFrame with an event-time column ``ts`` and returns
a streaming DataFrame for an ``append`` sink.  Rows later than the watermark
delay are dropped by Spark; within the delay, arrival order does not matter:
stateful jobs buffer rows in state until the watermark passes them and then
process them in time order, so every emitted row equals the batch job's.
"""

from daybook.streaming.nudges import idle_nudges_stream
from daybook.streaming.reminders import eod_reminders_stream
from daybook.streaming.timer import timer_sessions_stream

__all__ = ["eod_reminders_stream", "idle_nudges_stream", "timer_sessions_stream"]
