"""Text helpers with the app's (JavaScript) semantics, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.constants import JS_WHITESPACE_CHARS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def js_trim(c: Column | str) -> Column:
    """JavaScript ``String.prototype.trim``: strips Unicode white space and BOM.

    Spark's plain ``trim`` only strips the space character; with a character
    set it strips any of them from both ends, touching only the ends.
    """
    return F.trim(_col(c), F.lit(JS_WHITESPACE_CHARS))


def is_blank(c: Column | str) -> Column:
    """True when nothing is left after ``js_trim`` (null stays null)."""
    return js_trim(c) == F.lit("")


def contains_literal_ci(c: Column | str, query: str) -> Column:
    """Case-insensitive literal substring test; ``%`` and ``_`` are plain text.

    An empty query matches everything, as ``''.includes`` does.
    """
    return F.contains(F.lower(_col(c)), F.lower(F.lit(query)))


def mmss(seconds: Column | str) -> Column:
    """``mm:ss`` with at least two digits each; minutes over 99 are not cut."""
    s = _col(seconds).cast("long")
    return F.format_string("%02d:%02d", F.floor(s / 60), s % 60)
