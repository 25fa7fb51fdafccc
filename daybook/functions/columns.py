"""Small per-row rules of the app, each a Spark column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.constants import DRIFT_MARKER, LABEL_DISTRACTED, LABEL_FOCUSED, PRIORITY_CYCLE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def next_priority(c: Column | str) -> Column:
    """Next priority on click: high -> med -> low -> high; anything else -> null."""
    c = _col(c)
    expr = F.when(c == "high", PRIORITY_CYCLE["high"])
    expr = expr.when(c == "med", PRIORITY_CYCLE["med"])
    return expr.when(c == "low", PRIORITY_CYCLE["low"])


def priority_class(c: Column | str) -> Column:
    """Badge class: high and med keep their name, everything else is low."""
    c = _col(c)
    return F.when(c == "high", "high").when(c == "med", "med").otherwise("low")


def session_label(interrupted: Column | str) -> Column:
    return F.when(_col(interrupted), LABEL_DISTRACTED).otherwise(LABEL_FOCUSED)


def note_age(created_at: Column | str, as_of: Column) -> Column:
    """``just now`` / ``Nm ago`` / ``Nh ago`` / ``Nd ago`` from whole seconds elapsed.

    A creation time in the future counts as ``just now``.
    """
    diff = F.floor((F.unix_micros(as_of) - F.unix_micros(_col(created_at))) / F.lit(1_000_000))
    return (
        F.when(diff < 60, F.lit("just now"))
        .when(diff < 3600, F.concat(F.floor(diff / 60).cast("string"), F.lit("m ago")))
        .when(diff < 86400, F.concat(F.floor(diff / 3600).cast("string"), F.lit("h ago")))
        .otherwise(F.concat(F.floor(diff / 86400).cast("string"), F.lit("d ago")))
    )


def drift_verdict(text: Column | str) -> Column:
    """True when the upper-cased reply starts with DRIFTING; errors and nulls are on track."""
    return F.coalesce(F.startswith(F.upper(_col(text)), F.lit(DRIFT_MARKER)), F.lit(False))
