"""Column expressions (JVM-side, no Python row functions)."""

from daybook.functions.columns import (
    drift_verdict,
    next_priority,
    note_age,
    priority_class,
    session_label,
)
from daybook.functions.text import contains_literal_ci, is_blank, js_trim, mmss

__all__ = [
    "contains_literal_ci",
    "drift_verdict",
    "is_blank",
    "js_trim",
    "mmss",
    "next_priority",
    "note_age",
    "priority_class",
    "session_label",
]
