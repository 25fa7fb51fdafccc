"""Note jobs: new rows, list order, literal search, change folds, markdown blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import contains_literal_ci, is_blank, js_trim, note_age
from daybook.operators.sequence import ordered_scan

# inline markup of notes: bold or italic, leftmost first, never nested
NOTE_INLINE = r"(\*\*[^*]+\*\*|_[^_]+_)"
# inline markup of coach replies: bold only
REPLY_INLINE = r"(\*\*[^*]+\*\*)"


def new_notes(raw: DataFrame, now: Column) -> DataFrame:
    """Trimmed content, blank notes dropped; no task, no summary, both times = now."""
    content = js_trim("content")
    ts = now.cast("timestamp")
    return raw.where(content != "").select(
        "user_id",
        "id",
        content.alias("content"),
        F.lit(None).cast("string").alias("task_id"),
        F.lit(None).cast("string").alias("summary"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


def note_list(notes: DataFrame, as_of: Column) -> DataFrame:
    """O5 + P11: newest first (created_at desc, then id) with the age text.

    ``list_pos`` is the 0-based place in the user's list.
    """
    keyed = notes.select("user_id", "id", "created_at", (-F.unix_micros("created_at")).alias("__neg_created"))
    return ordered_scan(keyed, "user_id", ["__neg_created", "id"], position="list_pos").select(
        "user_id", "id", "list_pos", note_age("created_at", as_of).alias("age")
    )


def search_notes(notes: DataFrame, text: str) -> DataFrame:
    """Case-insensitive literal substring search; empty text matches all."""
    if text == "":
        return notes
    return notes.where(contains_literal_ci("content", text))


def apply_note_changes(notes: DataFrame, log: DataFrame) -> DataFrame:
    """M3 + M2: fold note patches (content, summary) and deletes into the notes.

    Every update sets ``updated_at`` to the change time.  Unknown ids are
    ignored; a delete is final.
    """
    upd = log.where(F.col("op") == "update")

    def last_set(flag: str, value: str) -> Column:
        return F.max(F.when(F.col(flag), F.struct("ts", "change_id", F.col(value).alias("v"))))

    ch = (
        upd.groupBy("user_id", "note_id")
        .agg(
            last_set("set_content", "content").alias("__content"),
            last_set("set_summary", "summary").alias("__summary"),
            F.max("ts").alias("__updated"),
        )
        .withColumnRenamed("note_id", "id")
    )
    deletes = log.where(F.col("op") == "delete").select("user_id", F.col("note_id").alias("id"))

    def pick(field: str, col: str) -> Column:
        return F.when(F.col(field).isNotNull(), F.col(field)["v"]).otherwise(F.col(col))

    return (
        notes.join(deletes, ["user_id", "id"], "left_anti")
        .join(ch, ["user_id", "id"], "left")
        .select(
            "user_id",
            "id",
            pick("__content", "content").alias("content"),
            "task_id",
            pick("__summary", "summary").alias("summary"),
            "created_at",
            F.coalesce(F.col("__updated"), F.col("updated_at")).alias("updated_at"),
        )
    )


# ------------------------------------------------------------------ markdown


def _lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    return df.select(*keys, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def note_blocks(notes: DataFrame) -> DataFrame:
    """One row per line of a note: kind and shown text.

    First match wins: blank, ``### ``, ``## ``, ``# ``, ``- `` or ``* ``,
    digits + ``. ``, else a plain line.  The marker is removed except for
    numbered items.  ``text`` is built from prefix tests on the line, not from
    ``kind``, so a filter on it stays cheap when pushed below this projection.
    """
    line = F.col("line")
    blank = is_blank(line)
    bullet = line.startswith("- ") | line.startswith("* ")
    kind = (
        F.when(blank, "blank")
        .when(line.startswith("### "), "h3")
        .when(line.startswith("## "), "h2")
        .when(line.startswith("# "), "h1")
        .when(bullet, "bullet")
        .when(line.rlike(r"^\d+\. "), "numbered")
        .otherwise("line")
    )
    text = (
        F.when(blank, F.lit(""))
        .when(line.startswith("### "), F.expr("substring(line, 5)"))
        .when(line.startswith("## "), F.expr("substring(line, 4)"))
        .when(line.startswith("# "), F.expr("substring(line, 3)"))
        .when(bullet, F.expr("substring(line, 3)"))
        .otherwise(line)
    )
    return _lines(notes.withColumnRenamed("id", "note_id"), ["user_id", "note_id"], "content").select(
        "user_id", "note_id", "line_no", kind.alias("kind"), text.alias("text")
    )


def _spans(blocks: DataFrame, keys: list[str], pattern: str, italic: bool) -> DataFrame:
    """Pieces of ``text`` split around ``pattern`` that the renderer formats.

    Like a split with a capturing group: matches sit at odd piece numbers,
    the text between them at even ones.  In notes (``italic``) a piece is bold
    when it starts and ends with ``**``, else italic when it starts and ends
    with ``_`` -- which can also hold for a piece between matches.  In coach
    replies any piece that starts with ``**`` is bold, closed or not; its first
    and last two characters go, as in the app.
    Lines without a marker character cannot hold a formatted piece and skip
    the regular expressions.
    """
    text = F.col("text")
    marked = F.contains(text, F.lit("*"))
    if italic:
        marked = marked | F.contains(text, F.lit("_"))
    src = blocks.where((F.col("kind") != "blank") & marked)
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    pieces = F.concat(
        F.flatten(F.transform(matches, lambda m, i: F.array(between[i], m))),
        F.array(F.element_at(between, -1)),
    )
    exploded = src.select(*keys, F.posexplode(pieces).alias("span_no", "piece"))
    p = F.col("piece")
    n = F.length(p)
    is_bold = p.startswith("**") & p.endswith("**") if italic else p.startswith("**")
    is_italic = p.startswith("_") & p.endswith("_") if italic else F.lit(False)
    kind = F.when(is_bold, "bold").when(is_italic, "italic")
    inner = (
        F.when(is_bold, F.when(n >= 4, F.expr("substring(piece, 3, length(piece) - 4)")).otherwise(""))
        .otherwise(F.when(n >= 2, F.expr("substring(piece, 2, length(piece) - 2)")).otherwise(""))
    )
    return exploded.where(kind.isNotNull()).select(
        *keys, F.col("span_no").cast("long").alias("span_no"), kind.alias("kind"), inner.alias("text")
    )


def note_spans(blocks: DataFrame) -> DataFrame:
    """Bold (``**..**``) and italic (``_.._``) spans of each non-blank block."""
    return _spans(blocks, ["user_id", "note_id", "line_no"], NOTE_INLINE, italic=True)


def response_blocks(responses: DataFrame) -> DataFrame:
    """Lines of a coach reply: blank, heading (``#`` to ``###``), bullet, numbered, line.

    Headings lose their ``#`` run and one white-space character; bullets lose
    their marker (the app also drops the text before the first bold part of
    a bullet, showing a plain bullet empty -- a display bug not copied).
    """
    line = F.col("line")
    blank = is_blank(line)
    heading = line.startswith("# ") | line.startswith("## ") | line.startswith("### ")
    bullet = line.startswith("- ") | line.startswith("* ")
    kind = (
        F.when(blank, "blank")
        .when(heading, "heading")
        .when(bullet, "bullet")
        .when(line.rlike(r"^\d+\. "), "numbered")
        .otherwise("line")
    )
    text = (
        F.when(blank, F.lit(""))
        .when(heading, F.regexp_replace(line, r"^#+\s", ""))
        .when(bullet, F.expr("substring(line, 3)"))
        .otherwise(line)
    )
    return _lines(responses, ["request_id"], "text").select(
        "request_id", "line_no", kind.alias("kind"), text.alias("text")
    )


def response_spans(blocks: DataFrame) -> DataFrame:
    """Bold spans of coach reply lines; headings are shown raw and have none."""
    return _spans(blocks.where(F.col("kind") != "heading"), ["request_id", "line_no"], REPLY_INLINE, italic=False)
