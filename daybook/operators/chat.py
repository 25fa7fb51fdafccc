"""Batches of chat requests built from the tables, and their responses joined back.

The model call itself is outside Spark: a request table goes out, a response
table ``(request_id, text)`` comes back.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook import constants as K
from daybook.functions import drift_verdict, js_trim
from daybook.operators.sequence import ordered_scan

REQUEST_COLUMNS = [
    "request_id",
    "owner_id",
    "kind",
    "model",
    "max_tokens",
    "system",
    "messages",
    "record_text",
    "note_id",
]

# request kinds that use the large model; all others use the default one
LARGE_MODEL_KINDS = ("review", "draft")


def _js(c: str) -> Column:
    """How a template string shows a null value."""
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


# ------------------------------------------------------------------ R1


def drift_requests(asks: DataFrame) -> DataFrame:
    """Drift checks; blank questions are not sent, the question is trimmed.

    ``asks``: user_id, ask_id, current_task, question.
    """
    q = js_trim("question")
    return asks.where(q != "").select(
        "user_id",
        "ask_id",
        F.concat(F.lit(K.DRIFT_HEAD), _js("current_task"), F.lit(K.DRIFT_MID), q, F.lit(K.DRIFT_TAIL)).alias(
            "prompt"
        ),
    )


def summary_requests(notes: DataFrame) -> DataFrame:
    """One summary request per note, with the note's content."""
    return notes.select(
        "user_id", F.col("id").alias("note_id"), F.concat(F.lit(K.SUMMARY_HEAD), _js("content")).alias("prompt")
    )


def draft_requests(drafts: DataFrame) -> DataFrame:
    """Message drafts; blank contexts are not sent, the context is sent as typed.

    ``drafts``: user_id, draft_id, channel, context, tone (empty -> the default tone).
    """
    tone = F.coalesce(F.nullif(F.col("tone"), F.lit("")), F.lit(K.DEFAULT_TONE))
    return drafts.where(js_trim("context") != "").select(
        "user_id",
        "draft_id",
        "context",
        F.concat(
            F.lit(K.DRAFT_HEAD),
            _js("channel"),
            F.lit(K.DRAFT_CONTEXT),
            F.col("context"),
            F.lit(K.DRAFT_TONE),
            tone,
            F.lit(K.DRAFT_TAIL),
        ).alias("prompt"),
    )


def drift_verdicts(responses: DataFrame) -> DataFrame:
    """A reply drifts when it starts with DRIFTING after upper-casing."""
    return responses.select("request_id", drift_verdict("text").alias("drifting"))


# ------------------------------------------------------------------ R2, R3


def history_segments(turns: DataFrame) -> DataFrame:
    """The chat history is emptied on a mode switch (or a clear).

    ``turns``: conv_id, turn, role, text, mode and optionally ``cleared``
    (history cleared just before this turn) and ``failed`` (the turn's call
    failed).  Adds ``seg``, the number of switches so far in the conversation,
    and ``recorded``: whether the turn enters the history, which takes user and
    assistant turns of calls that succeeded, and no blank user turns.

    Segments are found on the keys alone, in one ordered scan; the texts are joined back.
    """
    return _placed(turns).drop("n_history")


def _recorded(turns: DataFrame) -> Column:
    ok = ~F.coalesce(F.col("failed"), F.lit(False)) if "failed" in turns.columns else F.lit(True)
    said = (F.col("role") == "assistant") | ((F.col("role") == "user") & (js_trim("text") != ""))
    return ok & F.coalesce(said, F.lit(False))


def _placed(turns: DataFrame) -> DataFrame:
    """``turns`` with ``seg``, ``recorded`` and ``n_history``: the recorded turns before it in its segment."""
    cleared = F.coalesce("cleared", F.lit(False)) if "cleared" in turns.columns else F.lit(False)
    flagged = turns.withColumn("recorded", _recorded(turns))
    keys = flagged.select("conv_id", "turn", "mode", cleared.alias("__clear"), F.col("recorded").cast("long").alias("__rec"))

    def switched(before: Column, turn: Column) -> Column:
        other = before["mode"].isNotNull() & ~before["mode"].eqNullSafe(turn["mode"])
        return other | turn["__clear"]

    placed = ordered_scan(
        keys, "conv_id", ["turn"], switches={"seg": (["mode", "__clear"], switched)}, running_sum={"__upto": "__rec"}
    )
    before = F.col("__upto") - F.col("__rec")
    # a row a segment: the count at its start; and a clear before the first turn counts too
    first = placed.groupBy("conv_id", "seg").agg(F.min(before).alias("__start"))
    placed = placed.join(first, ["conv_id", "seg"]).select(
        "conv_id", "turn", "seg", (before - F.col("__start")).alias("n_history")
    )
    if "cleared" in turns.columns:
        opening = keys.groupBy("conv_id").agg(F.min_by("__clear", "turn").cast("long").alias("__opened"))
        placed = placed.join(opening, "conv_id").withColumn("seg", F.col("seg") + F.col("__opened")).drop("__opened")
    return turns.join(placed, ["conv_id", "turn"]).withColumn("recorded", _recorded(turns))


class ChatLog(NamedTuple):
    """R2 with every message once: a request's messages are those before ``n_history``, and its own."""

    messages: DataFrame  # conv_id, seg, place, role, content
    requests: DataFrame  # conv_id, turn, seg, n_history, record_text


def chat_log(turns: DataFrame) -> ChatLog:
    """R2: the histories and the follow-up requests over them, in space linear in the turns.

    A user turn is a follow-up when its segment already has a recorded turn
    before it and its text is not blank; the new message is trimmed, and so
    recorded.  The first turn of a segment's history is recorded as typed.
    """
    placed = _placed(turns)
    q = js_trim("text")
    follows = (F.col("role") == "user") & (F.col("n_history") > 0)
    messages = placed.where("recorded").select(
        "conv_id", "seg", F.col("n_history").alias("place"), "role", F.when(follows, q).otherwise(F.col("text")).alias("content")
    )
    requests = placed.where(follows & (q != "")).select("conv_id", "turn", "seg", "n_history", q.alias("record_text"))
    return ChatLog(messages, requests)


CHUNK = 256


def expand(log: ChatLog, chunk: int = CHUNK) -> DataFrame:
    """The requests with their whole histories, as the app sends them.

    The output grows with the square of a segment's length.  Messages are joined in chunks of
    ``chunk`` places first, and requests take whole chunks by (segment, chunk), so
    a long segment is spread over tasks.
    """
    of = F.struct("place", F.to_json(F.struct("role", "content")).alias("j"))
    chunks = (
        log.messages.withColumn("chunk", F.floor(F.col("place") / chunk))
        .groupBy("conv_id", "seg", "chunk")
        .agg(F.transform(F.array_sort(F.collect_list(of)), lambda x: x["j"]).alias("__parts"))
        .withColumn("__whole", F.array_join("__parts", ","))
    )
    needs = log.requests.select("conv_id", "turn", "seg", "n_history", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_history") - 1) / chunk))).alias("chunk"))
    left = F.col("n_history") - F.col("chunk") * chunk
    part = F.when(left >= chunk, F.col("__whole")).otherwise(F.array_join(F.slice("__parts", 1, left.cast("int")), ","))
    said = needs.join(chunks, ["conv_id", "seg", "chunk"]).groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list(F.struct("chunk", part.alias("t")))).alias("__said")
    )
    history = F.array_join(F.transform("__said", lambda x: x["t"]), ",")
    new = F.to_json(F.struct(F.lit("user").alias("role"), F.col("record_text").alias("content")))
    return log.requests.join(said, ["conv_id", "turn"]).select(
        "conv_id",
        "turn",
        "seg",
        "n_history",
        F.concat(F.lit("["), history, F.lit(","), new, F.lit("]")).alias("messages"),
        "record_text",
    )


def chat_history(turns: DataFrame) -> DataFrame:
    """R2: follow-up requests = the segment's history so far + the new user message (:func:`chat_log`, expanded)."""
    return expand(chat_log(turns))


# ------------------------------------------------------------------ R4, R5


def _single(prompt: Column) -> Column:
    return F.to_json(F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))))


def chat_requests(
    *,
    kickoff: DataFrame | None = None,
    review: DataFrame | None = None,
    drift: DataFrame | None = None,
    summary: DataFrame | None = None,
    draft: DataFrame | None = None,
    followup: DataFrame | None = None,
    models: dict[str, str],
) -> DataFrame:
    """One table of all requests.

    ``models``: ``{"default": .., "large": ..}``; review and draft use the large
    model, everything else (follow-ups included) the default one.  First
    requests carry no history; follow-ups carry theirs.  ``record_text`` is
    what the history keeps for the user turn: a short literal for kickoff and
    review, the typed text otherwise.  Ids are unique per user only, so request
    ids hold the owner; ``note_id`` is set for summaries.
    """
    parts: list[DataFrame] = []

    def add(df, kind, rid, owner, messages, record, note=None):
        model = models["large"] if kind in LARGE_MODEL_KINDS else models["default"]
        parts.append(
            df.select(
                F.concat(F.lit(kind + ":"), rid).alias("request_id"),
                owner.cast("long").alias("owner_id"),
                F.lit(kind).alias("kind"),
                F.lit(model).alias("model"),
                F.lit(K.MAX_TOKENS).alias("max_tokens"),
                F.lit(K.SYSTEM_PROMPT).alias("system"),
                messages.alias("messages"),
                record.cast("string").alias("record_text"),
                (F.lit(None) if note is None else note).cast("string").alias("note_id"),
            )
        )

    uid = F.col("user_id")

    def owned(c: str) -> Column:
        return F.concat(uid.cast("string"), F.lit(":"), F.col(c).cast("string"))

    if kickoff is not None:
        k = kickoff.where(F.col("prompt").isNotNull())
        add(k, "kickoff", uid.cast("string"), uid, _single(F.col("prompt")), F.lit(K.KICKOFF_HISTORY_TEXT))
    if review is not None:
        add(review, "review", uid.cast("string"), uid, _single(F.col("prompt")), F.lit(K.REVIEW_HISTORY_TEXT))
    if drift is not None:
        add(drift, "drift", owned("ask_id"), uid, _single(F.col("prompt")), F.lit(None))
    if summary is not None:
        add(summary, "summary", owned("note_id"), uid, _single(F.col("prompt")), F.lit(None), F.col("note_id"))
    if draft is not None:
        add(draft, "draft", owned("draft_id"), uid, _single(F.col("prompt")), F.col("context"))
    if followup is not None:
        rid = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
        add(followup, "followup", rid, F.col("conv_id"), F.col("messages"), F.col("record_text"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def apply_responses(requests: DataFrame, responses: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Join responses back by request id.

    Returns ``(history, note_changes)``.  Kickoff, review, draft and follow-up
    replies add two history rows (the recorded user text, then the reply);
    summary replies become note patches that set the summary at ``now``.
    A request without a response (failed call) records nothing.
    """
    joined = requests.join(responses.select("request_id", F.col("text").alias("reply")), "request_id")
    chat = joined.where(F.col("kind").isin("kickoff", "review", "draft", "followup"))
    history = chat.select(
        "request_id",
        "owner_id",
        "kind",
        F.posexplode(
            F.array(
                F.struct(F.lit("user").alias("role"), F.col("record_text").alias("content")),
                F.struct(F.lit("assistant").alias("role"), F.col("reply").alias("content")),
            )
        ).alias("msg_no", "msg"),
    ).select("request_id", "owner_id", "kind", "msg_no", F.col("msg.role").alias("role"), F.col("msg.content").alias("content"))
    summaries = joined.where(F.col("kind") == "summary")
    note_changes = summaries.select(
        F.col("owner_id").alias("user_id"),
        F.lit(0).cast("long").alias("change_id"),
        now.cast("timestamp").alias("ts"),
        "note_id",
        F.lit("update").alias("op"),
        F.lit(False).alias("set_content"),
        F.lit(None).cast("string").alias("content"),
        F.lit(True).alias("set_summary"),
        F.col("reply").alias("summary"),
    )
    return history, note_changes
