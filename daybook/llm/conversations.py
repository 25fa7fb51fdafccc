"""Conversation structure repair by alignment to the alternating grammar (operator 11).

The roles of a repaired conversation read ``(s?(ua)+)?``.  A string of that grammar is
given by its length and its first role, so a conversation is aligned by Wagner and
Fischer's table to every feasible length in turn, starting where the least possible
cost is lowest and going outward until that bound passes the incumbent's cost.
Every table is filled only in Ukkonen's band: the diagonals that a path of at most
the incumbent's cost can reach.  The table runs backwards, so the forward trace
that takes the first letter among equally cheap edits gives the length's least audit;
the audits of all lengths are compared by cost, then as text.

Long conversations are aligned in blocks of ``BLOCK`` turns.  A block is aligned for each
role it may start and end after, and blocks are put together by least cost, then
least audit.  Two audits of the same turns and cost are never prefixes of one another
(the longer would only add paid inserts), so this gives the audit of the whole.
Conversations above ``SEGMENT`` are cut into segments that are aligned in separate tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from daybook.llm.common import map_batches, small, stored
from daybook.operators.sequence import ordered_scan

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 64  # turns of one alignment
SEGMENT = 512  # weight of what one task holds of a conversation: 1 a turn and 1 for every ...
WEIGHT_CHARS = 16_384  # ... characters of text
BROADCAST_ROWS = 200_000
BLANK = " \t\n\x0b\x0c\r"
NEVER = 1 << 60
# A state is the role before: "" (nothing yet), s, u or a.
STATES = ("", "s", "u", "a")
ROLES = {"u": "user", "a": "assistant"}


def target(entry: str, end: str, m: int) -> str | None:
    """The string of length m that leads from one state to another, if there is one."""
    if m == 0:
        return "" if entry == end else None
    if entry == "" and end == "s":
        return "s" if m == 1 else None
    if end not in "ua" or end == "":
        return None
    tail = ("ua" if end == "a" else "au") * (m // 2 + 1)
    tail = tail[-m:]
    if entry == "":
        return tail if tail[0] == "u" else "s" + tail[1:] if m > 1 else None
    return tail if tail[0] == ("a" if entry == "u" else "u") else None


def _drift(k: int) -> int:
    """Least cost of deleting k more turns than are inserted."""
    return DELETE * k if k >= 0 else -INSERT * k


def align(turns: str, goal: str, limit: int) -> tuple[int, str] | None:
    """Cheapest edits (cost, least audit) of ``turns`` to ``goal``, if they cost at most ``limit``.

    A turn is its role's initial (o for other roles), upper case if truncated.
    """
    n, m = len(turns), len(goal)
    inside = [k for k in range(-m, n + 1) if _drift(k) + _drift(n - m - k) <= limit]
    if not inside or not inside[0] <= 0 <= inside[-1]:
        return None
    low, high = inside[0], inside[-1]
    table = [None] * (n + 1)
    below: list[int] = []
    for i in range(n, -1, -1):
        row = [NEVER] * (m + 2)
        turn = turns[i] if i < n else ""
        extra = TRUNCATED if turn.isupper() else 0
        turn = turn.lower()
        for j in range(min(m, i - low), max(0, i - high) - 1, -1):
            if i == n and j == m:
                row[j] = 0
                continue
            best = INSERT + row[j + 1] if j < m else NEVER
            if i < n:
                if DELETE + below[j] < best:
                    best = DELETE + below[j]
                if j < m:
                    want = goal[j]
                    here = below[j + 1] + extra + (KEEP if turn == want else NEVER if want == "s" else REROLE)
                    if here < best:
                        best = here
            row[j] = best
        table[i] = below = row
    cost = table[0][0]
    if cost > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        left = table[i][j]
        if i < n and left == DELETE + table[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < m and left == INSERT + table[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == goal[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def least_cost(n: int, truncated: int, m: int) -> int:
    """No alignment of n turns, so many of them truncated, to m roles is cheaper."""
    if m > n:
        return INSERT * (m - n) + TRUNCATED * truncated
    return DELETE * (n - m) + TRUNCATED * max(0, truncated - (n - m))


@lru_cache(maxsize=100_000)
def best_length(turns: str, entry: str, end: str) -> tuple[int, str] | None:
    """Least (cost, audit) over all lengths of the grammar's strings from one state to another."""
    n, truncated = len(turns), sum(t.isupper() for t in turns)
    centre = n - truncated
    best = None
    for step in (1, -1):
        m = centre if step == 1 else centre - 1
        while m >= 0:
            limit = DELETE * n + INSERT * m + TRUNCATED * truncated if best is None else best[0]
            if least_cost(n, truncated, m) > limit:
                break
            goal = target(entry, end, m)
            found = align(turns, goal, limit) if goal is not None else None
            if found is not None and (best is None or found < best):
                best = found
            if step == 1 and end in ("", "s") and m > 1:
                break  # no longer strings end there
            m += step
    return best


def block(marks: str, entry: str, end: str) -> tuple[int, str] | None:
    """``best_length`` of a block with its blank and duplicate turns (x), which are deleted where they stand.

    Deleting one is part of every audit and D is the least letter, so it comes before any insert.
    """
    found = best_length(marks.replace("x", ""), entry, end)
    if found is None:
        return None
    cost, audit = found
    out, at = [], 0
    for letter in audit:
        while at < len(marks) and marks[at] == "x":
            out.append("D")
            at += 1
        out.append(letter)
        if letter != "I":
            at += 1
    out.append("D" * (len(marks) - at))
    return cost + DELETE * marks.count("x"), "".join(out)


def extend(reached: dict[str, tuple], marks: str) -> dict[str, tuple]:
    """{state: (cost, audit)} after more turns, block by block."""
    for start in range(0, len(marks), BLOCK):
        part, after = marks[start : start + BLOCK], {}
        for entry, (cost, audit) in reached.items():
            for end in STATES:
                more = block(part, entry, end)
                if more is not None:
                    way = (cost + more[0], audit + more[1])
                    if end not in after or way < after[end]:
                        after[end] = way
        reached = after
    return reached


def final(reached: dict[str, tuple]) -> tuple:
    return min(reached[end] for end in ("", "a") if end in reached)


def mark(role: str, text: str, repeated: bool) -> tuple[str, str]:
    """(turn as ``align`` takes it, or x; fault) of a row."""
    body = text.rstrip(BLANK)
    if not body:
        return "x", "blank"
    if repeated:
        return "x", "duplicate"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return (initial, "") if body[-1] in ".!?" else (initial.upper(), "truncated")


def repaired(rows: list[tuple[str, str]], audit: str, state: str) -> list[str]:
    """The ``role:text`` lines that the audit leaves of (role, text) rows."""
    out, at = [], 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        role, text = ("", "") if letter == "I" else rows[at]
        at += letter != "I"
        if letter != "K":
            role = ROLES["a" if state == "u" else "u"]
        state = role[:1]
        out.append(f"{role}:{text}")
    return out


class Faults:
    """Counts over rows in order: blank, duplicate, truncated and illegal neighbours."""

    def __init__(self):
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.first, self.last = 0, None, None

    def row(self, role: str, text: str, repeated: bool) -> str:
        symbol, fault = mark(role, text, repeated)
        if fault:
            self.count[fault] += 1
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        return symbol


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage: __conv (key), conv_id, turn, role, text, copies (0: dropped)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    own = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = turns.select(
        F.concat(F.when(F.col("conv_id").isNull(), "-").otherwise("+"), own[0]).alias("__conv"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (F.crc32(F.encode(F.concat(own[0], F.lit(":"), own[1]), "UTF-8")) % 20).alias("d"),
    )
    return rows.select(
        "__conv",
        "conv_id",
        "turn",
        F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("d") == 0, 0).when(F.col("d") == 3, 2).otherwise(1).alias("copies"),
    )


RESULT = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _whole(rows: DataFrame) -> DataFrame:
    """Conversations that one task holds whole: sorted by conversation and streamed."""

    def one(conv_id, rows: list[tuple]) -> tuple:
        faults, seen, turns, marks, kept = Faults(), set(), set(), [], []
        for turn, role, text, copies in rows:
            for _ in range(copies):
                marks.append(faults.row(role, text, (role, text) in seen))
                seen.add((role, text))
                kept.append((role, text))
                turns.add(turn)
        turns.discard(None)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = final(extend({"": (0, "")}, "".join(marks)))
        digest = hashlib.sha256("\n".join(repaired(kept, audit, "")).encode()).hexdigest()
        return conv_id, gaps, *faults.count.values(), faults.illegal, cost, audit, digest

    kind = rows.schema["conv_id"].dataType.simpleString()
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, conv_id, held, id_type = None, None, [], None
        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), *map(pa.array, cols[1:])], names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            cols = [batch.column(c).to_pylist() for c in ("__conv", "conv_id", "turn", "role", "text", "copies")]
            for conv, own, *row in zip(*cols):
                if conv != key:
                    if key is not None:
                        out.append(one(conv_id, held))
                    key, conv_id, held = conv, own, []
                    if len(out) >= 2_000:
                        yield packed()
                held.append(row)
        if key is not None:
            out.append(one(conv_id, held))
        if out:
            yield packed()

    order = ["__conv", F.asc_nulls_first("turn"), "role", F.sha2("text", 256)]
    return map_batches(rows.repartition("__conv").sortWithinPartitions(*order), run, RESULT.format(id=kind))


def _by_key(df: DataFrame, keys: list[str], order: list[str], columns: list[str], fn, schema: str) -> DataFrame:
    """Stream the rows of each key in order through ``fn(rows)``, which gives one output row."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in [*keys, *columns])))
        key, held = None, None
        for r in rows:
            if r[: len(keys)] != key:
                if held is not None:
                    yield _one_row((*key, *held.end()), arrow)
                key, held = r[: len(keys)], fn()
            held.add(*r[len(keys) :])
        if held is not None:
            yield _one_row((*key, *held.end()), arrow)

    return map_batches(df.repartition(*keys).sortWithinPartitions(*keys, *order), run, schema)


def _one_row(row: tuple, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)


class _Segment:
    """Alignments of a segment from every state to every state, and its counts."""

    def __init__(self):
        self.faults, self.marks = Faults(), []

    def add(self, role, text, copies, repeated) -> None:
        for i in range(copies):
            self.marks.append(self.faults.row(role, text, repeated or i > 0))

    def end(self) -> tuple:
        marks, ways = "".join(self.marks), []
        for entry in STATES:
            for end, (cost, audit) in extend({entry: (0, "")}, marks).items():
                ways.append({"entry": entry, "end": end, "cost": cost, "audit": audit})
        f = self.faults
        return *f.count.values(), f.illegal, f.first, f.last, ways


class _Joined:
    """The segments of one conversation put together."""

    def __init__(self):
        self.counts, self.last = [0, 0, 0, 0], None
        self.reached = {"": (0, "", None)}

    def add(self, seg, blank, duplicate, truncated, illegal, first, last, ways) -> None:
        between = self.last is not None and self.last + first not in ("su", "ua", "au")
        self.counts = [a + b for a, b in zip(self.counts, (blank, duplicate, truncated, illegal + between))]
        self.last = last
        after = {}
        for w in ways:
            if w["entry"] in self.reached:
                cost, audit, path = self.reached[w["entry"]]
                way = (cost + w["cost"], audit + w["audit"], (path, seg, w["entry"], w["audit"]))
                if w["end"] not in after or way[:2] < after[w["end"]][:2]:
                    after[w["end"]] = way
        self.reached = after

    def end(self) -> tuple:
        cost, audit, path = min((self.reached[end] for end in ("", "a") if end in self.reached), key=lambda way: way[:2])
        steps = []
        while path is not None:
            path, seg, entry, part = path
            steps.append({"seg": seg, "state": entry, "audit": part})
        return *self.counts, cost, audit, steps


class _Lines:
    """The repaired lines of a segment, given its audit and the state before it."""

    def __init__(self):
        self.rows, self.audit, self.state = [], "", ""

    def add(self, role, text, copies, audit, state) -> None:
        self.rows += [(role, text)] * copies
        self.audit, self.state = audit, state

    def end(self) -> tuple:
        lines = repaired(self.rows, self.audit, self.state)
        return "\n".join(lines), len(lines)


class _Digest:
    """SHA-256 of a conversation's lines, segment after segment."""

    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def add(self, text, lines) -> None:
        if lines:
            self.sha.update((("\n" if self.any else "") + text).encode())
            self.any = True

    def end(self) -> tuple:
        return (self.sha.hexdigest(),)


def _joined(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    return df.join(F.broadcast(other) if small(other, BROADCAST_ROWS) else other, keys, how)


def _cut(rows: DataFrame) -> DataFrame:
    """Conversations beyond SEGMENT: aligned in segments, which are then put together."""
    turn = [F.col("turn").isNotNull().cast("int").alias("__has"), F.coalesce("turn", F.lit(0)).alias("__turn")]
    same = ["__conv", "__has", "__turn", "role", "__sha"]
    # equal rows are one with their copies: all but the first are duplicates wherever they stand
    own = stored(
        rows.where("copies > 0").select("*", *turn, F.sha2("text", 256).alias("__sha"))
        .groupBy(*same).agg(F.first("text").alias("text"), F.sum("copies").cast("int").alias("copies"))
    )
    place = F.struct("__has", "__turn")
    firsts = own.groupBy("__conv", "role", "__sha").agg(F.min(place).alias("__at"), F.count("*").alias("__n")).where("__n > 1")
    marked = _joined(own, stored(firsts.drop("__n")), ["__conv", "role", "__sha"], "left").withColumn(
        "repeated", F.coalesce(F.col("__at") < place, F.lit(False))
    )
    weight = (F.col("copies") * (1 + F.floor(F.length("text") / WEIGHT_CHARS))).cast("long")
    order = ["__has", "__turn", "role", "__sha"]
    slim = ordered_scan(
        own.select(*same, weight.alias("__w")), "__conv", order, position="__pos", running_sum={"__upto": "__w"}
    ).withColumn("__seg", F.floor((F.col("__upto") - F.col("__w")) / SEGMENT))
    placed = stored(marked.join(slim.drop("__w", "__upto"), same))
    ways = "ways array<struct<entry:string,end:string,cost:bigint,audit:string>>"
    parts = stored(
        _by_key(
            placed, ["__conv", "__seg"], ["__pos"], ["role", "text", "copies", "repeated"], _Segment,
            f"__conv string, __seg long, blank long, duplicate long, truncated long, illegal long, first string, last string, {ways}",
        )
    )
    whole = stored(
        _by_key(
            parts, ["__conv"], ["__seg"], ["__seg", "blank", "duplicate", "truncated", "illegal", "first", "last", "ways"], _Joined,
            "__conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
            "steps array<struct<seg:bigint,state:string,audit:string>>",
        )
    )
    # each segment's part of the audit and the state before it
    step = F.explode("steps").alias("step")
    chosen = whole.select("__conv", step).select("__conv", F.col("step.seg").alias("__seg"), "step.state", "step.audit")
    lines = _by_key(
        _joined(placed, chosen, ["__conv", "__seg"]),
        ["__conv", "__seg"], ["__pos"], ["role", "text", "copies", "audit", "state"], _Lines,
        "__conv string, __seg long, text string, lines long",
    )
    digests = _by_key(
        lines, ["__conv"], ["__seg"], ["text", "lines"], _Digest, "__conv string, repaired_sha256 string"
    )
    gaps = rows.groupBy("__conv").agg(
        F.first("conv_id").alias("conv_id"),
        F.max(F.when(F.col("copies") > 0, F.col("turn"))).alias("last"),
        F.min(F.when(F.col("copies") > 0, F.col("turn"))).alias("first"),
        F.count_distinct(F.when(F.col("copies") > 0, F.col("turn"))).alias("n"),
    ).select("__conv", "conv_id", F.coalesce(F.col("last") - F.col("first") + 1 - F.col("n"), F.lit(0)).alias("gaps"))
    got = gaps.join(whole.drop("steps"), "__conv", "left").join(digests, "__conv", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return got.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )


def repair(turns: DataFrame) -> DataFrame:
    """Structure audits and repairs of ``damaged`` conversations: a row for every conversation.

    ``turns``: __conv, conv_id, turn, role, text, copies (how often the row stands there; 0
    if it is gone, which keeps the conversation's row).  Turns go by number, missing
    numbers first; rows of one number by role, then by the text's SHA-256.  A null
    conv_id is a conversation too.  Texts count as they are, however long.  The audit
    and the digest of a conversation are single values, so its segments' audits and
    lines come together in one task, row by row of segments.
    """
    weight = F.col("copies") * (1 + F.floor(F.length("text") / WEIGHT_CHARS))
    sizes = turns.groupBy("__conv").agg(F.sum(weight).alias("w"))
    large = stored(sizes.where(F.col("w") > SEGMENT).select("__conv"))
    if large.isEmpty():
        return _whole(turns)
    return _whole(_joined(turns, large, ["__conv"], "left_anti")).unionByName(_cut(_joined(turns, large, ["__conv"], "left_semi")))


# One pass over the grammar's states in place of alignments to lengths; the CRC-32 is taken bit by bit.
ORACLE = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') AS c,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), dealt AS (
  SELECT *, xor(list_reduce(
      list_prepend(4294967295, flatten(list_transform(string_split(k, ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))
    ), 4294967295) % 20 AS d
  FROM keyed
), hurt AS (
  SELECT c, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE d WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM dealt
), placed AS (
  SELECT *, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM hurt
), faults AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open,
    lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair
  FROM placed
), inserts AS (
  SELECT * FROM (VALUES ('', 0, ''), ('', 1, 'u'), ('', 2, 'a'), ('s', 0, 's'), ('s', 1, 'u'), ('s', 2, 'a'),
    ('u', 0, 'u'), ('u', 1, 'a'), ('a', 0, 'a'), ('a', 1, 'u')) AS t(st, n, upto)
), letters AS (
  SELECT * FROM (VALUES ('D', 2), ('K', 0), ('R', 1)) AS t(letter, price)
), walk AS (
  SELECT c, CAST(0 AS BIGINT) AS i, '' AS st, CAST(0 AS BIGINT) AS cost, '' AS audit FROM keyed GROUP BY c
  UNION ALL
  SELECT c, i, st, m.cost, m.audit FROM (
    SELECT w.c, f.i,
      CASE letter WHEN 'D' THEN upto WHEN 'K' THEN initial ELSE CASE upto WHEN 'u' THEN 'a' ELSE 'u' END END AS st,
      min({'cost': w.cost + 5 * n + price + CASE WHEN letter <> 'D' AND open THEN 5 ELSE 0 END,
           'audit': w.audit || repeat('I', n) || letter}) AS m
    FROM walk w JOIN faults f ON f.c = w.c AND f.i = w.i + 1 JOIN inserts USING (st) CROSS JOIN letters
    WHERE letter = 'D' OR (NOT blank AND NOT again AND (letter = 'R' OR upto || initial IN ('s', 'u', 'su', 'ua', 'au')))
    GROUP BY w.c, f.i, 3
  )
), ends AS (
  SELECT c, max(i) AS i FROM walk GROUP BY c
), best AS (
  SELECT w.c, min({'cost': w.cost + 5 * n, 'audit': w.audit || repeat('I', n)}) AS m
  FROM walk w JOIN ends USING (c, i) JOIN inserts USING (st) WHERE upto IN ('', 'a') GROUP BY w.c
), steps AS (
  SELECT c, p, audit[p] AS letter, len(replace(audit[1:p], 'I', '')) AS i, len(replace(audit[1:p], 'D', '')) AS j
  FROM (SELECT c, m.audit AS audit, unnest(range(1, len(m.audit) + 1)) AS p FROM best)
), made AS (
  SELECT s.*, f.role, f.text, first_value(CASE WHEN letter = 'K' THEN initial ELSE '' END) OVER (PARTITION BY s.c ORDER BY p) = 's' AS headed
  FROM steps s LEFT JOIN faults f ON f.c = s.c AND f.i = s.i AND letter <> 'I' WHERE letter <> 'D'
), fixed AS (
  SELECT c, string_agg(CASE letter WHEN 'K' THEN role ELSE CASE WHEN (j % 2 = 1) = headed THEN 'assistant' ELSE 'user' END END
    || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS body
  FROM made GROUP BY c
), counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
    count(*) FILTER (NOT blank AND NOT again AND open) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, m.cost AS cost, m.audit AS audit,
  sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM keyed) JOIN best USING (c) LEFT JOIN counts USING (c) LEFT JOIN fixed USING (c)
"""
