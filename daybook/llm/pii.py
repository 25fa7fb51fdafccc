"""Personal data by rules and bootstrapped contexts (operator 12); DataFrame functions only.

Rules give the base spans.  Their values are the seeds of a bootstrap: every
identifier-like string of the corpus (rule matches, addresses and numbers the rules
reject) is an instance, the words around it are its lexical patterns, and the two
form a graph.  In rounds, a pattern's confidence for a kind is the share of its
distinct instances known to be of that kind, and an instance's score is the noisy-or
of its trusted patterns; instances above the threshold count for patterns in the
next round.  The strings the rules miss that end above the threshold are added spans.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import once, small, stored

KINDS = ("email", "ip", "card", "phone")
# The rules, with possessive repeats and run starts so that long runs are read once:
# a match can only start where its run of characters starts or the last match ended.
LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
RULES = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # shorter digit runs fail the count of digits anyway
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Strings that look like an identifier: written-out addresses, IPv6, runs of four digits or more.
NAME, DOT = r"[\p{L}0-9._%+-]", r"(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20)"
AT = r"(?:@|\(at\)|\[at\]|\bat(?=\x20[\p{L}0-9-]++\x20dot\x20))"
CANDIDATE = "|".join(
    (
        rf"(?:(?<!{NAME})|\G){NAME}++\x20?{AT}\x20?[\p{{L}}0-9-]++(?:{DOT}[\p{{L}}0-9-]++)*+",
        r"(?<![\p{L}\p{N}:])(?=[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{1,4}){0,6}::|(?:[0-9A-Fa-f]{1,4}:){7})"
        r"[0-9A-Fa-f:]{3,39}(?![\p{L}\p{N}:])",
        r"(?<![\p{L}\p{N}()./+-])(?<![0-9()./-]\x20)[+(]{0,2}[0-9](?:[\x20()./-]{0,2}[0-9]){3,}+(?![\p{L}\p{N}])",
    )
)
CONTEXT = 120  # characters next to an identifier in which its context words stand
CONFIDENCE = 0.8  # least share of a pattern's instances, and least score of an added one
SUPPORT = 3  # least number of known instances of a trusted pattern
ROUNDS = 6
BROADCAST_ROWS = 200_000
STEP = 256


def positions(pieces: Column, matches: Column) -> Column:
    """Start of every match, given the texts between matches (one more than matches).

    Sums before a match are taken over whole steps and the rest of its step, so a text with
    very many matches stays affordable.
    """

    def lengths(t: Column) -> Column:
        gap = F.transform(t["m"], lambda m: F.length(m))
        return F.zip_with(
            F.transform(t["p"], lambda p: F.length(p)), gap, lambda p, m: F.struct(p.alias("p"), F.coalesce(m, F.lit(0)).alias("m"))
        )

    def steps(sizes: Column) -> Column:
        sums = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / STEP).cast("int")),
            lambda k: F.aggregate(F.slice(sizes, k * STEP + 1, STEP), F.lit(0), lambda s, x: s + x["p"] + x["m"]),
        )
        return F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def starts(both: Column) -> Column:
        def start(x: Column, i: Column) -> Column:
            rest = F.aggregate(F.slice(both["sizes"], i - i % STEP + 1, i % STEP), F.lit(0), lambda s, y: s + y["p"] + y["m"])
            return F.get(both["before"], F.floor(i / STEP).cast("int")) + rest + x["p"]

        return F.transform(both["sizes"], start)  # one more than matches: the end of the text

    def all_starts(sizes: Column) -> Column:
        return once(F.struct(sizes.alias("sizes"), steps(sizes).alias("before")), starts)

    return once(F.struct(pieces.alias("p"), matches.alias("m")), lambda t: once(lengths(t), all_starts))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The check digit of a string of digits holds."""

    def step(total: Column, i: Column) -> Column:
        d = F.substring(number, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """What a rule asks of a match beyond its pattern."""
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        number = digits(value)
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with __base: the rules' spans as structs (start, kind number, end), in that order."""
    out = docs
    for kind in KINDS:
        out = out.withColumn(f"__p_{kind}", F.split(text, RULES[kind], -1))
    for kind in KINDS:
        none = F.array().cast("array<string>")
        found = F.when(F.size(f"__p_{kind}") > 1, F.regexp_extract_all(text, F.lit(RULES[kind]), F.lit(0))).otherwise(none)
        out = out.withColumn(f"__m_{kind}", found)
    kind_of = "array<struct<start:int,kind:int,end:int>>"

    def spans(no: int, kind: str) -> Column:
        m, p = F.col(f"__m_{kind}"), F.col(f"__p_{kind}")

        def span(x: Column) -> Column:
            struct = F.struct(x["at"].alias("start"), F.lit(no).alias("kind"), (x["at"] + F.length(x["m"])).alias("end"))
            return F.when(holds(kind, x["m"]), struct)

        zipped = F.transform(F.slice(F.arrays_zip(m.alias("m"), positions(p, m).alias("at")), 1, F.size(m)), span)
        return F.when(F.size(m) > 0, F.array_compact(zipped).cast(kind_of)).otherwise(F.array().cast(kind_of))

    out = out.withColumn("__base", F.array_sort(F.concat(*[spans(no, kind) for no, kind in enumerate(KINDS)])))
    return out.drop(*[f"__{a}_{k}" for a in "pm" for k in KINDS])


def joined_spans(spans: Column) -> Column:
    """kind:start:end of (start, kind number, end) structs, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _full(kind: str, value: Column) -> Column:
    return value.rlike(rf"\A(?:{RULES[kind]})\z") & holds(kind, value)


def _shaped(kind: str, value: Column) -> Column:
    """The value could be of this kind, if its context says so."""
    n = F.length(digits(value))
    if kind == "email":
        return value.rlike(AT)
    if kind == "ip":
        return value.rlike(r"\A[0-9]+(?:\.[0-9]+){3,}\z") | value.contains(":")
    if kind == "card":
        return value.rlike(r"\A[0-9 .-]+\z") & n.between(12, 19)
    return value.rlike(r"\A[0-9 ()./+-]+\z") & n.between(7, 15) & ~value.rlike(r"\A[0-9]+(?:\.[0-9]+){3,}\z")


def occurrences(docs: DataFrame, text: str) -> DataFrame:
    """Identifier-like strings: __key columns, start, end, seed kind, shapes (kinds it may have) and patterns."""
    pieces = F.split(text, CANDIDATE, -1)
    cut = docs.select("__doc", "__hash", F.col(text).alias("__t"), pieces.alias("p")).where(F.size("p") > 1)
    cut = cut.withColumn("m", F.regexp_extract_all("__t", F.lit(CANDIDATE), F.lit(0))).drop("__t")

    def around(t: Column) -> Column:
        last = F.size(t["p"]) - 1

        def near(m: Column, i: Column) -> Column:
            # ^ and $ stand for the ends of the text, # for another identifier
            left = F.concat(F.when(i == 0, "^ ").otherwise("# "), F.get(t["p"], i))
            right = F.concat(F.get(t["p"], i + 1), F.when(i + 1 == last, " $").otherwise(" #"))
            return F.struct(
                m.alias("value"),
                F.get(t["at"], i).alias("start"),
                F.right(left, F.lit(CONTEXT)).alias("left"),
                F.left(right, F.lit(CONTEXT)).alias("right"),
            )

        return F.transform(t["m"], near)

    told = F.struct(F.col("p"), F.col("m"), positions(F.col("p"), F.col("m")).alias("at"))
    rows = cut.select("__doc", "__hash", F.explode(once(told, around)).alias("x"))
    value = F.col("value")
    seed = F.coalesce(*[F.when(_full(k, value), F.lit(i)) for i, k in enumerate(KINDS)])
    mixed = F.lit(False)
    for k in KINDS:
        found = F.regexp_extract_all(value, F.lit(RULES[k]), F.lit(0))
        mixed = mixed | F.exists(found, partial(holds, k))
    w1, w2 = (F.lower(F.regexp_extract("left", r"(?:(\S++)\s++)?(\S++)\s*\z", g)) for g in (2, 1))
    r1 = F.lower(F.regexp_extract("right", r"\A\s*(\S++)", 1))
    return (
        rows.select("__doc", "__hash", "x.*", (F.col("x.start") + F.length("x.value")).alias("end"))
        .withColumn("seed", seed)
        .withColumn("shapes", F.when(F.col("seed").isNull() & ~mixed, F.array_compact(F.array(*[F.when(_shaped(k, value), F.lit(i)) for i, k in enumerate(KINDS)]))))
        .withColumn("patterns", F.array(F.concat(F.lit("L "), w1), F.concat_ws(" ", F.lit("LL"), w2, w1), F.concat_ws(" ", F.lit("LR"), w1, F.lit("_"), r1), F.concat(F.lit("R "), r1)))
        .select("__doc", "__hash", "start", "end", F.md5("value").alias("value"), "seed", "shapes", "patterns")
    )


def _is(i: int, kind: Column) -> Column:
    return kind == i


def _fit(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small(df, BROADCAST_ROWS) else df


def trusted_values(found: DataFrame, confidence: float, support: int, rounds: int) -> DataFrame:
    """The bootstrap: (value, kind, score) of the strings that the rules miss and the contexts tell.

    Among a pattern's instances, strings that could be of the kind but are not told yet count half.
    """
    edges = found.select("value", "seed", "shapes", F.explode("patterns").alias("pattern")).distinct()
    kinds = range(len(KINDS))
    counted = [F.count(F.when(F.col("seed") == i, 1)).alias(f"s{i}") for i in kinds]
    counted += [F.count(F.when(F.array_contains("shapes", i), 1)).alias(f"u{i}") for i in kinds]
    unseen = F.size(F.coalesce("shapes", F.array().cast("array<int>"))) > 0
    known = (
        edges.groupBy("pattern").agg(F.count("*").alias("n"), F.count(F.when(unseen, 1)).alias("u"), *counted).where("u > 0")
    )
    known = stored(
        known.select(
            "pattern", "n", F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"s{i}").alias("s"), F.col(f"u{i}").alias("u")) for i in kinds])).alias("x")
        ).select("pattern", "n", "x.*")
    )
    open_edges = stored(edges.where(unseen).select("value", "pattern", F.explode("shapes").alias("kind")))
    none = open_edges.select("value", "kind", F.lit(0.0).alias("score")).limit(0)
    scores, last = none, (0, 0.0)
    for _ in range(rounds):
        gains = open_edges.join(_fit(scores), ["value", "kind"]).groupBy("pattern", "kind").agg(F.sum("score").alias("gain"))
        gain = F.coalesce("gain", F.lit(0.0))
        total = F.col("s") + gain
        of = F.col("n") - (F.col("u") - gain) / 2
        patterns = stored(
            known.join(gains, ["pattern", "kind"], "left")
            .select("pattern", "kind", (total / of).alias("confidence"), total.alias("support"))
            .where((F.col("confidence") >= confidence) & (F.col("support") >= support))
        )
        missed = F.sum(F.log1p(-F.least("confidence", F.lit(0.999))))
        told = open_edges.join(_fit(patterns), ["pattern", "kind"]).groupBy("value", "kind").agg((1 - F.exp(missed)).alias("score"))
        best = told.groupBy("value").agg(F.max_by(F.struct("kind", "score"), F.struct("score", -F.col("kind"))).alias("b"))
        scores = stored(best.select("value", "b.kind", "b.score").where(F.col("score") >= confidence))
        now = scores.agg(F.count("*"), F.coalesce(F.sum(F.round("score", 6)), F.lit(0.0))).first()
        if (now[0], round(now[1], 6)) == last:
            break
        last = (now[0], round(now[1], 6))
    return scores


def personal_data(
    docs: DataFrame, confidence: float = CONFIDENCE, support: int = SUPPORT, rounds: int = ROUNDS
) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Spans are kind:start:end in code points, end exclusive, by start and then kind; counts and
    digest are of the base spans.  Null texts are empty; rows without an id are rows; rows
    equal in id and text have equal results.  Values are counted once for a pattern, however often
    they occur, so copies add no confidence.  An added span never overlaps a base span.
    """
    rows = docs.select(F.col("doc_id").alias("__doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    rows = rows.withColumn("__hash", F.xxhash64("__text"))
    found = stored(occurrences(rows, "__text"))
    values = trusted_values(found, confidence, support, rounds)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    new = (
        found.where(F.col("seed").isNull()).select("__doc", "__hash", "start", "end", "value").distinct()
        .join(_fit(values.select("value", "kind")), "value")
        .groupBy("__doc", "__hash").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("__new"))
        .withColumnsRenamed({"__doc": "__d", "__hash": "__h"})
    )
    base = base_spans(rows, "__text").drop("__text")
    both = base.join(_fit(stored(new)), F.col("__doc").eqNullSafe(F.col("__d")) & (F.col("__hash") == F.col("__h")), "left")
    clear = F.filter(
        F.coalesce("__new", empty),
        lambda s: ~F.exists("__base", lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])),
    )
    both = both.withColumn("__added", clear)
    kinds = F.transform("__base", lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, partial(_is, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)
    ]
    return both.select(
        F.col("__doc").alias("doc_id"),
        *counts,
        F.sha2(joined_spans(F.col("__base")), 256).alias("base_sha256"),
        joined_spans(F.array_sort(F.concat("__base", "__added"))).alias("spans"),
        F.size("__added").cast("long").alias("n_added"),
    )
