"""Suffix-array deduplication of repeated byte strings (operator 6).

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier.

1. Every window of ``LENGTH`` bytes has one minimiser (its smallest k-gram hash),
   so the windows fall into runs that share a minimiser occurrence; a run with
   its bytes is a context.  Equal windows have equal minimisers, hence only
   contexts of one minimiser hash can hold equal windows.
2. Contexts whose hash stands once are done.  Identical contexts are merged to
   their first occurrence before anything is shuffled by hash.
3. The distinct contexts of a hash meet in one task, which sorts their suffixes
   in two stages (suffixes smaller than their successors directly, the others
   induced by scanning the buckets) and takes adjacent common prefixes; of
   equal windows, all but the first are marked.
4. A hash with very many distinct contexts is split before that: its windows go
   in blocks, and a block's task is named by the bytes that all its windows have
   in common, so that only contexts that can match meet.  Blocks at the edge of a
   passage that very many documents hold share those bytes and differ in the bytes
   around the passage; where over ``HOT`` distinct blocks have one name, each window
   goes alone, named by all its bytes, so no task's share grows with the copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import arrow_map, map_batches, written

LENGTH = 100
GRAM = 32
CHUNK = 1 << 17
BLOCK = 8  # windows of a block of a split hash
HOT = 256  # distinct contexts of a hash from which it is split
SORT_BYTES = 1 << 20

_TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each position, by doubling."""
    h = _TABLE[data]
    width = 1
    for m in _M:
        h = h[:-width] * m + h[width:]
        width *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def window_minimisers(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all positions, per window the position of its leftmost smallest hash)."""
    h = gram_hashes(data)
    span = length - GRAM + 1
    low = np.uint64(2 * CHUNK - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width = 1
    m = key
    while width * 2 <= span:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < span:
        m = np.minimum(m[: len(key) - span + 1], m[span - width : span - width + len(key) - span + 1])
    return h, (m & low).astype(np.int64)


def contexts(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(document number, first window, windows, minimiser's distance, its hash) of all runs, chunk by chunk."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush():
        data = np.frombuffer(b"".join(x for _, _, x in held), np.uint8)
        lens = np.array([len(x) for _, _, x in held])
        ends = np.cumsum(lens)
        starts = ends - lens
        h, arg = window_minimisers(data, length)
        n = np.maximum(0, lens - length + 1)
        # windows that do not cross a document's end
        p = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
        a = arg[p]
        new = np.ones(len(p), bool)
        new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(p)))
        at = p[first]
        piece = np.searchsorted(ends, at, side="right")
        doc = np.array([d for d, _, _ in held])[piece]
        lo = at - starts[piece] + np.array([s for _, s, _ in held])[piece]
        return doc, lo, count, a[first] - at, h[a[first]].view(np.int64)

    for d, text in enumerate(texts):
        for s in range(0, max(1, len(text) - length + 1), CHUNK - length):
            part = text[s : s + CHUNK - 1]
            if len(part) < length:
                continue
            if held and size + len(part) > CHUNK:
                yield flush()
                held, size = [], 0
            held.append((d, s, part))
            size += len(part)
    if held:
        yield flush()


# A context's place in one long: first window, repeated within its document, windows, minimiser's distance.
AGAIN = 1 << 15


def _place(lo: np.ndarray, again: np.ndarray, n: np.ndarray, distance: np.ndarray) -> np.ndarray:
    return (lo.astype(np.int64) << 16) | (again.astype(np.int64) << 15) | (n.astype(np.int64) << 8) | distance


def _lo():
    return F.shiftright("at", 16)


def _n():
    return F.shiftright(F.col("at").bitwiseAND(F.lit(AGAIN - 1)), 8)


def _again():
    return F.col("at").bitwiseAND(F.lit(AGAIN)) != 0


def _scan(length: int):
    """(h, c, key, at) of all contexts: minimiser hash, context hash, document, place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                keys = part.column("key").to_numpy(zero_copy_only=False)
                texts = [(t or "").encode("utf-8", "surrogatepass") for t in part.column("text").to_pylist()]
                seen: set = set()
                before = -1
                for doc, lo, n, distance, h in contexts(texts, length):
                    again = np.zeros(len(doc), bool)
                    ctx = np.empty(len(doc), np.uint64)
                    for j, (d, a, k) in enumerate(zip(doc.tolist(), lo.tolist(), n.tolist())):
                        x = digest(texts[d][a : a + k + length - 1])
                        ctx[j] = x
                        if d != before:
                            seen.clear()
                            before = d
                        again[j] = x in seen
                        seen.add(x)
                    yield pa.RecordBatch.from_pydict(
                        {"h": h, "c": ctx.view(np.int64), "key": keys[doc], "at": _place(lo, again, n, distance)}
                    )

    return run


def suffix_order(t: np.ndarray, starts: np.ndarray, lens: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Two-stage order of the suffixes of all contexts in ``t``.

    Only the suffixes at window starts, and after the last one up to the next
    suffix that is smaller than its successor, take part; a context's end is
    smaller than any byte.
    """
    total = len(t)
    place = np.arange(total)
    last = np.zeros(total, bool)
    last[starts + lens - 1] = True
    after = np.append(t[1:], 0).astype(np.int16)
    after[last] = -1
    change = after != t
    turn = np.minimum.accumulate(np.where(change, place, total)[::-1])[::-1]
    # smaller than the successor: the next different byte is larger (or none comes within the length)
    up = (after[turn] > t[turn]) | (turn - place + 1 >= length)
    next_up = np.minimum.accumulate(np.where(up, place, total)[::-1])[::-1]
    end = np.minimum(next_up[starts + n - 1], starts + lens - 1)
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, end + 1, -1)
    chosen = np.cumsum(cover[:-1]) > 0
    # first stage: sort the smaller-than-successor suffixes by their bytes
    direct = np.flatnonzero(chosen & up)
    stop = np.repeat(starts + lens, lens)
    wide = -(-length // 8) * 8
    grams = np.zeros((len(direct), wide), np.uint8)
    for j in range(length):
        at = direct + j
        ok = at < stop[direct]
        grams[ok, j] = t[at[ok]]
    direct = direct[np.argsort(grams.reshape(-1).view(f"S{wide}"), kind="stable")] if len(direct) else direct
    direct_by_byte = np.searchsorted(t[direct], np.arange(257))
    # second stage: scan the buckets in order; each suffix places its larger predecessor
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    first = np.zeros(total + 1, bool)
    first[starts] = True

    def induce(done: np.ndarray, above: int) -> None:
        before = done[~first[done]] - 1
        before = before[chosen[before]]
        byte = t[before]
        go = byte > above if above >= 0 else np.ones(len(before), bool)
        before, byte = before[go], byte[go]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(before, cuts):
            if len(part):
                pending[t[part[0]]].append(part)

    closing = (starts + lens - 1)[chosen[starts + lens - 1] & ~up[starts + lens - 1]]
    for b in np.unique(t[closing]).tolist():
        pending[b].append(closing[t[closing] == b])
    out = []
    for b in range(256):
        larger = pending[b]
        wave = np.concatenate(larger) if larger else np.zeros(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            prev = wave[~first[wave]] - 1
            wave = prev[chosen[prev] & ~up[prev] & (t[prev] == b)]
        bucket.append(direct[direct_by_byte[b] : direct_by_byte[b + 1]])
        whole = np.concatenate(bucket)
        if len(whole):
            out.append(whole)
            induce(whole, b)
        pending[b] = []
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_windows(
    ctx: list[bytes], n: np.ndarray, key: np.ndarray, lo: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray]:
    """(key, window start) of all windows that equal an earlier window of these contexts."""
    t = np.frombuffer(b"".join(ctx), np.uint8)
    lens = np.array([len(c) for c in ctx])
    starts = np.cumsum(lens) - lens
    order = suffix_order(t, starts, lens, n, length)
    owner = np.searchsorted(starts, order, side="right") - 1
    rel = order - starts[owner]
    window = rel < n[owner]
    order, owner, rel = order[window], owner[window], rel[window]
    same = np.zeros(len(order), bool)
    step = 10_000
    offsets = np.arange(length)
    for i in range(1, len(order), step):
        a = order[i - 1 : i + step]
        bytes_ = t[a[:, None] + offsets[None, :]]
        differ = bytes_[1:] != bytes_[:-1]
        prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), length)  # common prefix with the one before
        same[i : i + len(prefix)] = prefix >= length
    group = np.cumsum(~same)
    k, p = key[owner], lo[owner] + rel
    by = np.lexsort((p, k, group))
    later = np.zeros(len(by), bool)
    later[by[1:]] = group[by[1:]] == group[by[:-1]]
    return k[later], p[later]


def _intervals(key: np.ndarray, p: np.ndarray, length: int) -> dict:
    by = np.lexsort((p, key))
    key, p = key[by], p[by]
    new = np.ones(len(p), bool)
    new[1:] = (key[1:] != key[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(p) - 1) if len(p) else first
    return {"key": key[first], "start": p[first], "end": p[last] + length}


def _sort_contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush(rows):
            key = np.array([r[1] for r in rows], np.int64)
            lo = np.array([r[2] for r in rows], np.int64)
            ctx = [r[3] for r in rows]
            n = np.array([len(c) for c in ctx]) - length + 1
            k, p = repeated_windows(ctx, n, key, lo, length)
            return pa.RecordBatch.from_pydict(_intervals(k, p, length)) if len(k) else None

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("bucket", "key", "lo", "ctx")]
            for row in zip(*cols):
                # a block ends between buckets only
                if size >= SORT_BYTES and row[0] != held[-1][0]:
                    out = flush(held)
                    held, size = [], 0
                    if out is not None:
                        yield out
                held.append(row)
                size += len(row[3])
        if held:
            out = flush(held)
            if out is not None:
                yield out

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _split(raw: bytes, h: int, lo: int, n: int, pos: int, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(name, context hash, first window, bytes) of a context's blocks of windows.

    Blocks lie at fixed distances from the minimiser, so equal windows stand in
    equal blocks; the name is made of the bytes that all windows of a full block share.
    """
    at = lo
    while at < lo + n:
        base = at - (at - pos) % BLOCK
        to = min(lo + n, base + BLOCK)
        core = raw[base + BLOCK - 1 : base + length]
        ctx = raw[at : to + length - 1]
        name = xxhash.xxh3_64_intdigest(core, pos - base) ^ (h & (1 << 64) - 1)
        yield _signed(name), _signed(xxhash.xxh3_64_intdigest(ctx, at - base)), at, ctx
        at = to


def _fetch(length: int):
    """Bytes of the wanted contexts (bucket, c, key, lo, ctx, split, again); repeats within a document without bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                rows: list[tuple] = []
                for key, text, wanted in zip(*(part.column(x).to_pylist() for x in ("key", "text", "wanted"))):
                    raw = text.encode("utf-8", "surrogatepass")
                    seen: set = set()
                    for w in sorted(wanted, key=lambda w: w["at"]):
                        lo, n, h = w["at"] >> 16, (w["at"] & (AGAIN - 1)) >> 8, w["h"]
                        if not w["split"]:
                            rows.append((h, 0, key, lo, n, raw[lo : lo + n + length - 1], False, False))
                            continue
                        for name, c, a, ctx in _split(raw, h, lo, n, lo + (w["at"] & 255), length):
                            again = (name, c) in seen
                            seen.add((name, c))
                            rows.append((name, c, key, a, len(ctx) - length + 1, None if again else ctx, True, again))
                if rows:
                    cols = list(zip(*rows))
                    names = ("bucket", "c", "key", "lo", "n", "ctx", "split", "again")
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_())
                    yield pa.RecordBatch.from_pydict({x: pa.array(c, k) for x, c, k in zip(names, cols, kinds)})

    return run


def _single_windows(length: int):
    """(w1, w2, key, lo): the digest of every window of the contexts, each once a document and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, keys, places = [], [], []
            for key, lo, ctx in zip(*(batch.column(x).to_pylist() for x in ("key", "lo", "ctx"))):
                for i in range(len(ctx) - length + 1):
                    digests.append(xxhash.xxh3_128_digest(ctx[i : i + length]))
                    keys.append(key)
                    places.append(lo + i)
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict(
                {"w1": halves[:, 0], "w2": halves[:, 1], "key": pa.array(keys, pa.int64()), "lo": pa.array(places, pa.int64())}
            )

    return run


def uncrowded(first_blocks: DataFrame, length: int) -> tuple[DataFrame, DataFrame | None]:
    """The blocks (bucket, key, lo, ctx) of buckets that one task sorts, and the marks of all other buckets.

    The first of equal windows is the one with the least (key, lo).
    """
    crowded = written(
        first_blocks.groupBy("bucket").agg(F.count("*").alias("k")).where(F.col("k") > HOT).select(F.col("bucket").alias("b"))
    )
    todo = first_blocks.select("bucket", "key", "lo", "ctx")
    if crowded.isEmpty():
        return todo, None
    in_crowd = F.col("bucket") == F.col("b")
    alone = todo.join(crowded, in_crowd, "left_semi").select("key", "lo", "ctx")
    windows = written(map_batches(alone, _single_windows(length), "w1 long, w2 long, key long, lo long"))
    at = F.struct("key", "lo")
    firsts = windows.groupBy("w1", "w2").agg(F.min(at).alias("first"), F.count("*").alias("k")).where("k > 1")
    firsts = firsts.select(F.col("w1").alias("f1"), F.col("w2").alias("f2"), "first")
    later = windows.join(firsts, (F.col("w1") == F.col("f1")) & (F.col("w2") == F.col("f2"))).where(at != F.col("first"))
    marks = later.select("key", F.col("lo").alias("start"), (F.col("lo") + F.lit(length)).alias("end"))
    return todo.join(crowded, in_crowd, "left_anti"), marks


def repeats(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, start, end): byte intervals of ``rows`` (key long, unique; text) that are repeated from earlier.

    Earlier means a smaller key, or the same key and an earlier start.
    """
    own = rows.select("key", "text")
    seen = map_batches(own, _scan(length), "h long, c long, key long, at long")
    twice = written(
        seen.where(~_again()).groupBy("h").agg(F.count("*").alias("k")).where("k >= 2").select(F.col("h").alias("twice"))
    )
    found = written(
        seen.join(twice, F.col("h") == F.col("twice"), "left").where(_again() | F.col("twice").isNotNull()).drop("twice")
    )
    firsts = written(
        found.where(~_again())
        .groupBy("h", "c")
        .agg(F.min("key").alias("key"), F.min_by("at", "key").alias("at"), F.count("*").alias("copies"))
    )
    interval = ("key", _lo().alias("start"), (_lo() + _n() + F.lit(length - 1)).alias("end"))
    marks = [found.where(_again()).select(*interval)]
    # a context that stands earlier as a whole
    copied = firsts.where("copies > 1").select(F.col("h").alias("h1"), F.col("c").alias("c1"), F.col("key").alias("key1"))
    later = found.where(~_again()).join(copied, (F.col("h") == F.col("h1")) & (F.col("c") == F.col("c1")))
    marks.append(later.where("key <> key1").select(*interval))
    # distinct contexts of one hash go through the suffix sort
    several = written(firsts.groupBy("h").agg(F.count("*").alias("k")).where("k >= 2").withColumnRenamed("h", "h2"))
    wanted = (
        firsts.join(several, F.col("h") == F.col("h2"))
        .groupBy("key")
        .agg(F.collect_list(F.struct("h", "at", (F.col("k") > HOT).alias("split"))).alias("wanted"))
    )
    fetched = written(
        map_batches(
            own.join(wanted, "key").select("key", "text", "wanted"),
            _fetch(length),
            "bucket long, c long, key long, lo long, n long, ctx binary, split boolean, again boolean",
        )
    )
    place = ("key", F.col("lo").alias("start"), (F.col("lo") + F.col("n") + F.lit(length - 1)).alias("end"))
    kind = "key long, start long, end long"
    todo = fetched.where("not split").select("bucket", "key", "lo", "ctx")
    blocks = fetched.where("split and not again")
    if not blocks.isEmpty():
        marks.append(fetched.where("again").select(*place))
        first_blocks = written(
            blocks.groupBy("bucket", "c").agg(
                F.min("key").alias("key"), F.min_by("lo", "key").alias("lo"), F.first("ctx").alias("ctx")
            )
        )
        known = first_blocks.select(
            F.col("bucket").alias("bucket1"), F.col("c").alias("c1"), F.col("key").alias("key1")
        )
        again = blocks.join(known, (F.col("bucket") == F.col("bucket1")) & (F.col("c") == F.col("c1")))
        marks.append(again.where("key <> key1").select(*place))
        small_buckets, crowded = uncrowded(first_blocks, length)
        todo = todo.unionByName(small_buckets)
        if crowded is not None:
            marks.append(crowded)
    sorted_todo = todo.repartition("bucket").sortWithinPartitions("bucket")
    marks.append(map_batches(sorted_todo, _sort_contexts(length), kind))
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """Add ``__key``: doc_id itself, or, if ids are missing or repeated, the row's place by (doc_id, text)."""
    r = docs.agg(
        F.count("*").alias("n"), F.count("doc_id").alias("some"), F.count_distinct("doc_id").alias("distinct")
    ).first()
    if r["n"] == r["some"] == r["distinct"]:
        return docs.withColumn("__key", F.col("doc_id").cast("long"))
    return written(docs.orderBy("doc_id", "text").withColumn("__key", F.monotonically_increasing_id()))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def with_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` and ``__spans``: the byte intervals to remove (null if none; not merged).

    Nulls are empty texts.  Rows that share a doc_id, or have none, are taken in
    the order of their texts.
    """
    keyed = _keyed(docs)
    rows = keyed.select(F.col("__key").alias("key"), F.col("text").cast("string").alias("text"))
    marks = repeats(rows.where("text is not null"), length)
    spans = marks.groupBy(F.col("key").alias("__key")).agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
    return keyed.join(spans, "__key", "left").drop("__key")


def dedup_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {x: [] for x in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist()):
            raw = (text or "").encode("utf-8", "surrogatepass")
            merged = merge_spans([(s["start"], s["end"]) for s in spans or []])
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(sum(b - a for a, b in merged))
            out["n_spans"].append(len(merged))
            out["kept_sha256"].append(hashlib.sha256(without(raw, merged)).hexdigest())
        return {"doc_id": batch.column("doc_id")} | out

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(
        with_spans(own, length),
        run,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )


def dedup_texts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with the repeated bytes cut out of ``text`` (a character that is cut in part goes whole)."""
    names = docs.columns
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batch: pa.RecordBatch) -> dict:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist()):
            if spans:
                raw = text.encode("utf-8", "surrogatepass")
                text = without(raw, merge_spans([(s["start"], s["end"]) for s in spans])).decode("utf-8", "ignore")
            texts.append(text)
        return {c: batch.column(c) for c in names} | {"text": pa.array(texts, pa.string())}

    return arrow_map(with_spans(docs, length).select(*names, "__spans"), run, kind)
