"""SimHash near-duplicates by anchor-point covering (operator 5).

The anchors are the words of a product of two binary Golay codes over the first
46 fingerprint bits.  Every point lies within 3 bits of its block's anchor
(covering radius), so of two fingerprints within the threshold, the second lies
within radius plus threshold of the first one's anchor: each fingerprint is
written at home at its own anchor, and as a visitor at every anchor within that
reach.  All comparisons happen per anchor, on all 64 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import arrow_map, map_batches, small, stored

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEED = 42
HOT_HOMES = 20_000  # fingerprints at home at one anchor from which it is split
BITS = 23  # length of a Golay block; 12 of its bits are free
RADIUS = 3
GENERATOR = 0b101011100011


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles: bit set if set in over half of their hashes."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
    words = WORDS.findall(raw)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    h = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())), "<u8", n
    )
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 65_536):
        part = h[i : i + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum())


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


@cache
def golay() -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(syndrome part of the upper 12 bits, per syndrome the near words' errors and excess distances)."""
    check = np.zeros(1 << 12, np.uint32)
    for v in range(1 << 12):
        r = v << 11
        for bit in range(22, 10, -1):
            if r >> bit & 1:
                r ^= GENERATOR << (bit - 11)
        check[v] = r
    near: list[list[tuple[int, int]]] = [[] for _ in range(1 << 11)]
    for weight in range(RADIUS + 3):
        for bits in combinations(range(BITS), weight):
            e = sum(1 << b for b in bits)
            near[int(check[e >> 11]) ^ (e & 0x7FF)].append((max(0, weight - RADIUS), e))
    return check, [
        (np.array([e for _, e in sorted(x)], np.uint32), np.array([d for d, _ in sorted(x)], np.int8)) for x in near
    ]


@cache
def _near_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    check, near = golay()
    width = max(len(e) for e, _ in near)
    errors = np.zeros((len(near), width), np.uint32)
    excess = np.full((len(near), width), 9, np.int8)
    for s, (e, d) in enumerate(near):
        errors[s, : len(e)], excess[s, : len(e)] = e, d
    return check, errors, excess


def anchors(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of all anchors within radius plus ``threshold`` (0 to 2) of each fingerprint.

    An anchor is the 12 + 12 free bits of its two code words; the first one of
    each row, at which both blocks are within the radius, is its home.
    """
    check, errors, excess = _near_table()
    blocks = []
    for shift in (0, BITS):
        y = ((fp >> np.uint64(shift)) & np.uint64((1 << BITS) - 1)).astype(np.uint32)
        syndrome = check[y >> 11] ^ (y & 0x7FF)
        blocks.append(((y[:, None] ^ errors[syndrome]) >> 11, excess[syndrome]))
    (a, da), (b, db) = blocks
    row, i, j = np.nonzero(da[:, :, None] + db[:, None, :] <= threshold)
    where = (a[row, i].astype(np.int64) << 12) | b[row, j]
    return row, where, (da[row, i] + db[row, j]) == 0


def _visits(threshold: int):
    def run(batch: pa.RecordBatch) -> dict:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        rows, wheres, homes = [], [], []
        for i in range(0, len(fp), 2_000):
            row, where, home = anchors(fp[i : i + 2_000].view(np.uint64), threshold)
            rows.append(row + i)
            wheres.append(where)
            homes.append(home)
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        return {
            "anchor": np.concatenate(wheres) if wheres else np.zeros(0, np.int64),
            "fp": fp[row],
            "home": np.concatenate(homes) if homes else np.zeros(0, bool),
        }

    return run


def _homes(batch: pa.RecordBatch) -> dict:
    fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
    return {"anchor": np.concatenate([anchors(fp[i : i + 20_000], 0)[1] for i in range(0, len(fp), 20_000)])}


def _split_visits(threshold: int):
    """Anchors of the last 23 bits as well, for the visits of one split anchor."""

    def run(batch: pa.RecordBatch) -> dict:
        check, errors, excess = _near_table()
        where, fp, home = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "fp", "home"))
        y = (fp.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.uint32)
        syndrome = check[y >> 11] ^ (y & 0x7FF)
        row, i = np.nonzero(excess[syndrome] <= threshold)
        word = (y[row] ^ errors[syndrome[row], i]) >> 11
        return {
            "anchor": (np.int64(1) << 40) | (where[row] << 12) | word.astype(np.int64),
            "fp": fp[row],
            "home": home[row] & (excess[syndrome[row], i] == 0),
        }

    return run


def _bucket_links(home: np.ndarray, guest: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between one anchor's own fingerprints and its visitors."""
    everyone = np.unique(np.concatenate([home, guest]))
    label = np.arange(len(everyone))
    step = max(1, 2_000_000 // max(1, len(everyone)))
    found_a, found_b = [], []
    for i in range(0, len(home), step):
        block = home[i : i + step]
        near = np.bitwise_count((block[:, None] ^ everyone[None, :]).view(np.uint64)) <= threshold
        u, v = np.nonzero(near)
        u = np.searchsorted(everyone, block)[u]
        keep = label[u] != label[v]
        u, v = u[keep], v[keep]
        while len(u):
            # hook the larger of two labels under the smaller, then shorten
            lu, lv = label[u], label[v]
            low, high = np.minimum(lu, lv), np.maximum(lu, lv)
            order = np.lexsort((low, high))
            first = np.concatenate([[True], high[order][1:] != high[order][:-1]])
            pick = order[first]
            found_a.append(everyone[u[pick]])
            found_b.append(everyone[v[pick]])
            label[high[pick]] = low[pick]
            while True:
                again = label[label]
                if np.array_equal(again, label):
                    break
                label = again
            keep = label[u] != label[v]
            u, v = u[keep], v[keep]
    if not found_a:
        return home[:0], home[:0]
    return np.concatenate(found_a), np.concatenate(found_b)


def _links(threshold: int):
    """Compare per anchor; input batches are sorted by anchor."""

    def compare(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch | None:
        cut = np.flatnonzero(np.diff(anchor)) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(anchor)]])
        size = ends - starts
        homes = np.add.reduceat(home.astype(np.int64), starts)
        out_a, out_b = [], []
        plain = (homes > 0) & (size > 1) & (homes * size <= 4_096)
        # small anchors side by side: pairs (home row, any row of the same anchor)
        row = np.repeat(plain, size) & home
        h = np.flatnonzero(row)
        if len(h):
            own = np.searchsorted(ends, h, side="right")
            for i in range(0, len(h), 20_000):
                hh, oo = h[i : i + 20_000], own[i : i + 20_000]
                n = size[oo]
                left = np.repeat(hh, n)
                right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[oo], n)
                near = (np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= threshold) & (fp[left] != fp[right])
                out_a.append(fp[left[near]])
                out_b.append(fp[right[near]])
        for g in np.flatnonzero((homes > 0) & (size > 1) & ~plain):
            f, o = fp[starts[g] : ends[g]], home[starts[g] : ends[g]]
            a, b = _bucket_links(f[o], f[~o], threshold)
            out_a.append(a)
            out_b.append(b)
        if not out_a:
            return None
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        low, high = np.minimum(a, b), np.maximum(a, b)
        u = np.unique(np.stack([low, high], axis=1), axis=0)
        return pa.RecordBatch.from_pydict({"a": u[:, 0], "b": u[:, 1]}) if len(u) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "fp", "home"))
            last = int(np.searchsorted(now[0], now[0][-1], side="left"))
            if last == 0 and held and held[-1][0][-1] == now[0][-1]:
                held.append(now)  # one anchor goes on
                continue
            ready = [*held, tuple(x[:last] for x in now)]
            whole = tuple(np.concatenate([x[i] for x in ready]) for i in range(3))
            if len(whole[0]):
                out = compare(*whole)
                if out is not None:
                    yield out
            held = [tuple(x[last:] for x in now)]
        if held:
            out = compare(*(np.concatenate([x[i] for x in held]) for i in range(3)))
            if out is not None:
                yield out

    return run


VISIT = "anchor long, fp long, home boolean"


def links(fps: DataFrame, threshold: int, hot: int = HOT_HOMES) -> DataFrame:
    """(a, b): enough pairs of linked fingerprints to connect all that are linked.

    An anchor that is home to more than ``hot`` fingerprints is split by the
    anchors of a third code word over the last 23 bits.
    """
    visits = arrow_map(fps.select("fp"), _visits(threshold), VISIT)
    full = stored(
        arrow_map(fps.select("fp"), _homes, "anchor long").groupBy("anchor").count().where(F.col("count") > hot)
    )
    if not full.isEmpty():
        names = full.select(F.col("anchor").alias("full"))
        if small(names, 500_000):
            names = F.broadcast(names)
        told = visits.join(names, F.col("anchor") == F.col("full"), "left")
        split = arrow_map(told.where("full is not null").drop("full"), _split_visits(threshold), VISIT)
        visits = told.where("full is null").drop("full").unionByName(split)
    return map_batches(
        visits.repartition("anchor").sortWithinPartitions("anchor"), _links(threshold), "a long, b long"
    )


def components(edges: DataFrame, nodes_a: str = "a", nodes_b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) of all nodes with links; root is the smallest node of the component.

    Alternating large-star and small-star steps; each round is stored, and the
    rounds needed grow with the logarithm of the largest component.
    """
    pairs = stored(edges.select(F.col(nodes_a).alias("u"), F.col(nodes_b).alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour goes to the smallest neighbour (or the node itself)
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        low2 = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = low2.groupBy("u").agg(F.min("v").alias("m"))
        joined = low2.join(least, "u")
        pairs = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        pairs = stored(pairs)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        fp = [signed(fingerprint(t, shingle)) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "fp": pa.array(fp, pa.int64())}

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(own, run, "doc_id long, fp long")


def simhash_components(docs: DataFrame, threshold: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row.

    Fingerprints at ``threshold`` or fewer differing bits are linked;
    component_id is the smallest doc_id reachable.  Texts without words (also
    null) have fingerprint zero and link like others; null doc_ids are kept and
    never name a component unless it has no other id.  Links are found between
    distinct fingerprints, so copies cost nothing.
    """
    if not 0 <= threshold <= 2:
        raise ValueError("the anchor code covers thresholds 0 to 2")
    found = stored(fingerprints(docs, shingle))
    distinct = found.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    distinct = stored(distinct)
    member = components(links(distinct, threshold))
    # the component's smallest doc_id, by its root fingerprint
    linked = member.join(distinct, member["node"] == distinct["fp"]).select("fp", "root", "first_id")
    names = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = stored(linked.join(names, "root").select("fp", "component_id"))
    # stored, so that the last join has plain exchanges and a hot fingerprint can be split
    named = stored(
        distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    )
    return found.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
