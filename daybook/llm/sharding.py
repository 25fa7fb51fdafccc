"""Sharding by a k-d tree over group metadata (operator 10).

Equal texts form one group, and a group is never split over shards.  Groups are
points in metadata space; the tree splits recursively at distributed weighted
medians along the widest dimension until every leaf holds its target bytes.
All medians of one tree level are found together: each round is one small
aggregate (nodes x bins rows) and narrows every node's interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import small, stored

HEAVY = 0.01
DIMENSIONS = ("first_id", "size", "text_hash")


def text_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, text_hash) per row; the text itself goes no further."""
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(text).cast("long") + 1).alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )


def _left(split: dict) -> Column:
    """Rows that go left of a split: (dim value, first_id, text_hash) up to the bound."""
    cond = F.lit(False)
    for i, (dim, value) in enumerate(split["bounds"]):
        eq = F.lit(True)
        for d, v in split["bounds"][:i]:
            eq = eq & (F.col(d) == F.lit(v))
        last = i == len(split["bounds"]) - 1
        cond = cond | (eq & ((F.col(dim) <= F.lit(value)) if last else (F.col(dim) < F.lit(value))))
    return cond


def _medians(groups: DataFrame, nodes: list[dict], tolerance: int, bins: int) -> None:
    """Find every node's split in place; one aggregate per round for all open nodes."""
    for n in nodes:
        n["bounds"], n["before"], n["open"] = [], 0, True
        n["dims"] = [n["dim"], *[d for d in DIMENSIONS if d != n["dim"]]]
        lo, hi = n["extent"][n["dim"]]
        n["lo"], n["hi"], n["at"] = lo, hi, 0
    while any(n["open"] for n in nodes):
        cases = None
        bin_col = None
        for n in nodes:
            if not n["open"]:
                continue
            dim = n["dims"][n["at"]]
            inside = F.col("node") == n["id"]
            for d, v in n["bounds"]:
                inside = inside & (F.col(d) == F.lit(v))
            inside = inside & F.col(dim).between(F.lit(n["lo"]), F.lit(n["hi"]))
            n["step"] = max(1, -(-(n["hi"] - n["lo"] + 1) // bins))
            which = F.floor(
                (F.col(dim).cast("decimal(20,0)") - F.lit(n["lo"]).cast("decimal(20,0)"))
                / F.lit(n["step"]).cast("decimal(20,0)")
            ).cast("int")
            cases = F.when(inside, F.lit(n["id"])) if cases is None else cases.when(inside, F.lit(n["id"]))
            bin_col = F.when(inside, which) if bin_col is None else bin_col.when(inside, which)
        found = (
            groups.select(cases.alias("n"), bin_col.alias("b"), "bytes")
            .where("n is not null")
            .groupBy("n", "b")
            .agg(F.sum("bytes").alias("w"))
            .collect()  # at most nodes x bins rows
        )
        per: dict[int, list] = {}
        for r in found:
            per.setdefault(r["n"], []).append((r["b"], int(r["w"])))
        for n in nodes:
            if not n["open"]:
                continue
            dim, run = n["dims"][n["at"]], n["before"]
            hist = sorted(per.get(n["id"], []))
            pick = None
            for b, w in hist:
                if run + w >= n["want"]:
                    pick = (b, w)
                    break
                run += w
            if pick is None:  # empty node, or rounding at its upper end
                n["bounds"].append((dim, n["hi"]))
                n["open"] = False
                continue
            b, w = pick
            lo = n["lo"] + b * n["step"]
            hi = min(n["hi"], lo + n["step"] - 1)
            if n["want"] - run <= tolerance and lo > n["lo"]:
                n["bounds"].append((dim, lo - 1))
                n["open"] = False
            elif run + w - n["want"] <= tolerance:
                n["bounds"].append((dim, hi))
                n["open"] = False
            elif lo == hi:
                # all of the rest shares this value: go on among them by the next dimension
                n["before"] = run
                n["bounds"].append((dim, lo))
                n["at"] += 1
                if n["at"] == len(n["dims"]):
                    # one group crosses the median: it goes to the nearer side
                    if n["want"] - run < run + w - n["want"]:
                        n["bounds"][-1] = (dim, lo - 1)
                    n["open"] = False
                else:
                    n["lo"], n["hi"] = n["extent"][n["dims"][n["at"]]]
            else:
                n["lo"], n["hi"], n["before"] = lo, hi, run


def _extents(groups: DataFrame) -> dict[int, dict]:
    rows = groups.groupBy("node").agg(
        F.sum("bytes").alias("bytes"),
        *[f(d).alias(f"{k}_{d}") for d in DIMENSIONS for k, f in (("min", F.min), ("max", F.max))],
    ).collect()  # one row per node
    return {r["node"]: r.asDict() for r in rows}


def _fill_up(load: list[int], rest: int) -> list[float]:
    """What each shard still takes of ``rest`` so that all end as level as can be."""
    level, full = 0.0, sorted(load)
    for i, at in enumerate(full):
        level = (rest + sum(full[: i + 1])) / (i + 1)
        if i + 1 == len(full) or level <= full[i + 1]:
            break
    return [max(0.0, level - x) for x in load]


def kd_shards(docs: DataFrame, shards: int, bins: int = 512, tolerance: float = 0.0005) -> DataFrame:
    """Put every row into one of ``shards`` shards of nearly equal bytes.

    Returns doc_id, size, text_crc32, shard, slot (gapless from 0 in a shard).
    Equal texts share a shard, so a single group larger than a shard's target makes
    that shard larger.  Null text counts as the empty text (size 1), null
    doc_ids are kept, an empty table gives no rows.  ``tolerance`` is the
    share of a shard's target by which a median may miss, to save rounds.
    """
    rows = stored(text_groups(docs))
    groups = stored(
        rows.groupBy("text_hash", "size")
        .agg(F.sum("size").alias("bytes"), F.min(F.coalesce("doc_id", F.lit(-1))).alias("first_id"))
        .withColumn("node", F.lit(0))
    )
    total = int(groups.agg(F.sum("bytes")).first()[0] or 0)
    # Groups above HEAVY of a shard's target (so at most shards / HEAVY of them) are dealt
    # out first, largest to the emptiest shard; the tree fills up the rest.
    limit = HEAVY * total / shards
    heavy = groups.where(F.col("bytes") > limit).orderBy(F.desc("bytes"), "first_id", "text_hash").collect()
    load = [0] * shards
    dealt = []
    for g in heavy:
        s = min(range(shards), key=lambda i: (load[i], i))
        load[s] += int(g["bytes"])
        dealt.append((g["text_hash"], g["size"], s))
    targets = _fill_up(load, total - sum(load))
    groups = groups.where(F.col("bytes") <= limit)
    first = _extents(groups)
    scale = {d: max(1, first[0][f"max_{d}"] - first[0][f"min_{d}"]) for d in DIMENSIONS} if first else {}
    slack = max(0, int(tolerance * total / max(1, shards)))
    # node id -> (first shard, number of shards); leaves have one shard
    open_nodes = {0: (0, shards)}
    leaf = {}
    next_id = 1
    while open_nodes:
        leaf |= {k: v[0] for k, v in open_nodes.items() if v[1] == 1}
        open_nodes = {k: v for k, v in open_nodes.items() if v[1] > 1}
        if not open_nodes:
            break
        extents = _extents(groups)
        nodes = []
        for k, (at, n) in open_nodes.items():
            e = extents.get(k)
            if e is None:
                leaf[k] = at  # no groups: nothing to split
                continue
            extent = {d: (e[f"min_{d}"], e[f"max_{d}"]) for d in DIMENSIONS}
            widest = max(DIMENSIONS, key=lambda d: (extent[d][1] - extent[d][0]) / scale[d])
            left, both = sum(targets[at : at + n // 2]), sum(targets[at : at + n])
            want = int(int(e["bytes"]) * left / both) if both else 0
            nodes.append({"id": k, "at0": at, "n": n, "dim": widest, "extent": extent, "want": want})
        _medians(groups, nodes, slack, bins)
        side = F.col("node")
        following = {}
        expr = None
        for x in nodes:
            a, b = next_id, next_id + 1
            next_id += 2
            following[a], following[b] = (x["at0"], x["n"] // 2), (x["at0"] + x["n"] // 2, x["n"] - x["n"] // 2)
            to = F.when(_left(x), F.lit(a)).otherwise(F.lit(b))
            mine = F.col("node") == x["id"]
            expr = F.when(mine, to) if expr is None else expr.when(mine, to)
        groups = groups.withColumn("node", side if expr is None else expr.otherwise(side))
        # one narrow pass per level; the tree is shards - 1 splits, so the plan stays small
        groups = stored(groups)
        open_nodes = following
    pairs = [F.lit(x) for kv in leaf.items() for x in kv]
    place = groups.select("text_hash", "size", F.create_map(*pairs)[F.col("node")].alias("shard"))
    if dealt:
        place = place.unionByName(
            docs.sparkSession.createDataFrame(dealt, "text_hash long, size long, shard int")
        )
    placed = rows.join(place, ["text_hash", "size"])
    return with_slots(placed.select("doc_id", "size", "text_crc32", "shard"))


def with_slots(placed: DataFrame, rows_per_part: int = 50_000) -> DataFrame:
    """Number the rows of each shard from 0 without a task per shard.

    Rows of a shard are cut by a hash of a stored row number into parts of bounded size;
    a part's rows are numbered alone, after the counts of the parts before it.
    """
    placed = stored(placed.withColumn("row", F.monotonically_increasing_id()))
    parts = max(64, placed.count() // rows_per_part)
    cut = placed.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    counts = cut.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "shard",
        "part",
        (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"),
    )
    if small(before, 200_000):
        before = F.broadcast(before)
    at = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "row")) - 1
    return (
        cut.withColumn("at", at)
        .join(before, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("before")).cast("long").alias("slot"))
    )
