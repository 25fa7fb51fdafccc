"""Ordered scans within a key that stay balanced when one key is huge.

Per-user lists (task order, kickoff numbering, activity gaps, chat segments)
need a position, the previous or next row, or a running total within a key.
A window partitioned by the key alone would put a key that holds a third of all
rows into one task.  So the keys are counted first, and

* if every key is of ordinary size, the scan is one window per key;
* otherwise each hot key's rows are cut into buckets by bounds on the order
  columns.  The bounds are values held in the plan (about one per shuffle
  partition, however large the data), so a row's bucket depends on the row
  alone; it is found by binary search.  Windows run per (key, bucket); positions, sums and neighbours carry
  over from the buckets before and after through one aggregate row a bucket.

Everything is built-in DataFrame work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

# A key is hot above this many rows and above twice an even partition's share.
HOT_ROWS = 200_000
# rows sampled for each bucket of a hot key to choose its bounds
SAMPLE = 20


def _hot_bounds(df: DataFrame, key: str, order: list[str], parts: int, hot_rows: int) -> tuple[DataFrame, int] | None:
    """(key, __bounds) of the hot keys, ordered structs of the order columns, and the most of a key; None without hot keys.

    A hot key has more than two partitions' even share, so there are fewer than half as many as
    partitions, and a bound stands for a share or more, so all keys together have about a
    bound a partition.  The rows are counted in one pass; only if a key is hot is a second one sampled.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = Observation()
    most = counts.observe(total, F.sum("__n").alias("rows")).orderBy(F.desc("__n")).limit(max(1, parts // 2)).collect()
    if not most or most[0]["__n"] <= hot_rows:
        return None
    share = max(1, (total.get["rows"] or 0) // parts)
    hot = [(r[0],) for r in most if r["__n"] > max(hot_rows, 2 * share)]
    if not hot:
        return None
    keys = df.sparkSession.createDataFrame(hot, df.select(key).schema)
    at = F.struct(*[F.col(c) for c in order])
    chance = SAMPLE / max(hot_rows, share)
    picked = (
        df.where(F.rand(17) < chance).join(F.broadcast(keys), key, "left_semi").groupBy(key).agg(F.array_sort(F.collect_set(at)).alias("__s"))
    )
    # every SAMPLE-th sampled row is a bound
    bounds = picked.select(key, F.filter("__s", lambda x, i: (i + 1) % SAMPLE == 0).alias("__bounds"))
    rows = bounds.collect()
    return df.sparkSession.createDataFrame(rows, bounds.schema), max((len(r[1]) for r in rows), default=0)


def _bucket(bounds: Column, at: Column, most: int) -> Column:
    """How many of the ordered bounds lie below ``at``, by binary search."""

    def halve(range_: Column, _: Column) -> Column:
        low, high = range_["low"], range_["high"]
        mid = F.floor((low + high) / 2).cast("int")
        lower = F.get(bounds, mid) < at
        return F.when(low >= high, range_).otherwise(
            F.struct(F.when(lower, mid + 1).otherwise(low).alias("low"), F.when(lower, high).otherwise(mid).alias("high"))
        )

    whole = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(most.bit_length())), whole, halve)["low"]


def ordered_scan(
    df: DataFrame,
    key: str,
    order: list[str],
    *,
    position: str | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    running_sum: dict[str, str] | None = None,
    last: dict[str, str] | None = None,
    switches: dict[str, tuple[list[str], Callable[[Column, Column], Column]]] | None = None,
    hot_rows: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add per-key sequence columns to ``df``.

    ``order`` columns are ascending and, with ``key``, must give a total order
    (ties make the result depend on the shuffle).  Keys and order columns must
    not be null.

    * ``position``: name of a 0-based position column within the key;
    * ``lag`` / ``lead``: ``{out: src}``, the previous / next row's ``src``;
    * ``running_sum``: ``{out: src}``, inclusive running sum of integer ``src``;
    * ``last``: ``{out: src}``, the last ``src`` that is not null among the rows before;
    * ``switches``: ``{out: (columns, differs)}``, how many rows so far (inclusive) differ from
      the row before them: ``differs(before, row)`` on structs of ``columns``, null is no.

    ``counted`` has the rows of ``df`` and maybe more, with the key and order columns; it is
    counted in place of ``df`` if that is cheaper (joins left out).

    Select the columns you need first: all columns of ``df`` are shuffled.
    """
    lag, lead, rsum = dict(lag or {}), dict(lead or {}), dict(running_sum or {})
    last, switches = dict(last or {}), dict(switches or {})
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, most = _hot_bounds((df if counted is None else counted).select(key, *order), key, order, parts, hot_rows or HOT_ROWS) or (None, 0)
    by = [key] if bounds is None else [key, "__bucket"]
    at = F.struct(*[F.col(c) for c in order])
    if bounds is not None:
        bucket = F.when(F.col("__bounds").isNull(), 0).otherwise(_bucket(F.col("__bounds"), at, most))
        df_in = df.join(F.broadcast(bounds), key, "left").withColumn("__bucket", bucket).drop("__bounds")
    else:
        df_in = df
    w = Window.partitionBy(*by).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)

    def differ(out: str, prev: Column, row: Column) -> Column:
        return F.coalesce(F.when(prev.isNotNull(), switches[out][1](prev, row)), F.lit(False)).cast("long")

    for o, (columns, _) in switches.items():
        prev = df_in.withColumn(f"__prev_{o}", F.lag(F.struct(*columns)).over(w))
        df_in = prev.withColumn(f"__flag_{o}", differ(o, F.col(f"__prev_{o}"), F.struct(*columns))).drop(f"__prev_{o}")
    marks = [F.row_number().over(w).alias("__first"), F.lead(F.lit(1)).over(w).alias("__more")]
    out = df_in.select(
        *df.columns,
        *([F.col("__bucket")] if bounds is not None else []),
        *([(F.row_number().over(w) - 1).cast("long").alias(position)] if position else []),
        *[F.sum(src).over(upto).cast("long").alias(o) for o, src in rsum.items()],
        *[F.lag(src).over(w).alias(o) for o, src in lag.items()],
        *[F.lead(src).over(w).alias(o) for o, src in lead.items()],
        *[F.last(src, ignorenulls=True).over(before).alias(o) for o, src in last.items()],
        *[F.sum(f"__flag_{o}").over(upto).alias(o) for o in switches],
        *(marks if bounds is not None else []),
    )
    if bounds is None:
        return out
    # one row a bucket of the hot keys: what it adds for the buckets after and before it
    cut = df_in.join(F.broadcast(bounds.select(key)), key, "left_semi")
    sources = sorted({*lag.values(), *lead.values()})
    row = F.struct(F.lit(True).alias("__here"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(sources)])
    buckets = cut.groupBy(key, "__bucket").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(src).alias(f"__sum_{o}") for o, src in rsum.items()],
        F.min_by(row, at).alias("__head"),
        F.max_by(row, at).alias("__tail"),
        *[F.max_by(F.col(src), F.when(F.col(src).isNotNull(), at)).alias(f"__last_{o}") for o, src in last.items()],
        *[F.sum(f"__flag_{o}").alias(f"__in_{o}") for o in switches],
        *[F.min_by(F.struct(*c), at).alias(f"__head_{o}") for o, (c, _) in switches.items()],
        *[F.max_by(F.struct(*c), at).alias(f"__tail_{o}") for o, (c, _) in switches.items()],
    )
    along = Window.partitionBy(key).orderBy("__bucket")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    for o in switches:  # and the first row of a bucket against the last of the one before
        seam = buckets.withColumn(f"__prev_{o}", F.lag(f"__tail_{o}").over(along))
        buckets = seam.withColumn(f"__seam_{o}", differ(o, F.col(f"__prev_{o}"), F.col(f"__head_{o}")))
    carry = buckets.select(
        key,
        "__bucket",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"),
        *[F.coalesce(F.sum(f"__sum_{o}").over(earlier), F.lit(0)).alias(f"__off_{o}") for o in rsum],
        F.lag("__tail").over(along).alias("__prev"),
        F.lead("__head").over(along).alias("__next"),
        *[F.last(f"__last_{o}", ignorenulls=True).over(earlier).alias(f"__last_{o}") for o in last],
        *[
            (
                F.coalesce(F.sum(f"__in_{o}").over(earlier), F.lit(0))
                + F.sum(f"__seam_{o}").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            ).alias(f"__off_{o}")
            for o in switches
        ],
    )
    # as many rows as there are bounds, and one more for each hot key
    res = out.join(F.broadcast(carry), [key, "__bucket"], "left")
    cols = [F.col(c) for c in df.columns]
    if position:
        cols.append((F.col(position) + F.coalesce("__off", F.lit(0))).alias(position))
    for o in [*rsum, *switches]:
        cols.append((F.col(o) + F.coalesce(f"__off_{o}", F.lit(0))).cast("long").alias(o))
    for o, src in lag.items():
        take = F.col("__prev.__here") & (F.col("__first") == 1)
        cols.append(F.when(take, F.col(f"__prev.v{sources.index(src)}")).otherwise(F.col(o)).alias(o))
    for o, src in lead.items():
        take = F.col("__next.__here") & F.col("__more").isNull()
        cols.append(F.when(take, F.col(f"__next.v{sources.index(src)}")).otherwise(F.col(o)).alias(o))
    for o in last:
        cols.append(F.coalesce(o, f"__last_{o}").alias(o))
    return res.select(*cols)


def ordered_text(
    df: DataFrame,
    keys: list[str],
    pos: str,
    text: str,
    sep: str,
    out: str,
    chunk_rows: int = 4096,
) -> DataFrame:
    """Join ``text`` per ``keys`` in ``pos`` order, one row per key.

    Two levels: first fixed-size chunks of ``chunk_rows`` consecutive positions
    (a hot key is spread over many tasks), then the chunk texts per key.
    A key without rows has no output row; ``pos`` must be unique per key.
    """
    parts = chunk_texts(df, keys, pos, text, sep, chunk_rows)
    return parts.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("__chunk", "__part"))), lambda x: x["__part"]),
            sep,
        ).alias(out)
    )


def chunk_texts(
    df: DataFrame, keys: list[str], pos: str, text: str, sep: str, chunk_rows: int = 4096
) -> DataFrame:
    """First level of :func:`ordered_text`: ``(keys, __chunk, __part)``."""
    return (
        df.select(*keys, pos, text, F.floor(F.col(pos) / chunk_rows).alias("__chunk"))
        .groupBy(*keys, "__chunk")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct(pos, text))), lambda x: x[text]), sep
            ).alias("__part")
        )
    )
