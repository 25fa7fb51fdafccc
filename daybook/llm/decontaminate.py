"""Benchmark decontamination by size-partitioned MinHash containment search (operator 3).

Items are partitioned by size: an item of under five words is one shingle of all its
words, longer ones go by powers of two of their number of five-word shingles.  Of an
item's shingle hashes the smallest ``floor((1 - t) * n) + 1`` form its MinHash
sketch: a document that contains a share t or more of the item's shingles contains at
least one of them, however long the document is, so no match can be missed.  A
document looks up its hashes in the classes of items it is long enough to contain, up
to the largest sketch hash of those.  Candidates are verified by exact shingle
containment.  Everything is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import once, small, stored

SHINGLE = 5
CONTAINMENT = 0.8
BROADCAST_ROWS = 500_000
SEPARATOR = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), lambda w: w != "")


def shingle_hashes(w: Column, n: int) -> Column:
    """Hashes of all n-word shingles; a shorter sequence has none."""
    many = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n)))
    return F.when(F.size(w) >= n, many).otherwise(F.array().cast("array<long>"))


def rank_of(h: Column) -> Column:
    """MinHash order: a second hash, so that sketches are a random choice of the shingles."""
    return F.xxhash64(h, F.lit(17))


def item_shingles(items: DataFrame, n: int = SHINGLE) -> DataFrame:
    """(item_id, h, k, n_shingles): distinct shingles of every item, of k = n words, or of all if it has fewer."""
    w = items.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    own = F.when(F.size("w") >= n, shingle_hashes(F.col("w"), n)).otherwise(F.array(F.xxhash64("w")))
    h = w.select("item_id", F.least(F.size("w"), F.lit(n)).alias("k"), F.explode(F.array_distinct(own)).alias("h"))
    # rows of one item_id are one item; its shortest row sets the words of a shingle that is looked up first
    h = h.groupBy("item_id", "h").agg(F.min("k").alias("k"))
    return h.withColumn("n_shingles", F.count("*").over(Window.partitionBy("item_id")))


def item_sketches(shingles: DataFrame, t: float, n: int = SHINGLE) -> DataFrame:
    """(h, item_id, k, need, size_class, r): the bottom hashes of each item.

    ``need`` is the least number of n-word shingles of a document that holds a share t of the item.
    """
    short = F.sum((F.col("k") < n).cast("int")).over(Window.partitionBy("item_id"))
    order = Window.partitionBy("item_id").orderBy(rank_of(F.col("h")), "h")
    keep = F.floor((1 - F.lit(t)) * F.col("n_shingles") + F.lit(1e-9)) + 1
    size_class = F.floor(F.log2("n_shingles")).cast("int").alias("size_class")
    return (
        shingles.withColumn("at", F.row_number().over(order))
        .withColumn("need", F.col("n_shingles") * F.lit(t) - short - F.lit(1e-9))
        .where(F.col("at") <= keep)
        .select("h", "item_id", "k", "need", size_class, rank_of(F.col("h")).alias("r"))
    )


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast behind a check of the size; beyond it the join shuffles both sides."""
    return F.broadcast(df) if small(df, BROADCAST_ROWS) else df


def keyed(docs: DataFrame) -> DataFrame:
    """(__key, doc_id, w): rows without an id go by their text, those of one id are one document."""
    text = F.col("text").cast("string")
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.sha2(text, 256)))
    return docs.where(F.col("text").isNotNull()).select(
        own.alias("__key"), F.col("doc_id").cast("long").alias("doc_id"), words(text).alias("w")
    )


def contaminated(
    docs: DataFrame, items: DataFrame, t: float = CONTAINMENT, n: int = SHINGLE, by_key: bool = False
) -> DataFrame:
    """Pairs (doc_id, item_id, shared, n_shingles, containment) with containment >= t.

    Shingles are distinct n-word sequences of lower-cased letter-and-digit runs; an item
    of fewer words is found where all its words stand in a row.
    Null or empty texts and items match nothing, nor do items without an id; rows of
    one doc_id count as one document, rows of one item_id as one item.  Documents without
    an id are told apart by their texts.
    """
    shingles = stored(item_shingles(items.where("item_id is not null"), n))
    sketches = stored(item_sketches(shingles, t, n))
    # one row for each shingle length and power of two
    classes = sketches.groupBy("k", "size_class").agg(F.max("r").alias("r"), F.min("need").alias("need")).collect()
    own = keyed(docs)
    # a document in several rows may hold an item that none of them is long enough for
    several = stored(own.groupBy("__key").agg(F.count("*").alias("__n")).where("__n > 1").withColumn("__several", F.lit(True)).drop("__n"))
    sized = own.withColumn("__several", F.lit(False))
    if not several.isEmpty():
        sized = own.join(_maybe_broadcast(several), "__key", "left").withColumn("__several", F.coalesce("__several", F.lit(False)))
    lengths = sorted({c["k"] for c in classes})

    def sought(k: int):
        """Words -> the k-word shingle hashes that are looked up: up to the bound of the classes the text is long enough for."""
        of_k = [c for c in classes if c["k"] == k]
        nothing = F.lit(None).cast("long")

        def hashes(t: Column) -> Column:
            size = F.size(t["w"]) - (k - 1)
            fits = [t["several"] | (size >= c["need"]) if k == n else F.lit(True) for c in of_k]
            reach = F.greatest(nothing, nothing, *[F.when(ok, F.lit(c["r"])) for ok, c in zip(fits, of_k)])
            found = F.struct(shingle_hashes(t["w"], k).alias("h"), reach.alias("reach"))
            return once(found, lambda x: F.filter(x["h"], lambda h: rank_of(h) <= x["reach"]))

        return hashes

    looked_up = [
        sized.select("__key", F.explode(once(F.struct("w", F.col("__several").alias("several")), sought(k))).alias("h")) for k in lengths
    ]
    if not looked_up:
        looked_up = [own.limit(0).select("__key", F.lit(0).cast("long").alias("h"))]
    hashes = looked_up[0]
    for more in looked_up[1:]:
        hashes = hashes.unionByName(more)
    candidates = stored(hashes.join(_maybe_broadcast(sketches.select("h", "item_id")), "h").select("__key", "item_id").distinct())
    # exact containment of the candidates: all shingles of their documents against all of the item's
    ids = _maybe_broadcast(candidates.select("__key").distinct())
    all_hashes = F.concat(*[shingle_hashes(F.col("w"), k) for k in lengths]) if lengths else F.array().cast("array<long>")
    theirs = own.join(ids, "__key").select("__key", "doc_id", F.explode(F.array_distinct(all_hashes)).alias("h"))
    hits = theirs.join(_maybe_broadcast(shingles), "h")
    return (
        hits.groupBy("__key", "doc_id", "item_id", "n_shingles")
        .agg(F.count_distinct("h").alias("shared"))
        .withColumn("containment", F.col("shared") / F.col("n_shingles"))
        .where(F.col("shared") >= F.col("n_shingles") * F.lit(t) - F.lit(1e-9))
        .select(*(["__key"] if by_key else []), "doc_id", "item_id", "shared", "n_shingles", "containment")
    )


def clean(docs: DataFrame, items: DataFrame, t: float = CONTAINMENT, n: int = SHINGLE) -> DataFrame:
    """The documents that contain no item, with or without an id; all their columns and rows."""
    hit = stored(contaminated(docs, items, t, n, by_key=True).select(F.col("__key").alias("__hit")).distinct())
    text = F.col("text").cast("string")
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.sha2(text, 256)))
    return docs.withColumn("__key", key).join(_maybe_broadcast(hit), F.col("__key") == F.col("__hit"), "left_anti").drop("__key")


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '#' || sha256(text)) AS d,
    list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL
), iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), i AS (
  SELECT item_id, w, least(len(w), 5) AS k FROM iw WHERE len(w) > 0
), s AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - k + 2), lambda x: array_to_string(w[x:x + k - 1], ' '))) AS s FROM i
), ds AS (
  SELECT DISTINCT doc_id, d, unnest(list_transform(range(1, len(w) - k + 2), lambda x: array_to_string(w[x:x + k - 1], ' '))) AS s
  FROM dw JOIN (SELECT DISTINCT k FROM i) ON len(w) >= k
), n AS (SELECT item_id, count(*) AS n_shingles FROM s GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, n_shingles, count(*) / n_shingles AS containment
FROM ds JOIN s USING (s) JOIN n USING (item_id)
GROUP BY d, doc_id, item_id, n_shingles
HAVING count(*) >= n_shingles * 0.8 - 1e-9
"""
