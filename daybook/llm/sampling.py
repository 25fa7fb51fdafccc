"""Bounded training samples: the only place where rows are left out, and only for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import fold, stored


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, bound: int) -> DataFrame:
    """(text, y) of at most ``bound`` labelled documents, chosen by a hash of the id.

    ``keep`` says (on doc_id) which rows may be learned from.  Null labels and
    ids do not count, conflicting rows of one id take the larger label.  The
    chosen ids are at most ``bound`` rows, so they may be broadcast and no text
    is shuffled.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
        .where(keep)
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(stored(ids)), "doc_id"
    )


def hashed_fraction(df: DataFrame, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of doc_id; all rows if there are fewer."""
    n = df.count()
    if n <= bound:
        return df
    scale = 1 << 30
    return df.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < int(scale * bound / n))


def training_fold(n: int, held_out: int) -> Column:
    return fold(F.col("doc_id"), n) != held_out
