"""Training-corpus pipeline: quality, near-dedup, exact dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir), where docs is all its predecessor kept,
and its result is written as Parquet and read again as the next one's docs.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontaminate, packing, quality, simhash, suffix_dedup
from daybook.llm.common import stored, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier scores 0.5 or more; blank and null texts go."""
    crf = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.kept_documents(docs, crf, 0.5)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component.

    Rows without an id come after all others, by a hash of their texts; equal ones are one document.
    """
    last = docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0]
    above = min(max(0, last or 0), 2**62)
    own = F.lit(above) + 1 + F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(2**62 - 2))
    keyed = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), own))
    found = simhash.simhash_components(keyed.select(F.col("__id").alias("doc_id"), "text"), threshold=2, shingle=3)
    kept = stored(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")))
    out = keyed.join(kept.select(F.col("doc_id").alias("__id")), "__id", "left_semi")
    if not kept.where("n > 1").isEmpty():
        out = out.dropDuplicates(["__id"])  # rows that repeat an id are one document
    return out.select(*docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of 100-byte strings that also start earlier; n_chars follows."""
    cut = suffix_dedup.dedup_texts(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that contain no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# SimHash fingerprints, the classifier and packing have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
