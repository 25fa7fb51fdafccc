"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import ensure_checkpoint_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: rows go to the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage of a larger table: compressed Parquet in the shared folder, read again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Arrow batches of texts stay small, whatever the session's setting.
BATCH_ROWS = 2_000


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of at most BATCH_ROWS rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; it returns the output columns or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out)

    return map_batches(df, run, schema)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id counts as the empty text)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % n


def small(df: DataFrame, rows: int) -> bool:
    """True if ``df`` has at most ``rows`` rows (the check before a broadcast)."""
    return df.limit(rows + 1).count() <= rows


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value taken once, though ``use`` names it inside other lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
