"""Shared helpers: corpus tables, word splitting, scratch tables and Arrow batch sizes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Words are maximal runs of characters other than these six (space, tab, LF, VT, FF, CR).
WHITE = " \t\n\x0b\x0c\r"

# Documents per Arrow batch handed to Python: a few MB of ordinary text, and a bounded amount when
# every document is very long.
BATCH_ROWS = 400
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array (null text: empty array); runs inside generated code."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE)), " ", -1), "")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what one Arrow batch of documents holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text modulo m (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(m)
