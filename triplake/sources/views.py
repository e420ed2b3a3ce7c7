"""SQL access (S2, S3, S5): declared raw reads and temp views over staging and marts.

Views are plain ``createOrReplaceTempView`` over Parquet folders with string partition
columns, so ``spark.sql("... WHERE anio = '2024' AND mes = '01'")`` prunes partitions
(S5: the folder layout is the projection; nothing is listed beyond the matching folders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from triplake.plans.incremental import ANNUAL, MONTHLY, STATE
from triplake.schema import RAW_DECLARED
from triplake.sources.sinks import read_staging, read_zone_csv

_SQL_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
              "timestamp": T.TimestampNTZType()}


def declared_schema(fmt: str) -> T.StructType:
    fields = [T.StructField(n, _SQL_TYPES[t], True) for n, t in RAW_DECLARED[fmt]]
    return T.StructType(fields + [T.StructField("anio", T.StringType()), T.StructField("mes", T.StringType())])


def read_declared(spark: SparkSession, raw_root: str, fmt: str) -> DataFrame:
    """A raw format read with its declared schema; works only where the files agree with it
    (use ``scan.read_raw`` for drifted history)."""
    return spark.read.schema(declared_schema(fmt)).parquet(f"{raw_root.rstrip('/')}/{fmt}")


def register_views(spark: SparkSession, staging_root: str | None = None, mart_root: str | None = None,
                   zones_csv: str | None = None) -> list[str]:
    """Temp views: taxi, fhvhv, fhv, taxi_zone_lookup, and every mart/state table present."""
    names = []
    if staging_root:
        for t in ("taxi", "fhvhv", "fhv"):
            read_staging(spark, staging_root, t).createOrReplaceTempView(t)
            names.append(t)
    if zones_csv:
        read_zone_csv(spark, zones_csv).createOrReplaceTempView("taxi_zone_lookup")
        names.append("taxi_zone_lookup")
    if mart_root:
        for m in MONTHLY + ANNUAL + tuple(STATE.values()):
            try:
                spark.read.parquet(f"{mart_root.rstrip('/')}/{m}").createOrReplaceTempView(m)
                names.append(m)
            except Exception:  # noqa: BLE001 - mart not built yet
                pass
    return names
