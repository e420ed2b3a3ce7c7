"""Drift-tolerant scan of raw monthly Parquet files (S1, S2, §4.3, E2).

A column that is bigint in one month and double in another makes a single
``spark.read.parquet`` fail at run time, and ``mergeSchema`` fails too.  So:

1. list the files (metadata only),
2. read every footer **on the executors** (``mapInPandas`` over the path list, pyarrow
   ``read_schema``) into a (path, column, physical type) table,
3. fingerprint each file by its sorted (lower-case name, type) pairs,
4. bring only the small fingerprint -> paths table to the driver,
5. one vectorised ``read.parquet`` per fingerprint, canonicalise, ``unionByName``.

The file's own period comes from its ``anio=/mes=`` directories (``source_anio`` /
``source_mes``), which is what keeps de-duplication scoped to one month.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.operators.normalize import normalize
from triplake.sources.files import list_files, with_period_of_path

FOOTER_SCHEMA = "path string, column_name string, physical_type string, num_rows long, fingerprint string"


def _local_path(uri: str):
    """pyarrow filesystem + path for a Spark file URI (file:, hdfs:, s3a:, gs: ...)."""
    from urllib.parse import unquote

    from pyarrow import fs
    if uri.startswith("file:"):
        p = unquote(uri[5:])
        while p.startswith("//"):
            p = p[1:]
        return fs.LocalFileSystem(), p
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3://" + uri.split("://", 1)[1]
    return fs.FileSystem.from_uri(uri)


UNREADABLE = "unreadable"


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow as pa
    import pyarrow.parquet as pq
    for b in batches:
        rows = []
        for path in b["path"]:
            try:
                filesystem, p = _local_path(path)
                with filesystem.open_input_file(p) as fh:
                    meta = pq.ParquetFile(fh)
                    schema, n = meta.schema_arrow, meta.metadata.num_rows
            except pa.ArrowInvalid:          # a broken footer is reported; an I/O error still fails the task
                rows.append((path, None, None, None, UNREADABLE))
                continue
            pairs = sorted((f.name.lower(), str(f.type)) for f in schema)
            fp = hashlib.sha1(repr(pairs).encode()).hexdigest()[:16]
            rows += [(path, name, typ, n, fp) for name, typ in pairs]
        yield pd.DataFrame(rows, columns=["path", "column_name", "physical_type", "num_rows", "fingerprint"])


def footers(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """One row per (file, column): physical type as pyarrow reports it, file row count, fingerprint."""
    files = list_files(spark, root).where(F.col("length") > 0).select("path")
    return files.mapInPandas(_read_footers, FOOTER_SCHEMA)


class UnreadableFiles(RuntimeError):
    """Some raw files have no readable Parquet footer."""


def fingerprint_groups(footer_df: DataFrame, skip_unreadable: bool = False) -> dict[str, list[str]]:
    """fingerprint -> file paths.  Collects a file list only (one row per schema variant).

    Files without a readable footer stop the job with their names, unless ``skip_unreadable``
    (then they are left out and can be listed with ``footer_df.where(fingerprint == 'unreadable')``).
    """
    g = (footer_df.select("fingerprint", "path").distinct()
         .groupBy("fingerprint").agg(F.sort_array(F.collect_list("path")).alias("paths")))
    groups = {r["fingerprint"]: list(r["paths"]) for r in g.collect()}
    bad = groups.pop(UNREADABLE, [])
    if bad and not skip_unreadable:
        raise UnreadableFiles(f"{len(bad)} file(s) without a readable Parquet footer: {bad}")
    return groups


def unreadable_files(spark: SparkSession, root: str | list[str]) -> list[str]:
    """The files without a readable footer (a job on the footers only)."""
    bad = footers(spark, root).where(F.col("fingerprint") == UNREADABLE).select("path").distinct()
    return sorted(r["path"] for r in bad.collect())


def _base_path(root: str | list[str]) -> str:
    """The format folder above the ``anio=/mes=`` directories."""
    first = root if isinstance(root, str) else root[0]
    return re.split(r"/anio=", first.rstrip("/"), maxsplit=1)[0]


def read_raw(spark: SparkSession, root: str | list[str], fmt: str, keep=(), skip_unreadable: bool = False) -> DataFrame:
    """Canonical rows of every raw file of one format under ``root`` plus ``source_anio/source_mes``.

    The period comes from partition discovery (``basePath`` = the format folder), so it is a
    per-file constant attached by the reader, not parsed per row; flat layouts fall back to
    the file path.
    """
    groups = fingerprint_groups(footers(spark, root), skip_unreadable)
    base = _base_path(root)
    parts = []
    for _, paths in sorted(groups.items()):
        raw = spark.read.option("basePath", base).parquet(*paths)
        if {"anio", "mes"} <= set(raw.columns):
            per = raw.withColumnsRenamed({"anio": "source_anio", "mes": "source_mes"})
        else:
            per = with_period_of_path(raw.withColumn("path", F.col("_metadata.file_path")))
            per = per.withColumnsRenamed({"anio": "source_anio", "mes": "source_mes"}).drop("path")
        parts.append(normalize(per, fmt, keep=("source_anio", "source_mes") + tuple(keep)))
    if not parts:
        raise FileNotFoundError(f"no parquet files under {root}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# declared raw types (the external table definitions) in pyarrow spelling, for the drift audit
_DECL = {"int": "int32", "bigint": "int64", "double": "double", "string": "string", "timestamp": "timestamp"}


def type_drift(footer_df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Per column, the physical types seen, file count per type, and whether any disagrees with the declaration."""
    decl = footer_df.sparkSession.createDataFrame(
        [(k.lower(), _DECL.get(v, v)) for k, v in declared.items()], "column_name string, declared_type string")
    fam = F.when(F.col("physical_type").startswith("timestamp"), F.lit("timestamp")) \
           .when(F.col("physical_type").isin("large_string", "string"), F.lit("string")) \
           .otherwise(F.col("physical_type"))
    per = (footer_df.where(F.col("fingerprint") != UNREADABLE).withColumn("family", fam)
           .groupBy("column_name", "family")
           .agg(F.countDistinct("path").alias("files")))
    j = per.join(F.broadcast(decl), "column_name", "left")     # built from the declared list: at most ~25 rows
    return (j.groupBy("column_name", "declared_type")
             .agg(F.sort_array(F.collect_set("family")).alias("physical_types"),
                  F.sum("files").alias("files"),
                  F.max(F.coalesce(F.col("family") != F.col("declared_type"), F.lit(True))).alias("drift")))
