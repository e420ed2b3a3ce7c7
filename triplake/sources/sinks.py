"""Staging and mart sinks.

Writes replace exactly the partitions they carry (dynamic partition overwrite), so a rerun
of a period is idempotent and a half-written period is simply rewritten.  Before writing,
``rebalance`` on the partition columns lets AQE split a hot period over several tasks and
merge small ones, instead of one file per task per period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.schema import CANONICAL, PARTITION_COLS, SOURCE_FOLDER, STAGING_TABLE, ZONE_SCHEMA
from triplake.sources.commit import Folders


def _writer(df: DataFrame, partition_cols: list[str], obs: Observation | None = None):
    out = df.hint("rebalance", *partition_cols)
    if obs is not None:      # above the exchange: counted in the write stage, not in a recomputable map stage
        out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    return (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
            .partitionBy(*partition_cols))


def _files_below(spark: SparkSession, folder: str) -> tuple[object, object, set[str]]:
    """(file system, path, file names) of one partition folder; no names when it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()
    return fs, path, names


class Replacing:
    """Replace whole partitions, also those the new rows leave empty.

    Dynamic overwrite never touches a partition without output rows.  The folders' files are
    noted before the write; a folder that still holds them afterwards got no rows and is deleted.
    """

    def __init__(self, spark: SparkSession, folders: list[str]):
        self.spark, self.folders = spark, folders

    def __enter__(self):
        self.before = {f: _files_below(self.spark, f)[2] for f in self.folders}
        return self

    def __exit__(self, kind, *_):
        if kind is None:
            for folder, names in self.before.items():
                fs, path, now = _files_below(self.spark, folder)
                if names & now:
                    fs.delete(path, True)
        return False


def swap_in(spark: SparkSession, pairs: list[tuple[str, str]]) -> None:
    """Put finished folders in the place of tables: (new, table) each. The old tables are moved aside first and
    deleted when all new ones are in place; a move that fails puts them back."""
    folders, done = Folders(spark), []
    try:
        for new, path in pairs:
            aside = f"{new}-old"
            if folders.exists(path):
                folders.move(path, aside)
                done.append((aside, path))
            folders.move(new, path)
            done.append((path, new))
    except Exception:
        for source, target in reversed(done):
            folders.move(source, target)
        raise
    for new, _ in pairs:
        folders.delete(f"{new}-old")


def staging_path(root: str, fmt: str) -> str:
    return f"{root.rstrip('/')}/{STAGING_TABLE[fmt]}"


def staging_folder(root: str, fmt: str, anio: str, mes: str) -> str:
    taxi = f"/tipo_taxi={fmt}" if STAGING_TABLE[fmt] == "taxi" else ""
    return f"{staging_path(root, fmt)}{taxi}/anio={anio}/mes={mes}"


class MixedLayout(RuntimeError):
    """A staging table holds rows by file period or by pickup period, not both."""


def check_layout(spark: SparkSession, root: str, fmt: str, by_source: bool) -> None:
    """Raise ``MixedLayout`` if the table was staged the other way."""
    table = STAGING_TABLE[fmt]
    other = f"{period_path(root, table, '*', '*')}/{'*.parquet' if by_source else SOURCE_FOLDER + '=*'}"
    if Folders(spark).glob(other):
        raise MixedLayout(f"{root}/{table} was staged by {'file' if by_source else 'pickup'} period")


def write_staging(df: DataFrame, root: str, fmt: str, periods=(), by_source: bool = False) -> str:
    """Canonical payload + partition columns -> <root>/<table>/[tipo_taxi=]/anio=/mes=/ (period replace).

    ``periods`` are the (anio, mes) processed: those without rows are emptied, not left as they were.
    ``by_source``: one more folder level, the period of the source file.
    """
    parts = PARTITION_COLS[STAGING_TABLE[fmt]] + [SOURCE_FOLDER] * by_source
    payload = CANONICAL[fmt].fieldNames()
    path = staging_path(root, fmt)
    with Replacing(df.sparkSession, [staging_folder(root, fmt, a, m) for a, m in periods]):
        _writer(df.select(*payload, *parts), parts).parquet(path)
    return path


def read_staging(spark: SparkSession, root: str, table: str) -> DataFrame:
    """S3: a staging table with its partition columns as strings (partition pruning on anio/mes)."""
    fmt = {"taxi": "yellow"}.get(table, table)
    parts = PARTITION_COLS[table]
    schema = T.StructType(CANONICAL[fmt].fields + [T.StructField(p, T.StringType(), True) for p in parts])
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{table}").select(schema.names)
    except AnalysisException as e:                 # a table nothing was written to yet is empty
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def staged_tables(spark: SparkSession, root: str) -> list[str]:
    """The staging tables that exist below a root."""
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    return [t for t in sorted(set(STAGING_TABLE.values()))
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{t}"))]


def period_path(root: str, table: str, anio: str, mes: str) -> str:
    """The folder pattern of one period, resolved from the layout (only the tipo_taxi level is globbed)."""
    base = f"{root.rstrip('/')}/{table}"
    return f"{base}/tipo_taxi=*/anio={anio}/mes={mes}" if table == "taxi" else f"{base}/anio={anio}/mes={mes}"


def read_staging_period(spark: SparkSession, root: str, table: str, anio: str, mes: str) -> DataFrame:
    """One period of a staging table without listing the rest of the table; empty if the period is absent."""
    return read_staging_periods(spark, root, table, [(anio, mes)])


def read_staging_periods(spark: SparkSession, root: str, table: str, periods) -> DataFrame:
    """The periods of a staging table that exist, as one read of their folders."""
    fmt = {"taxi": "yellow"}.get(table, table)
    parts = PARTITION_COLS[table]
    schema = T.StructType(CANONICAL[fmt].fields + [T.StructField(p, T.StringType(), True) for p in parts])
    folders = Folders(spark)
    paths = [p for a, m in periods for p in folders.glob(period_path(root, table, a, m))]
    if not paths:                                  # periods nothing was written to are empty
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/{table}").parquet(*paths)
            .select(schema.names))


def write_table(df: DataFrame, path: str, partition_cols: list[str] | None = None, static: bool = False,
                folders=()) -> int:
    """Parquet table; returns the rows written (C3), observed during the write itself.

    With partition columns only the carried partitions are replaced, unless ``static`` (a full
    rebuild), which replaces the whole table.  ``folders`` (below ``path``) are replaced even when no
    row falls into them.
    """
    obs = Observation()
    if partition_cols:
        w = _writer(df, partition_cols, obs)
        if static:
            w = w.option("partitionOverwriteMode", "static")
        with Replacing(df.sparkSession, [f"{path.rstrip('/')}/{f}" for f in folders]):
            w.parquet(path)
    else:
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
          .option("compression", "snappy").parquet(path)
    try:
        return int(obs.get["rows"])
    except Exception:  # noqa: BLE001 - no task ran (empty input), so nothing was observed
        if df.limit(1).count() == 0:
            return 0
        raise


def count_rows(spark: SparkSession, path: str, where: F.Column | None = None) -> int | None:
    """Scalar read-out; None when the table cannot be read (the reference printed N/A)."""
    try:
        df = spark.read.parquet(path)
        return (df.where(where) if where is not None else df).count()
    except Exception:  # noqa: BLE001 - a missing table is a normal answer here
        return None


def write_zone_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").option("quote", '"').option("quoteAll", "true").csv(path)
    return path


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated, quoted, header skipped, every column a string."""
    return spark.read.schema(ZONE_SCHEMA).option("header", "true").option("quote", '"').csv(path)
