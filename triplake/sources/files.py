"""File listing and period discovery without reading data.

Listing uses the ``binaryFile`` source with only ``path`` and ``length`` selected, so the scan's
ReadSchema omits ``content``: no bytes are read, only directory metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.schema import DEFAULT_START, FORMAT_START

PERIOD_RE = r"anio=(\d{4})/mes=(\d{2})/"


def list_files(spark: SparkSession, root: str | list[str], glob: str = "*.parquet") -> DataFrame:
    """(path, length) of every file under ``root`` (one folder or several) matching ``glob``."""
    roots = [root] if isinstance(root, str) else list(root)
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(roots).select("path", "length"))


def file_states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, modificationTime, length, anio, mes) of the files in ``paths`` (files or folders): a file that was
    replaced under its name differs in time or length."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(paths).select("path", "modificationTime", "length"))
    return with_period_of_path(files.where(F.col("length") > 0))


def with_period_of_path(files: DataFrame) -> DataFrame:
    """anio/mes strings from ``.../anio=YYYY/mes=MM/...``; NULL when the path does not match."""
    a = F.regexp_extract("path", PERIOD_RE, 1)
    m = F.regexp_extract("path", PERIOD_RE, 2)
    return files.withColumns({"anio": F.nullif(a, F.lit("")), "mes": F.nullif(m, F.lit(""))})


def raw_periods(spark: SparkSession, root: str, nonempty_only: bool = False) -> DataFrame:
    """Distinct (anio, mes) of a format's raw folder, sorted; zero-byte files count as missing."""
    f = with_period_of_path(list_files(spark, root))
    if nonempty_only:
        f = f.where(F.col("length") > 0)
    return (f.where(F.col("anio").isNotNull() & F.col("mes").isNotNull()).select("anio", "mes").distinct()
             .orderBy("anio", "mes"))


def staged_periods(spark: SparkSession, staging_table_root: str, tipo_taxi: str | None = None) -> DataFrame:
    """Periods present in a staging table (taxi prefix depends on tipo_taxi)."""
    root = staging_table_root.rstrip("/")
    if tipo_taxi:
        root = f"{root}/tipo_taxi={tipo_taxi}"
    return raw_periods(spark, root)


def month_calendar(spark: SparkSession, start: str, as_of: str) -> DataFrame:
    """Months from ``start`` (YYYY-MM) up to the month before ``as_of`` (YYYY-MM), as (anio, mes) strings.

    ``as_of`` is a parameter (the run date), never read from the clock inside the job.
    """
    d = F.explode(F.sequence(F.to_date(F.lit(start + "-01")), F.add_months(F.to_date(F.lit(as_of + "-01")), -1),
                             F.expr("INTERVAL 1 MONTH"))).alias("d")
    return (spark.range(1).select(d).where(F.col("d") < F.to_date(F.lit(as_of + "-01")))
            .select(F.date_format("d", "yyyy").alias("anio"), F.date_format("d", "MM").alias("mes")))


def expected_periods(spark: SparkSession, formats, as_of: str, starts: dict | None = None) -> DataFrame:
    """(formato, anio, mes) expected per format, from its first published month."""
    starts = {**FORMAT_START, **(starts or {})}
    out = None
    for fmt in formats:
        cal = month_calendar(spark, starts.get(fmt, DEFAULT_START), as_of).select(F.lit(fmt).alias("formato"), "*")
        out = cal if out is None else out.unionByName(cal)
    return out


def missing_periods(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected minus present on (formato, anio, mes); both sides are small period lists."""
    keys = [c for c in ("formato", "anio", "mes") if c in present.columns]
    return (expected.join(present.select(*keys).distinct(), keys, "left_anti")
                    .withColumn("periodo", period_label()).orderBy(*keys))


def pending_periods(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Raw periods with nothing staged yet."""
    keys = [c for c in raw.columns if c in staged.columns]
    return raw.join(staged.select(*keys).distinct(), keys, "left_anti")


def period_label(anio: str = "anio", mes: str = "mes") -> F.Column:
    """'YYYY-MM' label of a period."""
    return F.format_string("%04d-%02d", F.col(anio).cast("int"), F.col(mes).cast("int"))
