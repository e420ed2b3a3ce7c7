"""Raw -> staging cleaning of one or many periods of one format.

One job per format covers every period: the source period travels as ``source_anio`` /
``source_mes`` columns and is part of the de-duplication key, which keeps the reference's
per-file scope without a driver loop over months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.functions.dates import anio_of, mes_of
from triplake.operators.dedup import dedup
from triplake.operators.normalize import normalize
from triplake.operators.quality import REASON, add_flags, apply_rules, passes, split
from triplake.schema import CANONICAL, FORMATS, SOURCE_FOLDER, TAXI_FORMATS

SOURCE_PERIOD = ("source_anio", "source_mes")


def expand_formats(formato: str | None) -> list[str]:
    """S14: 'taxi' means yellow + green; nothing means all four."""
    if formato is None:
        return list(FORMATS)
    if formato == "taxi":
        return list(TAXI_FORMATS)
    if formato not in FORMATS:
        raise ValueError(f"unknown format {formato!r}")
    return [formato]


def with_period(df: DataFrame, fmt: str, period: str = "file", scope=SOURCE_PERIOD) -> DataFrame:
    """Partition columns: the file's period (as executed, default) or the pickup's (as documented), there with the
    file's period as ``origen``."""
    if period == "file":
        a, m = F.col(scope[0]), F.col(scope[1])
    elif period == "pickup":
        a, m = anio_of("pickup_datetime"), mes_of("pickup_datetime")
    else:
        raise ValueError("period must be 'file' or 'pickup'")
    cols = {"anio": a, "mes": m}
    if period == "pickup":
        cols[SOURCE_FOLDER] = F.concat_ws("-", *scope)
    if fmt in TAXI_FORMATS:
        cols["tipo_taxi"] = F.lit(fmt)
    return df.withColumns(cols)


def clean(df: DataFrame, fmt: str, scope=SOURCE_PERIOD, order_by=(), period: str = "file",
          keep=(), flags: bool = False) -> tuple[DataFrame, DataFrame]:
    """(staging rows, quarantined rows with ``reject_reason``) for raw rows of one format."""
    n = normalize(df, fmt, keep=tuple(scope) + tuple(keep))
    # the plain conjunction reaches the Parquet scan; the reason is computed for the rejected rows only
    ok = passes(fmt)
    clean_rows = n.where(ok)
    quarantine = split(apply_rules(n.where(~F.coalesce(ok, F.lit(False))), fmt))[1]
    clean_rows = dedup(clean_rows, fmt, scope=scope, order_by=order_by)
    clean_rows = with_period(clean_rows, fmt, period, scope)
    if flags:
        clean_rows = add_flags(clean_rows, fmt)
    return clean_rows, quarantine


def write_quarantine(rejected: DataFrame, root: str, fmt: str, periods=()) -> str:
    """E15 sink: rejected rows with ``reject_reason``, replaced per source period like staging."""
    from triplake.sources.sinks import write_table
    path = f"{root.rstrip('/')}/{fmt}"
    out = rejected.withColumnsRenamed({SOURCE_PERIOD[0]: "anio", SOURCE_PERIOD[1]: "mes"})
    write_table(out, path, ["anio", "mes"], folders=[f"anio={a}/mes={m}" for a, m in periods])
    return path


def read_quarantine(spark, root: str, fmt: str) -> DataFrame:
    """The rejected rows of a format with their reason; without any, an empty table."""
    return spark.read.schema(_quarantine_schema(fmt)).parquet(f"{root.rstrip('/')}/{fmt}")


def _quarantine_schema(fmt: str) -> T.StructType:
    return T.StructType([*CANONICAL[fmt].fields, *[T.StructField(c, T.StringType()) for c in (REASON, "anio", "mes")]])


def read_quarantine_periods(spark, root: str, fmt: str, periods) -> DataFrame:
    """The rejected rows of the periods that have any, as one read of their folders."""
    from triplake.sources.commit import Folders
    path, folders = f"{root.rstrip('/')}/{fmt}", Folders(spark)
    paths = [p for p in (f"{path}/anio={a}/mes={m}" for a, m in periods) if folders.exists(p)]
    if not paths:
        return spark.createDataFrame([], _quarantine_schema(fmt))
    return spark.read.schema(_quarantine_schema(fmt)).option("basePath", path).parquet(*paths)


def processed_log(staging_root: str, fmt: str) -> str:
    """Folder of the processed-periods log (leading underscore: Parquet readers of the table skip it)."""
    return f"{staging_root.rstrip('/')}/_periodos/{fmt}"


def clean_periods(spark, raw_root: str, staging_root: str, formato: str | None = None, anio: str | None = None,
                  mes: str | None = None, order_by=(), keep=(), resume: bool = True,
                  quarantine_root: str | None = None, skip_unreadable: bool = False,
                  period: str = "file") -> dict[str, list[str]]:
    """The cleaning job: raw ``<raw_root>/<fmt>/anio=/mes=/`` -> staging, one distributed job per format.

    ``resume`` skips the periods of the processed-periods log (R3). Rows, quarantine and log of a period
    are committed together (``sources.commit``), and only for periods whose files were all read: one with
    an unreadable file (``skip_unreadable``) is left out whole, keeps what was staged before and stays
    pending. A run that ended half-way is finished or forgotten by the next one. Periods are replaced,
    never appended, also by an empty result, so ``resume=False`` reruns safely.  With ``quarantine_root`` the rejected rows and their reason go to
    ``<quarantine_root>/<fmt>``, partitioned by source period (E15).  Returns the periods written
    per format, and under ``<fmt>_unreadable`` the files that were left out, if any.

    ``period="pickup"`` (P14 as documented) puts a row into its pickup's month, in a folder of its file's month: a
    rerun replaces what its files contributed, in every month. Log, resume and quarantine stay by file month;
    ``<fmt>_touched`` reports the staging months that changed, for ``append_periods`` (which refuses a month that is
    now without any rows). One staging table holds one of the two layouts.
    """
    from triplake.sources.commit import commit_periods, recover
    from triplake.sources.files import pending_periods, raw_periods
    from triplake.sources.scan import read_raw, unreadable_files

    report = {}
    recover(spark, staging_root, quarantine_root)
    for fmt in expand_formats(formato):
        root = f"{raw_root.rstrip('/')}/{fmt}"
        periods = raw_periods(spark, root, nonempty_only=True)
        if anio:                                   # a month alone selects nothing narrower (S14)
            periods = periods.where(F.col("anio") == str(anio))
            if mes:
                periods = periods.where(F.col("mes") == str(mes).zfill(2))
        done = _done_periods(spark, staging_root, fmt) if resume else None
        if done is not None:
            periods = pending_periods(periods, done)
        todo = sorted((r["anio"], r["mes"]) for r in periods.collect())      # period list only
        if todo and skip_unreadable:
            bad = unreadable_files(spark, _folders(root, todo))
            if bad:
                report[f"{fmt}_unreadable"] = bad
                todo = [(a, m) for a, m in todo if not any(f"/anio={a}/mes={m}/" in f for f in bad)]
        if todo:
            raw = read_raw(spark, _folders(root, todo), fmt, keep=keep)
            rows, rejected = clean(raw, fmt, order_by=order_by, keep=keep, period=period)
            touched = commit_periods(rows, rejected, staging_root, fmt, todo, quarantine_root,
                                     log=processed_log(staging_root, fmt), by_source=period == "pickup")
            if period == "pickup":
                report[f"{fmt}_touched"] = [f"{a}-{m}" for a, m in touched]
        report[fmt] = [f"{a}-{m}" for a, m in todo]
    return report


def _folders(root: str, periods) -> list[str]:
    return [f"{root}/anio={a}/mes={m}" for a, m in periods]


def _done_periods(spark, staging_root, fmt) -> DataFrame | None:
    """The processed-periods log, or None before the first run."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(processed_log(staging_root, fmt)).select("anio", "mes")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
