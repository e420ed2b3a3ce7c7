"""New raw files trigger cleaning of exactly their periods.

The stream carries the *file list* (``binaryFile`` source, ``path`` and ``length`` only), not
the rows: raw files of one format do not share a schema, so a row stream with one schema
cannot read them.  Each micro-batch collects its (small) set of touched periods, re-reads
every raw file of those periods through the drift-tolerant scan, cleans them and replaces
those periods in staging.  The checkpoint records which files were seen (R3: nothing is
redone), and because writes replace whole periods a replayed batch is harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from triplake.plans.clean import clean
from triplake.sources.commit import Folders, commit_periods, logged_files, recover
from triplake.sources.files import file_states, with_period_of_path
from triplake.sources.scan import read_raw


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*.parquet")
         .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(landing_root).select("path", "length")


def clean_touched_periods(spark: SparkSession, batch: DataFrame, landing_root: str, fmt: str,
                          staging_root: str, order_by=(), quarantine_root: str | None = None,
                          period: str = "file") -> list[tuple[str, str]]:
    """Re-clean every period the batch touches. A file outside ``anio=/mes=`` fails the batch, so the
    checkpoint does not mark it as seen."""
    touched = (with_period_of_path(batch).where(F.col("length") > 0)
               .select("anio", "mes").distinct().collect())          # a period list, bounded by the batch
    if any(r["anio"] is None or r["mes"] is None for r in touched):
        raise ValueError(f"a new file in {landing_root} lies outside anio=/mes=")
    periods = sorted((r["anio"], r["mes"]) for r in touched)
    if not periods:
        return []
    root = landing_root.rstrip("/")
    dirs = [f"{root}/anio={a}/mes={m}" for a, m in periods]
    keep = tuple(order_by)
    rows, rejected = clean(read_raw(spark, dirs, fmt, keep=keep), fmt, order_by=order_by, keep=keep, period=period)
    recover(spark, staging_root, quarantine_root)              # a replayed batch finishes what it left
    commit_periods(rows, rejected, staging_root, fmt, periods, quarantine_root, by_source=period == "pickup")
    return periods


class FilesGone(RuntimeError):
    """A period must be cleaned anew, but files whose rows it holds are no longer in the landing folder."""


def _batch_files(spark: SparkSession, batch: DataFrame, fmt: str, staging_root: str):
    """(file, period, whether its state is logged, whether another state of it is) of each file of the batch."""
    found = with_period_of_path(batch.where(F.col("length") > 0)).collect()                  # this batch's files
    if any(r["anio"] is None or r["mes"] is None for r in found):
        raise ValueError(f"a new {fmt} file lies outside anio=/mes=")
    if not found:
        return []
    log = logged_files(spark, staging_root, fmt, sorted({(r["anio"], r["mes"]) for r in found}))
    log = log.select("path", F.col("modificationTime").alias("was"), F.col("length").alias("had"))
    same = (F.col("was") == F.col("modificationTime")) & (F.col("had") == F.col("length"))
    return (file_states(spark, [r["path"] for r in found]).join(log, "path", "left")
            .select("path", "anio", "mes", F.coalesce(same, F.lit(False)).alias("known"),
                    F.coalesce(~same, F.lit(False)).alias("replaced")).collect())


def merge_new_files(spark: SparkSession, batch: DataFrame, fmt: str, staging_root: str,
                    quarantine_root: str | None = None) -> list[tuple[str, str]]:
    """Clean only the batch's new files and merge them with the staged rows of their periods; the periods changed.

    De-duplication keeps the smallest row per key (no ``order_by``), and that minimum is
    associative, so merging batch by batch gives the same staging as cleaning all files at
    once.  The merged rows are written beside the table and moved in by a commit, so nothing they
    are read from changes while they are written, and a replayed batch finds whole periods.

    The files a period is made of are committed with it. A file that is already among them, unchanged, is left out (a
    replayed batch adds nothing, nor to the quarantine). A file that was replaced under its name takes its old rows
    with it: rows do not tell their file, and one of them may have been kept for an equal row of another file, so
    its period is cleaned anew from the whole landing folder, as is a period that another job has staged.
    ``FilesGone`` is raised if files of such a period have left the folder.
    """
    from triplake.operators.dedup import dedup
    from triplake.operators.quality import apply_rules, split
    from triplake.plans.clean import SOURCE_PERIOD, read_quarantine_periods, with_period
    from triplake.schema import CANONICAL, STAGING_TABLE
    from triplake.sources.sinks import read_staging_periods, staging_folder

    recover(spark, staging_root, quarantine_root)              # a replayed batch finishes what it left
    files = [r for r in _batch_files(spark, batch, fmt, staging_root) if not r["known"]]
    if not files:
        return []
    periods = sorted({(r["anio"], r["mes"]) for r in files})
    log = logged_files(spark, staging_root, fmt, periods)
    logged = {tuple(r) for r in log.select("anio", "mes").distinct().collect()}
    folders = Folders(spark)

    def held(a, m):
        return (folders.exists(staging_folder(staging_root, fmt, a, m))
                or bool(quarantine_root) and folders.exists(f"{quarantine_root.rstrip('/')}/{fmt}/anio={a}/mes={m}"))
    whole = {(r["anio"], r["mes"]) for r in files if r["replaced"]}
    whole |= {p for p in periods if p not in logged and held(*p)}
    merged = [p for p in periods if p not in whole]
    in_merged = F.concat_ws("-", "anio", "mes").isin([f"{a}-{m}" for a, m in merged])

    new = [r["path"] for r in files if (r["anio"], r["mes"]) not in whole]
    new += sorted({r["path"][:r["path"].index(f"/mes={r['mes']}/") + 7] for r in files if (r["anio"], r["mes"]) in whole})
    states = file_states(spark, new)
    gone = log.where(~in_merged).join(states, "path", "left_anti").select("path").limit(10).collect()
    if gone:
        raise FilesGone(f"{fmt} periods cannot be cleaned anew without {[r['path'] for r in gone]}")

    cols = CANONICAL[fmt].fieldNames() + list(SOURCE_PERIOD)
    rows, rejected = split(apply_rules(read_raw(spark, new, fmt), fmt))
    as_source = {"anio": SOURCE_PERIOD[0], "mes": SOURCE_PERIOD[1]}
    staged = read_staging_periods(spark, staging_root, STAGING_TABLE[fmt], merged)
    if "tipo_taxi" in staged.columns:
        staged = staged.where(F.col("tipo_taxi") == fmt)
    rows = dedup(rows.select(*cols).unionByName(staged.withColumnsRenamed(as_source).select(*cols)), fmt)
    if quarantine_root:
        before = read_quarantine_periods(spark, quarantine_root, fmt, merged).withColumnsRenamed(as_source)
        rejected = rejected.select(*before.columns).unionByName(before)
    commit_periods(with_period(rows, fmt), rejected, staging_root, fmt, periods, quarantine_root,
                   files=states.unionByName(log.where(in_merged)))
    return periods


def replaced_files(spark: SparkSession, landing_root: str, fmt: str, staging_root: str) -> DataFrame:
    """(path, length) of the landing files whose rows were merged before they were replaced under their name. The
    stream's own list of seen files goes by name and does not report them."""
    states = file_states(spark, [landing_root])
    periods = sorted(tuple(r) for r in states.select("anio", "mes").dropna().distinct().collect())
    log = logged_files(spark, staging_root, fmt, periods)
    log = log.select("path", F.col("modificationTime").alias("was"), F.col("length").alias("had"))
    return (states.join(log, "path").where((F.col("was") != F.col("modificationTime")) | (F.col("had") != F.col("length")))
            .select("path", "length"))


def stream_arrivals(spark: SparkSession, landing_root: str, fmt: str, staging_root: str, checkpoint: str,
                    available_now: bool = True, max_files_per_trigger: int | None = None,
                    order_by=(), merge_staged: bool = False, quarantine_root: str | None = None,
                    period: str = "file") -> StreamingQuery:
    """Start the arrival stream; ``available_now`` processes what is there and stops (batch-like runs).

    ``merge_staged`` cleans only each batch's new files and merges them into the staged periods
    (for periods assembled from many arrivals); the default re-cleans every file of a touched period. Files replaced
    under their name since they were merged are taken up when the stream is started.
    With ``quarantine_root`` the rejected rows are kept with their reason (E15), in either mode.
    ``period="pickup"`` lays the rows into their pickup's month, as in ``clean_periods``.
    """
    if merge_staged and period != "file":
        raise ValueError("the merge mode stages by file period")

    # the batch only lists files; its rows are read in the caller's session, as a stream's own may run without AQE, and
    # then a hot period would be written by one task
    def process(batch: DataFrame, epoch_id: int) -> None:
        if merge_staged:
            merge_new_files(spark, batch, fmt, staging_root, quarantine_root)
        else:
            clean_touched_periods(spark, batch, landing_root, fmt, staging_root, order_by,
                                  quarantine_root, period)

    if merge_staged and Folders(spark).exists(landing_root):
        recover(spark, staging_root, quarantine_root)
        merge_new_files(spark, replaced_files(spark, landing_root, fmt, staging_root), fmt, staging_root, quarantine_root)
    w = (arrivals(spark, landing_root, max_files_per_trigger).writeStream
         .foreachBatch(process).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
