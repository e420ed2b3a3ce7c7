"""Whole-period commits of staging and quarantine.

A cleaning run writes its rows below ``_commit/<id>`` first.  Nothing published has changed until a manifest of
the run's periods is complete; from then on the run only moves folders: each period's old folder out of the way, the
new one into its place (no new folder: the period is now empty).  Every step tells by what exists whether it was done,
so a run that ended half-way is finished by ``recover`` (manifest complete) or forgotten (no manifest), and staging,
quarantine and the processed-periods log of a period change together.  One run at a time per staging root.

A run that merges single files also keeps the files whose rows a period holds (``logged_files``), replaced with the
period. A run that cleans whole periods keeps none, and takes away what was known of theirs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFEST = ("formato string, anio string, mes string, source string, target string, aside string, has_rows boolean, "
            "log string")


FILE_STATE = "path string, modificationTime timestamp, length bigint, anio string, mes string"


class Folders:
    """The few file-system calls a commit needs, on the file system of each path."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        fs, p = self._at(target)
        fs.mkdirs(p.getParent())
        if not fs.rename(self._at(source)[1], p):
            raise OSError(f"{source} could not be moved to {target}")

    def glob(self, pattern: str) -> list[str]:
        fs, p = self._at(pattern)
        return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def commit_root(staging_root: str) -> str:
    return f"{staging_root.rstrip('/')}/_commit"


def file_log(staging_root: str, fmt: str) -> str:
    """Folder of the merged files' log, one folder a period below it."""
    return f"{staging_root.rstrip('/')}/_archivos/{fmt}"


def logged_files(spark: SparkSession, staging_root: str, fmt: str, periods) -> DataFrame:
    """The files that are known to make up ``periods`` of staging; none for a period that was cleaned whole."""
    log, folders = file_log(staging_root, fmt), Folders(spark)
    paths = [p for p in (f"{log}/anio={a}/mes={m}" for a, m in periods) if folders.exists(p)]
    if not paths:
        return spark.createDataFrame([], FILE_STATE)
    return spark.read.schema(FILE_STATE).option("basePath", log).parquet(*paths)


class PeriodCommit:
    """One run's commit: write below ``staging`` and ``quarantine``, then ``publish`` the periods.

    ``by_source``: a file's rows lie in several staging periods, each with a folder for every source period. A source
    period is replaced by replacing its folders in all of them, also in those where it has no rows any more.
    """

    def __init__(self, spark: SparkSession, staging_root: str, fmt: str, quarantine_root: str | None = None,
                 by_source: bool = False):
        self.spark, self.fmt, self.staging_root, self.quarantine_root = spark, fmt, staging_root, quarantine_root
        self.by_source = by_source
        self.id = uuid.uuid4().hex
        self.folder = f"{commit_root(staging_root)}/{self.id}"
        self.staging = f"{self.folder}/staging"
        self.files = f"{self.folder}/files"
        # moves stay on one file system
        self.quarantine = f"{commit_root(quarantine_root)}/{self.id}" if quarantine_root else None

    def _staging_places(self, periods):
        """(source period, staging period, folder below it or '') of what may change."""
        if not self.by_source:
            return [((a, m), (a, m), "") for a, m in periods]
        from triplake.schema import SOURCE_FOLDER
        from triplake.sources.sinks import staging_folder
        mine = {f"{a}-{m}": (a, m) for a, m in periods}
        found = set()
        for root in (self.staging, self.staging_root):       # a list of folders
            for p in Folders(self.spark).glob(f"{staging_folder(root, self.fmt, '*', '*')}/{SOURCE_FOLDER}=*"):
                a, m, own = (x.split("=", 1)[1] for x in p.split("/")[-3:])
                if own in mine:
                    found.add((mine[own], (a, m), f"/{SOURCE_FOLDER}={own}"))
        return sorted(found)

    def _rows(self, periods, places_of, log: str | None):
        from triplake.sources.sinks import staging_folder
        folders = Folders(self.spark)
        for a, m in periods:
            places = [(staging_folder(self.staging, self.fmt, *at) + below,
                       staging_folder(self.staging_root, self.fmt, *at) + below,
                       f"{self.folder}/aside/{self.fmt}/anio={at[0]}/mes={at[1]}{below}")
                      for own, at, below in places_of if own == (a, m)]
            if self.quarantine:
                own = f"{self.fmt}/anio={a}/mes={m}"
                places.append((f"{self.quarantine}/{own}", f"{self.quarantine_root.rstrip('/')}/{own}",
                               f"{self.quarantine}/aside/{own}"))
            # always one place, so a period without any folder is logged all the same
            places.append((f"{self.files}/anio={a}/mes={m}", f"{file_log(self.staging_root, self.fmt)}/anio={a}/mes={m}",
                           f"{self.folder}/aside-files/{self.fmt}/anio={a}/mes={m}"))
            for source, target, aside in places:
                yield self.fmt, a, m, source, target, aside, folders.exists(source), log

    def publish(self, periods, log: str | None = None) -> list[tuple[str, str]]:
        """Put the written ``periods`` in place; with ``log`` they are then added to the processed-periods log.
        Returns the staging periods that they touch."""
        places = self._staging_places(periods)
        rows = list(self._rows(periods, places, log))        # a period list
        if rows:
            self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{self.folder}/manifest")
        finish(self.spark, self.folder)
        if self.quarantine:
            Folders(self.spark).delete(self.quarantine)
        return sorted({at for _, at, _ in places})


def finish(spark: SparkSession, folder: str) -> bool:
    """Finish the commit in ``folder`` if its manifest is complete, then remove it; whether it was finished."""
    folders = Folders(spark)
    ready = folders.exists(f"{folder}/manifest/_SUCCESS")
    if ready:
        rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").collect()
        for r in rows:
            if r.has_rows and not folders.exists(r.source):
                continue                                     # already in place
            if folders.exists(r.target):
                folders.move(r.target, r.aside)
            if r.has_rows:
                folders.move(r.source, r.target)
        for log in sorted({r.log for r in rows if r.log}):
            done = sorted({(r.anio, r.mes) for r in rows if r.log == log})
            spark.createDataFrame(done, "anio string, mes string").coalesce(1).write.mode("append").parquet(log)
    folders.delete(folder)
    return ready


def recover(spark: SparkSession, staging_root: str, quarantine_root: str | None = None) -> int:
    """Finish or forget what earlier runs left in ``staging_root``; the number of commits finished."""
    finished = 0
    for name in Folders(spark).names(commit_root(staging_root)):
        finished += finish(spark, f"{commit_root(staging_root)}/{name}")
        if quarantine_root:
            Folders(spark).delete(f"{commit_root(quarantine_root)}/{name}")
    return finished


def commit_periods(rows: DataFrame, rejected: DataFrame | None, staging_root: str, fmt: str, periods,
                   quarantine_root: str | None = None, log: str | None = None,
                   by_source: bool = False, files: DataFrame | None = None) -> list[tuple[str, str]]:
    """Replace ``periods`` of staging (and of the quarantine, if there is one) by ``rows`` (and ``rejected``); returns
    the staging periods touched. With ``by_source`` the periods are those of the files, and ``rows`` lie in any.
    ``files`` (columns of ``FILE_STATE``) are then known as the files of the periods."""
    from triplake.plans.clean import write_quarantine
    from triplake.sources.sinks import check_layout, write_staging
    check_layout(rows.sparkSession, staging_root, fmt, by_source)
    commit = PeriodCommit(rows.sparkSession, staging_root, fmt, quarantine_root, by_source)
    if files is not None:      # before any row is read: a file replaced meanwhile then differs from its logged state
        files.coalesce(1).write.partitionBy("anio", "mes").parquet(commit.files)
    write_staging(rows, commit.staging, fmt, by_source=by_source)
    if commit.quarantine:
        write_quarantine(rejected, commit.quarantine, fmt)
    return commit.publish(periods, log)
