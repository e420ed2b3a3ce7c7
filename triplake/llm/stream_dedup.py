"""Operator 11, exact de-duplication as a stateful stream.

Documents are read as a stream. Texts are equal when identical after lower-casing A-Z. A task of the reading side
writes each text it has not just seen to a content file in the shared folder and hands on (digest, largest id, rows,
locator), a locator being file, start and size; equal texts of a task are compared by their bytes and counted before
anything is shuffled, so a hot text is a few small rows a task. The keyed state (RocksDB on the executors' disks, its
changelog in the query's checkpoint, no time-out) retains per digest the stable identifier, the rows and the content
locator of each text. A row whose digest is known is a hit: the bytes at both locators are compared, piece by piece,
and a differing text becomes one more entry of the digest. Each change is appended to a table of groups; a later run
with the same folder continues from the state with the files that are new.

``result`` joins the documents with the groups of several rows on the digest, a join that Spark splits when it is
skewed; texts themselves are joined only for a digest with several texts.

Defined results: a null text counts as empty; the row with the largest doc_id stays (null is smallest); rows of equal
id and equal text are one document and all marked alike, each counts for the size of the group; texts of any length;
extra columns are ignored whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import string
import uuid
from collections import OrderedDict
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .common import arrow_batches
from .files import _located

TRIGGER_BYTES = 64 << 30         # input files of one micro-batch
HELD_TEXT = 16 << 20             # recent texts a task keeps to compare with
HELD_KEYS = 50_000               # groups a task sums before it hands them on
PIECE = 4 << 20                  # bytes of one comparison
OPEN_FILES = 64
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
    # many stores on one disk: no space is set aside for logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
THIN = "digest string, id bigint, n bigint, file string, start bigint, size bigint"
BUCKET = 3                       # leading characters of a digest: the grouping key, digests are keys of its map
STATE = "ids array<bigint>, ns array<bigint>, files array<string>, starts array<bigint>, sizes array<bigint>"
GROUPS = "digest string, entry int, id bigint, n bigint, file string, start bigint, size bigint"


def normal(text: Column) -> Column:
    """A-Z in lower case; null: empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


class ContentWriter:
    """One content file of a task, opened with its first text. Its name is new, so a repeated task leaves it alone."""

    def __init__(self, folder: str):
        self.file, self.out, self.at = f"{folder}/content-{uuid.uuid4().hex}", None, 0

    def put(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None:
            system, path = _located(self.file)
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
            self.out = system.open_output_stream(path)
        self.out.write(data)
        self.at += len(data)
        return self.file, self.at - len(data), len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def seen_texts(folder: str) -> Callable:
    """The task function of the reading side: (digest, id, text) to thin rows, equal texts summed."""
    def run(batches):
        writer = ContentWriter(folder)
        recent: OrderedDict[tuple, bytes] = OrderedDict()        # locator to text
        held = 0
        groups: dict[str, list[list]] = {}                       # digest to [id, n, locator] of each text

        def rows():
            flat = [(d, g[0], g[1], *g[2]) for d, gs in groups.items() for g in gs]
            groups.clear()
            cols = list(zip(*flat, strict=True)) or [()] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                              ["digest", "id", "n", "file", "start", "size"])
        for b in batches:
            for digest, doc, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = text.encode()
                entries = groups.setdefault(digest, [])
                same = next((g for g in entries if recent.get(g[2]) == data), None)
                if same:
                    same[0], same[1] = larger(same[0], doc), same[1] + 1
                    recent.move_to_end(same[2])
                    continue
                at = writer.put(data)
                entries.append([doc, 1, at])
                recent[at] = data
                held += len(data)
                while held > HELD_TEXT:
                    held -= len(recent.popitem(last=False)[1])
            if len(groups) > HELD_KEYS:
                yield rows()
        writer.close()
        yield rows()
    return run


class ContentReader:
    """Compares content at locators; keeps some files open."""

    def __init__(self):
        self.open: OrderedDict = OrderedDict()

    def file(self, name: str):
        if name not in self.open:
            if len(self.open) >= OPEN_FILES:
                self.open.popitem(last=False)[1].close()
            system, path = _located(name)
            self.open[name] = system.open_input_file(path)
        self.open.move_to_end(name)
        return self.open[name]

    def read(self, file: str, start: int, size: int) -> bytes:
        return self.file(file).read_at(size, start)

    def close(self) -> None:
        while self.open:
            self.open.popitem()[1].close()

    def equal(self, a: tuple, b: tuple) -> bool:
        """Whether the bytes at two locators are the same."""
        if a[2] != b[2]:
            return False
        return a == b or all(self.read(a[0], a[1] + k, min(PIECE, a[2] - k)) == self.read(b[0], b[1] + k,
                                                                                         min(PIECE, a[2] - k))
                             for k in range(0, a[2], PIECE))


class Keep(StatefulProcessor):
    """Merges thin rows into the state of their digests; the changed entries come out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.reader = ContentReader()
        self.texts = handle.getMapState("texts", "digest string", STATE)

    def entries(self, digest: str) -> list[list]:
        """[id, rows, locator...] of each text of a digest."""
        kept = self.texts.getValue((digest,))
        return [list(e) for e in zip(*kept, strict=True)] if kept is not None else []

    def handleInputRows(self, key, rows, timerValues):           # noqa: N802, N803 - Spark's names
        for frame in rows:
            known: dict[str, list[list]] = {}
            changed: dict[tuple[str, int], list] = {}
            columns = (frame[c].tolist() for c in ("digest", "id", "n", "file", "start", "size"))
            for digest, doc, n, *locator in zip(*columns, strict=True):
                doc = None if pd.isna(doc) else int(doc)
                if digest not in known:
                    known[digest] = self.entries(digest)
                at = next((e for e in known[digest] if self.reader.equal(tuple(e[2:]), tuple(locator))), None)
                if at is None:
                    at = [doc, n, *locator]
                    known[digest].append(at)
                else:
                    at[:2] = larger(at[0], doc), at[1] + n
                changed[digest, known[digest].index(at)] = at
            for digest, entries in known.items():
                self.texts.updateValue((digest,), tuple(list(c) for c in zip(*entries, strict=True)))
            out = [(*k, *e) for k, e in changed.items()]
            yield pd.DataFrame(out, columns=["digest", "entry", "id", "n", "file", "start", "size"]).astype(
                {"id": "Int64"})

    def close(self) -> None:
        self.reader.close()


def advance(docs: DataFrame, folder: str, digest: Callable[[Column], Column] = sha256) -> None:
    """Run the stream ``docs`` (doc_id, text) up to its present end; state, contents and groups live in ``folder``."""
    spark = docs.sparkSession
    arrow_batches(spark)
    thin = docs.select(normal(F.col("text")).alias("text"), F.col("doc_id").cast("bigint").alias("id")).select(
        digest(F.col("text")).alias("digest"), "id", "text").mapInArrow(seen_texts(f"{folder}/content"), THIN)
    groups = thin.withColumn("bucket", F.substring("digest", 1, BUCKET)).groupBy("bucket").transformWithStateInPandas(
        Keep(), GROUPS, "Append", "None")
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        (groups.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
         .trigger(availableNow=True).start(f"{folder}/groups").awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def group_table(spark: SparkSession, folder: str) -> DataFrame:
    """The present groups: digest, entry, keep_id, group_size, locator, entries of the digest."""
    rows = spark.read.schema(GROUPS).parquet(f"{folder}/groups")
    # an entry's rows only grow, so its largest count is the latest
    last = rows.groupBy("digest", "entry").agg(F.max(F.struct("n", "id", "file", "start", "size")).alias("__g"))
    # entries are numbered from 0, and a second one always comes with or after the first
    several = last.where("entry > 0").select("digest", F.lit(True).alias("several")).distinct()
    return last.join(several, "digest", "left").select(
        "digest", "entry", F.col("__g.id").alias("keep_id"), F.col("__g.n").alias("group_size"), "__g.file",
        "__g.start", "__g.size", F.coalesce("several", F.lit(False)).alias("several"))


def _with_content(groups: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size, text): the groups with their texts, read at the locators."""
    def run(batches):
        reader = ContentReader()
        for b in batches:
            for digest, keep, n, *locator in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest]), pa.array([keep], pa.int64()), pa.array([n], pa.int64()),
                     pa.array([reader.read(*locator).decode()])], ["digest", "keep_id", "group_size", "text"])
    return groups.select("digest", "keep_id", "group_size", "file", "start", "size").mapInArrow(
        run, "digest string, keep_id bigint, group_size bigint, text string")


def result(docs: DataFrame, folder: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, digest, keep_id, group_size, kept of every row of ``docs`` (batch), all of which the state has seen."""
    spark = docs.sparkSession
    groups = group_table(spark, folder)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), normal(F.col("text")).alias("text")).withColumn(
        "digest", digest(F.col("text")))
    # __one tells a row without a group of several from one whose ids are all null
    plain = groups.where("group_size > 1 and not several").select("digest", "keep_id", "group_size",
                                                                  F.lit(False).alias("__one"))
    several = groups.where("several")
    joined = rows.drop("text")
    if several.isEmpty():
        found = joined.join(plain, "digest", "left")
    else:
        found = joined.join(several.select("digest").distinct(), "digest", "left_anti").join(plain, "digest", "left")
        found = found.unionByName(rows.join(_with_content(several), ["digest", "text"]).select(
            "digest", "doc_id", "keep_id", "group_size", F.lit(False).alias("__one")))
    keep = F.when(F.col("__one").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", "digest", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"))


def stream(spark: SparkSession, path: str, trigger_bytes: int = TRIGGER_BYTES) -> DataFrame:
    """The Parquet files of ``path`` (a folder or one file) as a stream of (doc_id, text)."""
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    path = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"            # a plain path must be a folder, a pattern not
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", str(trigger_bytes)).parquet(path)
