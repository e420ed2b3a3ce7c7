"""Files that executors write below the shared folder, and tables of hashes among them."""

from __future__ import annotations

import math
import os
import re
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE_ROWS = 500_000             # rows in one file of a hash table
LEAST_BITS = 5                   # a small table is still written by several tasks


def _located(uri: str):
    uri = re.sub(r"^file:/+", "/", uri)
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write_whole(uri: str, *parts: bytes) -> None:
    """Write a file under a passing name, then move it: a repeated or lost task leaves no half-written file."""
    system, path = _located(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    passing = f"{os.path.dirname(path)}/_{uuid.uuid4().hex}"
    with system.open_output_stream(passing) as out:
        for p in parts:
            out.write(p)
    system.move(passing, path)


def mapped_path(uri: str) -> str:
    """The path under which workers can memory-map a file of the shared folder (a mount, not an object store)."""
    path = re.sub(r"^file:/+", "/", uri)
    if "://" in path:
        raise ValueError(f"memory-mapping needs the shared folder as a mounted path, not {uri}")
    return path


class HashTable:
    """A mapped table from strings to doubles: sorted 64-bit hashes and values, one pair of files a range of hashes."""

    def __init__(self, folder: str, bits: int):
        self.folder, self.bits, self.open = folder, bits, {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"open": {}}

    def _array(self, name: str, kind: str) -> np.ndarray:
        if name not in self.open:
            try:
                self.open[name] = np.memmap(f"{mapped_path(self.folder)}/{name}", kind, "r")
            except FileNotFoundError:                    # no hash in this range
                self.open[name] = np.zeros(0, kind)
        return self.open[name]

    def found(self, keys: list[str]) -> dict[str, float]:
        """The values of those keys that the table holds."""
        if not keys:
            return {}
        q = np.array([xxhash.xxh64_intdigest(k, 42) for k in keys], np.uint64)
        order = np.argsort(q)
        q = q[order]
        cuts = np.searchsorted((q >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(2 ** self.bits + 1))
        out = {}
        for r in np.flatnonzero(np.diff(cuts)):
            own, hashes = q[cuts[r]:cuts[r + 1]], self._array(f"hash-{r:06d}", "<u8")
            if not len(hashes):
                continue
            at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            hit = np.flatnonzero(hashes[at] == own)
            values = self._array(f"value-{r:06d}", "<f8")[at[hit]]
            out.update(zip((keys[i] for i in order[cuts[r] + hit]), values.tolist(), strict=True))
        return out


def write_hash_table(rows: DataFrame, n: int, folder: str) -> HashTable:
    """The table of ``rows`` (key string, value double) with ``n`` distinct keys; nothing passes the driver."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(n, 1) / RANGE_ROWS)))

    def run(table: pa.Table) -> pa.Table:
        r = table.column("r")[0].as_py()
        h = table.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        write_whole(f"{folder}/hash-{r:06d}", h[order].astype("<u8").tobytes())
        write_whole(f"{folder}/value-{r:06d}", table.column("value").to_numpy()[order].astype("<f8").tobytes())
        return pa.table({"n": pa.array([len(h)], pa.int64())})

    h = rows.select(F.xxhash64("key").alias("h"), F.col("value").cast("double").alias("value"))
    h = h.withColumn("r", F.shiftrightunsigned("h", 64 - bits).cast("int"))
    h.groupBy("r").applyInArrow(run, "n bigint").agg(F.sum("n")).collect()
    return HashTable(folder, bits)
