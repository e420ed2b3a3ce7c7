"""Operator 9, language-model scoring: interpolated modified Kneser-Ney bigrams, counted in Spark, memory-mapped.

Tokens are the ASCII-lower-cased words of a text, then one end token; the first word follows an end token.
Counting takes three shuffles, all pre-aggregated by the tasks that read the texts:
1. words: 64-bit hash and count. The hashes are written as sorted arrays, one file for each range of hashes, and a
   word's number is its place in them.
2. word pairs: each task sums its pairs and sends them as compressed sorted blocks, one for each shard of pairs.
   A shard holds all pairs of its first words (pairs of a first word with more than a quarter of a shard are
   dealt over ``SALT`` shards), so no group grows with a frequent word. A shard is written as two sorted arrays: pair
   key (both numbers packed in 64 bits) and count.
3. per first word the total and the numbers of second words seen once, twice and more often, per second word the
   number of first words: dense arrays by word number, one file for each range of hashes.
Discounts come from the counts of counts. Workers memory-map the files and look up a batch's words and pairs by
binary search; words met before are remembered in a bounded table. The model's size grows with the corpus, so it
is never sent through the driver; the driver holds the ranges and the sums.

log10 P(w|v) uses (c(vw) - D)/c(v.) + g(v) Pc(w), Pc(w) = (N(.w) - D')/N(..) + g'/(V + 1): one unknown word shares the
uniform part, and a first word not seen in training leaves Pc(w).

Defined results: null text is the end token alone; an empty training table gives V = N = 0 and probability 1; texts
of any length; equal rows get equal scores; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, scratch, written
from .files import mapped_path, write_whole

SEED = 42
END = b""                        # no word is empty, so its hash stands for the end token
RANGE_WORDS = 1_000_000          # words in one file of hashes
SHARD_TOKENS = 2_500_000         # training tokens behind one shard of pairs
TASK_PAIRS = 4_000_000           # pairs a task sums before it sends them
KNOWN_WORDS = 700_000            # words a worker remembers
SALT = 16


def tokens(text: str | None) -> list[bytes]:
    out = text.encode().lower().split() if text else []
    out.append(END)
    return out


def hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], np.uint64)


def discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of entries seen once to four times (one discount of a half where any is zero)."""
    if min(n) == 0:
        return [0.5, 0.5, 0.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.0), k + 1.0) for k in range(3)]


@dataclass
class Model:
    """Where the files are, and the few sums that scoring needs."""

    folder: str
    bits: int = 0                                        # ranges: top bits of the hash
    starts: list[int] = field(default_factory=lambda: [0])   # number of the first word of each range, then V
    total: int = 0
    shards: int = 1
    heavy: list[int] = field(default_factory=list)
    pair_d: list[float] = field(default_factory=lambda: [0.5] * 3)
    word_d: list[float] = field(default_factory=lambda: [0.5] * 3)
    followed: int = 0                                    # distinct pairs
    word_n: list[int] = field(default_factory=lambda: [0, 0, 0])

    @property
    def size(self) -> int:
        return self.starts[-1]

    def shard_of(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        x = v.astype(np.uint64)
        if self.heavy:
            x = x + np.where(np.isin(v, np.array(self.heavy, v.dtype)),
                             (w.astype(np.uint64) % np.uint64(SALT) + np.uint64(1)) << np.uint64(33), np.uint64(0))
        x = x * np.uint64(0x9E3779B97F4A7C15)
        return ((x >> np.uint64(32)) % np.uint64(self.shards)).astype(np.int64)


class Files:
    """The mapped arrays of a model."""

    def __init__(self, model: Model):
        self.model, self.at = model, mapped_path(model.folder)
        self.open: dict[str, np.ndarray] = {}

    def array(self, name: str, kind: str) -> np.ndarray:
        got = self.open.get(name)
        if got is None:
            try:
                got = np.memmap(f"{self.at}/{name}", kind, "r")
            except (FileNotFoundError, ValueError):      # nothing fell into this shard
                got = np.zeros(0, kind)
            self.open[name] = got
        return got

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Word numbers of hashes, -1 for unknown ones."""
        out = np.full(len(h), -1, np.int64)
        order = np.argsort(h)
        q = h[order]
        part = (q >> np.uint64(64 - self.model.bits)).astype(np.int64) if self.model.bits else np.zeros(len(q), np.int64)
        cuts = np.searchsorted(part, np.arange(len(self.model.starts)))
        for r in np.unique(part):
            keys = self.array(f"hash-{r:06d}", "<u8")
            if not len(keys):
                continue
            own = q[cuts[r]:cuts[r + 1]]
            i = np.searchsorted(keys, own)
            hit = (i < len(keys)) & (keys[np.minimum(i, len(keys) - 1)] == own)
            out[order[cuts[r]:cuts[r + 1]]] = np.where(hit, i + self.model.starts[r], -1)
        return out

    def by_number(self, ids: np.ndarray, name: str, kind: str) -> np.ndarray:
        """Values of a dense array for valid word numbers."""
        out = np.zeros(len(ids), kind)
        part = np.searchsorted(np.array(self.model.starts), ids, side="right") - 1
        for r in np.unique(part):
            own = part == r
            out[own] = self.array(f"{name}-{r:06d}", kind)[ids[own] - self.model.starts[r]]
        return out

    def pair_counts(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        shard = self.model.shard_of(v, w)
        key = v.astype(np.uint64) << np.uint64(32) | w.astype(np.uint64)
        order = np.lexsort((key, shard))
        key, shard, out = key[order], shard[order], np.zeros(len(key), np.int64)
        cuts = np.searchsorted(shard, np.arange(self.model.shards + 1))
        for s in np.unique(shard):
            keys, counts = self.array(f"pair-{s:06d}", "<u8"), self.array(f"paircount-{s:06d}", "<i8")
            if len(keys):
                own = key[cuts[s]:cuts[s + 1]]
                i = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                out[order[cuts[s]:cuts[s + 1]]] = np.where(keys[i] == own, counts[i], 0)
        return out


class Words:
    """A worker's table of words met so far: number, count, and the parts of the model that hang on one word."""

    def __init__(self, model: Model):
        self.files, self.model = Files(model), model
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.number = np.zeros(0, np.int64)
        self.values = {n: np.zeros(0) for n in ("base", "cont", "total", "gamma")}

    def numbers(self, words: list[bytes], parts: bool) -> np.ndarray:
        """Places in this table of all words; unknown places are filled first."""
        new = list(set(words).difference(self.index))
        if len(self.index) + len(new) > KNOWN_WORDS and self.index:
            self.clear()
            new = list(set(words))
        if new:
            first = len(self.number)
            ids = self.files.numbers(hashes(new))
            self.index.update(zip(new, range(first, first + len(new)), strict=True))
            self.number = np.concatenate([self.number, ids])
            if parts:
                for name, x in self._parts(ids).items():
                    self.values[name] = np.concatenate([self.values[name], x])
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def _parts(self, ids: np.ndarray) -> dict[str, np.ndarray]:
        m, known = self.model, ids >= 0
        n = {k: np.zeros(len(ids)) for k in ("count", "cont", "total", "n1", "n2", "n3")}
        for name, kind in (("count", "<i8"), ("cont", "<i8"), ("total", "<i8"), ("n1", "<i8"), ("n2", "<i8"),
                           ("n3", "<i8")):
            n[name][known] = self.files.by_number(ids[known], name, kind)
        base = np.log10((n["count"] + 1) / (m.total + m.size + 1))
        d = np.array([0.0, *m.word_d])
        spread = sum(a * b for a, b in zip(m.word_d, m.word_n, strict=True)) / m.followed if m.followed else 1.0
        cont = spread / (m.size + 1)
        if m.followed:
            cont = cont + np.maximum(n["cont"] - d[np.minimum(n["cont"], 3).astype(int)], 0) / m.followed
        d1, d2, d3 = m.pair_d
        gamma = np.where(n["total"] > 0, (d1 * n["n1"] + d2 * n["n2"] + d3 * n["n3"]) / np.maximum(n["total"], 1), 1.0)
        return {"base": base, "cont": np.broadcast_to(cont, len(ids)).astype(float), "total": n["total"],
                "gamma": gamma}


@lru_cache(maxsize=1)
def _words(folder: str, key: bytes) -> Words:
    import pickle
    return Words(pickle.loads(key))


def worker_words(model: Model) -> Words:
    import pickle
    return _words(model.folder, pickle.dumps(model))


def _block(*columns: np.ndarray) -> bytes:
    return zstandard.compress(np.array([len(columns[0])], "<i8").tobytes() + b"".join(
        np.ascontiguousarray(c, "<i8").tobytes() for c in columns), 1)


def _unblock(data: bytes, columns: int) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.decompress(data), "<i8")
    return list(flat[1:].reshape(columns, int(flat[0])))


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct sorted keys and the sums of their values."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], *(np.add.reduceat(v[order], first) for v in values))


def _word_counts(texts: DataFrame) -> DataFrame:
    def run(batches):
        seen: Counter = Counter()

        def rows():
            words = list(seen)
            return pa.RecordBatch.from_arrays([pa.array(hashes(words).view(np.int64)),
                                               pa.array(list(seen.values()), pa.int64())], ["h", "n"])
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(tokens(t))
            if len(seen) > KNOWN_WORDS:
                yield rows()
                seen.clear()
        yield rows()

    return texts.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _write_words(counts: DataFrame, folder: str, bits: int) -> DataFrame:
    """Sorted arrays of each range; (range, n) rows."""
    def run(table: pa.Table) -> pa.Table:
        r = table.column("r")[0].as_py()
        h = table.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        write_whole(f"{folder}/hash-{r:06d}", h[order].astype("<u8").tobytes())
        write_whole(f"{folder}/count-{r:06d}", table.column("n").to_numpy()[order].astype("<i8").tobytes())
        return pa.table({"r": pa.array([r], pa.int32()), "n": pa.array([len(h)], pa.int64())})

    shift = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0)
    return counts.withColumn("r", shift.cast("int")).groupBy("r").applyInArrow(run, "r int, n bigint")


def _pair_blocks(texts: DataFrame, model: Model) -> DataFrame:
    """(shard, block): sorted pair keys and counts of one task for one shard."""
    def run(batches):
        known = worker_words(model)
        held, size = [], 0

        def blocks():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            key = key.astype(np.int64)
            shard = model.shard_of(key >> 32, key & 0xFFFFFFFF)
            order = np.argsort(shard, kind="stable")
            key, n = key[order], n[order].astype(np.int64)
            cuts = np.searchsorted(shard[order], np.arange(model.shards + 1))
            for s in range(model.shards):
                a, z = cuts[s], cuts[s + 1]
                if a < z:
                    k = key[a:z]
                    step = np.diff(k >> 32, prepend=0)
                    yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([_block(
                        step, k & 0xFFFFFFFF, n[a:z])], pa.binary())], ["shard", "block"])
        for b in batches:
            flat = [END]
            for t in b.column(0).to_pylist():
                flat += tokens(t)
            ids = known.numbers(flat, False)
            ids = known.number[ids].astype(np.uint64)
            held.append(ids[:-1] << np.uint64(32) | ids[1:])
            size += len(flat)
            if size > TASK_PAIRS:
                yield from blocks()
                held, size = [], 0
        if held:
            yield from blocks()

    return texts.mapInArrow(run, "shard int, block binary")


def _write_pairs(blocks: DataFrame, model: Model) -> DataFrame:
    """The arrays of each shard; rows (range, kind, block) of what hangs on one word, and (-1, 'sums', block)."""
    folder, starts = model.folder, np.array(model.starts)

    def run(table: pa.Table) -> pa.Table:
        s = table.column("shard")[0].as_py()
        keys, counts = [], []
        for x in table.column("block"):
            step, w, n = _unblock(x.as_py(), 3)
            keys.append(np.cumsum(step) << 32 | w)
            counts.append(n)
        key, n = _summed(np.concatenate(keys), np.concatenate(counts))
        write_whole(f"{folder}/pair-{s:06d}", key.astype("<u8").tobytes())
        write_whole(f"{folder}/paircount-{s:06d}", n.astype("<i8").tobytes())
        one, two, more = (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n > 2).astype(np.int64)
        out = [(-1, "sums", _block(np.array([len(n), *((n == k).sum() for k in (1, 2, 3, 4))])))]
        v = _summed(key >> 32, n, one, two, more)
        w = _summed(key & 0xFFFFFFFF, np.ones(len(n), np.int64))
        for kind, cols in (("first", v), ("second", w)):
            cuts = np.searchsorted(cols[0], starts)
            for r in range(len(starts) - 1):
                if cuts[r] < cuts[r + 1]:
                    part = [c[cuts[r]:cuts[r + 1]] for c in cols]
                    out.append((r, kind, _block(np.diff(part[0], prepend=starts[r]), *part[1:])))
        return pa.table({"r": pa.array([x[0] for x in out], pa.int32()), "kind": [x[1] for x in out],
                         "block": pa.array([x[2] for x in out], pa.binary())})

    return blocks.groupBy("shard").applyInArrow(run, "r int, kind string, block binary")


def _write_parts(stats: DataFrame, model: Model) -> DataFrame:
    """Dense arrays of each range; (n1..n4): words by the number of first words before them."""
    folder, starts = model.folder, model.starts

    def run(table: pa.Table) -> pa.Table:
        r = table.column("r")[0].as_py()
        size = starts[r + 1] - starts[r]
        dense = {k: np.zeros(size, np.int64) for k in ("total", "n1", "n2", "n3", "cont")}
        for kind, x in zip(table.column("kind").to_pylist(), table.column("block"), strict=True):
            names = ("total", "n1", "n2", "n3") if kind == "first" else ("cont",)
            step, *values = _unblock(x.as_py(), 1 + len(names))
            at = np.cumsum(step)
            for name, v in zip(names, values, strict=True):
                dense[name][at] += v                     # numbers are distinct within a block
        for name, x in dense.items():
            write_whole(f"{folder}/{name}-{r:06d}", x.astype("<i8").tobytes())
        return pa.table({f"k{k}": pa.array([int((dense["cont"] == k).sum())], pa.int64()) for k in (1, 2, 3, 4)})

    return stats.where("r >= 0").groupBy("r").applyInArrow(run, "k1 bigint, k2 bigint, k3 bigint, k4 bigint")


def train(texts: DataFrame, shard_tokens: int = SHARD_TOKENS, range_words: int = RANGE_WORDS) -> Model:
    """Count the model of a table with one column of texts; its files lie in the shared folder."""
    spark = texts.sparkSession
    arrow_batches(spark)
    model = Model(scratch(spark, "kneser-ney"))
    counts = written(_word_counts(texts), "words")
    size, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not size:
        return model
    if size >= 2 ** 32:
        raise ValueError("pairs are packed into 64 bits: at most 2^32 distinct words")
    model.total = total
    model.bits = max(0, math.ceil(math.log2(size / range_words)))
    ranges = {x["r"]: x["n"] for x in _write_words(counts, model.folder, model.bits).collect()}   # one row a file
    model.starts = np.concatenate([[0], np.cumsum([ranges.get(r, 0) for r in range(2 ** model.bits)])]).tolist()
    model.shards = max(1, math.ceil(total / shard_tokens))
    # at most 4 x shards words have more than a quarter of a shard's share of the tokens
    often = counts.where(F.col("n") > total / (4 * model.shards)).select("h").collect()
    if model.shards > 1 and often:
        model.heavy = np.sort(Files(model).numbers(np.array([x["h"] for x in often], np.int64).view(
            np.uint64))).tolist()
    arrow_batches(spark)
    stats = written(_write_pairs(_pair_blocks(texts, model), model), "pairs")
    sums = np.zeros(5, np.int64)
    for x in stats.where("r = -1").select("block").collect():        # five numbers a shard
        sums += _unblock(x["block"], 1)[0]
    model.followed = int(sums[0])
    model.pair_d = discounts(sums[1:].tolist())
    n = _write_parts(stats, model).agg(*[F.sum(f"k{k}") for k in (1, 2, 3, 4)]).first()
    n = [int(x or 0) for x in n]
    model.word_d = discounts(n)
    model.word_n = [n[0], n[1], model.size - n[0] - n[1]]
    return model


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, base_score and score of every row."""
    arrow_batches(docs.sparkSession)
    source = docs.select(*keep, docs["text"].alias("__text"))

    def run(batches):
        known = worker_words(model)
        d = np.array([0.0, *model.pair_d])
        for b in batches:
            flat, ends = [END], []
            for t in b.column("__text").to_pylist():
                flat += tokens(t)
                ends.append(len(flat) - 1)
            at = known.numbers(flat, True)
            prev, cur = at[:-1], at[1:]                  # each text starts behind the end token of the one before
            v, w = known.number[prev], known.number[cur]
            p = np.array(known.values["cont"][cur])
            total, gamma = known.values["total"][prev], known.values["gamma"][prev]
            p = np.where(total > 0, gamma * p, p)
            both = np.flatnonzero((v >= 0) & (w >= 0))
            pair, back = np.unique(v[both] << 32 | w[both], return_inverse=True)
            c = known.files.pair_counts(pair >> 32, pair & 0xFFFFFFFF)[back] if len(pair) else np.zeros(0, np.int64)
            p[both] += np.maximum(c - d[np.minimum(c, 3)], 0) / np.maximum(total[both], 1)
            first = np.concatenate([[0], ends[:-1]]).astype(np.int64) if ends else np.zeros(0, np.int64)

            def sums(x, first=first):
                return np.add.reduceat(x, first) if len(first) else x[:0]
            yield pa.RecordBatch.from_arrays([
                *b.columns[:-1], pa.array(np.array(ends, np.int64) - first), pa.array(sums((w >= 0).astype(np.int64))),
                pa.array(sums(known.values["base"][cur])), pa.array(sums(np.log10(p)))],
                [*b.schema.names[:-1], "n_tokens", "n_known", "base_score", "score"])

    kept = source.drop("__text").schema.fields
    return source.mapInArrow(run, T.StructType([
        *kept, T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]))
