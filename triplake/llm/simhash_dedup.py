"""Operator 5, SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: words of the ASCII-lower-cased text, shingles of ``shingle`` words joined by a space (fewer words:
the whole sequence), XXH64 with seed 42 of each shingle; a bit is set if it is set in over half of the hashes.

Search over the distinct fingerprints: the 64 bits are grouped into partitions so that correlated bits share one
(the bit correlations are 64 x 64 sums over all fingerprints). Two fingerprints at distance ``k`` or less agree
in at least one partition i up to t_i bits whenever the thresholds sum to k - m + 1, t_i >= -1 (-1: the partition
is not probed). Every fingerprint gets its own thresholds from a dynamic program over the partitions that
minimises probes plus estimated candidates; the estimate is the number of fingerprints with the same value in the
partition (threshold 0) and, for each further value probed, the partition's mean. So crowded values are
left out and the threshold goes to other partitions. Probes are joined with the (partition, value) index
and candidates are verified by the bit distance inside the join; a pair is taken from its larger fingerprint and in
the first partition that finds it, so it appears once. Components contract the links: every fingerprint goes to its
smallest neighbour, then to the root of that chain, and the links between different roots are the next, smaller
graph, so a group of near copies is one node after the first round.

Defined results: null text or a text without words has fingerprint zero and links like any other; rows with a
null id are fingerprinted, link their component, and take its id (null if no member has one); equal rows
share fingerprint and component; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, written

SHINGLE, DISTANCE, SEED = 3, 3, 42
PARTITIONS = 3                   # 21 or 22 bits each
PROBE_COST = 1.0                 # cost of one probe in candidates


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    w = text.encode().lower().split() if text else []     # bytes: A-Z only, the six ASCII white space characters
    if not w:
        return 0
    if len(w) <= shingle:
        grams = [b" ".join(w)]
    else:
        grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False))
    h = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], ">u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):                   # bounded memory for very long texts
        ones += np.unpackbits(h[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, *keep: str, shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns and ``fp`` (signed 64 bits)."""
    arrow_batches(docs.sparkSession)
    source = docs.select(*keep, docs["text"].alias("__text"))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("__text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))],
                                             [*b.schema.names[:-1], "fp"])

    kept = source.drop("__text").schema.fields
    return source.mapInArrow(run, T.StructType([*kept, T.StructField("fp", T.LongType())]))


def bit_groups(fps: DataFrame, m: int = PARTITIONS) -> list[list[int]]:
    """Partitions of the bit positions (0: least significant) with correlated bits together."""
    def run(batches):
        total = np.zeros((65, 65), np.int64)
        for b in batches:
            v = b.column(0).to_numpy().astype(">i8")
            bits = np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1]
            bits = np.concatenate([bits, np.ones((len(bits), 1), np.uint8)], axis=1).astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
        i = np.arange(65)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(list(total), pa.list_(pa.int64()))], ["i", "row"])

    arrow_batches(fps.sparkSession, 100_000)
    rows = fps.select("fp").mapInArrow(run, "i bigint, row array<bigint>").select(
        "i", F.posexplode("row").alias("j", "n")).groupBy("i", "j").agg(F.sum("n").alias("n")).collect()  # 65 x 65
    both = np.zeros((65, 65))
    for r in rows:
        both[r["i"], r["j"]] = r["n"]
    n = max(1.0, both[64, 64])
    p = both[:64, 64] / n
    cov = both[:64, :64] / n - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(64)), []
    for g in range(m):
        size = len(left) // (m - g)
        idx = sorted(left)
        first = max(idx, key=lambda b: (corr[b, idx].max(), -b))
        group = [first]
        left.remove(first)
        while len(group) < size:
            b = max(sorted(left), key=lambda b: corr[b, group].sum())
            group.append(b)
            left.remove(b)
        groups.append(sorted(group))
    return groups


def gather(fp: np.ndarray, group: list[int]) -> np.ndarray:
    """The value of a bit group, as a small integer."""
    out = np.zeros(len(fp), np.int64)
    for k, b in enumerate(group):
        out |= (fp >> np.uint64(b) & np.uint64(1)).astype(np.int64) << k
    return out


def allocate(cost: np.ndarray, budget: int) -> np.ndarray:
    """Thresholds (n, m) of least summed cost[n, m, t + 1] with t >= -1 and sum t = budget, by dynamic programming."""
    n, m, width = cost.shape
    states = budget + m + 1                               # sum of (t + 1) so far: 0 .. budget + m
    best = np.full((n, states), np.inf)
    best[:, 0] = 0
    picked = np.zeros((m, n, states), np.int64)
    for i in range(m):
        new = np.full((n, states), np.inf)
        for u in range(min(width, states)):
            c = best[:, :states - u] + cost[:, i, u:u + 1]
            better = c < new[:, u:]
            new[:, u:][better] = c[better]
            picked[i][:, u:][better] = u
        best = new
    at, out = np.full(n, states - 1), np.zeros((n, m), np.int64)
    for i in range(m - 1, -1, -1):
        u = picked[i][np.arange(n), at]
        out[:, i] = u - 1
        at = at - u
    return out


def links(fps: DataFrame, distance: int = DISTANCE, m: int = PARTITIONS) -> DataFrame:
    """(a, b): pairs of distinct fingerprints (column fp) within the distance, each at least in one order."""
    spark = fps.sparkSession
    groups = bit_groups(fps, m)
    widths = [len(g) for g in groups]
    flips = [[np.array([sum(1 << b for b in c) for c in combinations(range(w), t)], np.int64)
              for t in range(distance + 1)] for w in widths]

    def values(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            for i, g in enumerate(groups):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), i, np.int32)),
                                                  pa.array(gather(fp.view(np.uint64), g)), pa.array(fp)],
                                                 ["part", "value", "fp"])

    arrow_batches(spark, 20_000)
    index = written(fps.select("fp").mapInArrow(values, "part int, value bigint, fp bigint"), "index")
    crowd = index.groupBy("part", "value").agg(F.count("*").alias("n"))
    # counts of all (partition, value) pairs, gathered per fingerprint: partial rows only
    own = index.join(crowd, ["part", "value"]).groupBy("fp").agg(
        *[F.max(F.when(F.col("part") == i, F.col("n"))).alias(f"n{i}") for i in range(m)])
    sizes = crowd.groupBy("part").agg((F.sum("n") / F.greatest(F.lit(1), F.count("*"))).alias("mean")).collect()
    mean = {r["part"]: r["mean"] for r in sizes}          # m rows
    total = fps.count()

    def probes(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            if not len(fp):
                continue
            cost = np.zeros((len(fp), m, distance + 2))
            for i in range(m):
                n = b.column(1 + i).to_numpy()
                tried = 0
                for t in range(distance + 1):
                    tried += len(flips[i][t])
                    seen = n + (tried - 1) * (total / 2.0 ** widths[i]) * mean.get(i, 1.0)
                    cost[:, i, t + 1] = PROBE_COST * tried + seen
            chosen = allocate(cost, distance - m + 1)
            packed = ((chosen + 1) << 4 * np.arange(m)).sum(axis=1)
            for i, g in enumerate(groups):
                value = gather(fp.view(np.uint64), g)
                for t in range(distance + 1):
                    who = np.flatnonzero(chosen[:, i] >= t)
                    step = max(1, 200_000 // max(1, len(flips[i][t])))
                    for k in range(0, len(who), step):
                        w = who[k:k + step]
                        v = (value[w][:, None] ^ flips[i][t][None, :]).ravel()
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(v), i, np.int32)), pa.array(v), pa.array(np.repeat(
                                fp[w], len(flips[i][t]))), pa.array(np.repeat(packed[w], len(flips[i][t])))],
                            ["part", "value", "a", "t"])

    asked = own.mapInArrow(probes, "part int, value bigint, a bigint, t bigint")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(True)
    for i, g in enumerate(groups[:-1]):                   # no earlier partition has found the pair
        mask = int(np.uint64(sum(1 << b for b in g)).astype(np.int64))
        apart = F.bit_count(differ.bitwiseAND(F.lit(mask))) >= F.shiftright("t", 4 * i).bitwiseAND(F.lit(15))
        first = first & ((F.col("part") <= i) | apart)
    return asked.join(index.withColumnRenamed("fp", "b"), ["part", "value"]).where(
        (F.col("a") > F.col("b")) & (F.bit_count(differ) <= distance) & first).select("a", "b")


def _chased(step: DataFrame) -> DataFrame:
    """(node, root) with every root followed to the end of its chain (chains halve each time)."""
    while True:
        over = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = written(step.join(over, "root").select("node", F.col("next").alias("root"),
                                                      (F.col("next") != F.col("root")).alias("moved")), "roots")
        if not step.where("moved").limit(1).count():
            return step.select("node", "root")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components of ``edges`` (a, b), root is the smallest node; nodes with edges only."""
    edges, label = written(edges, "edges"), None
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        low = both.groupBy("node").agg(F.min("near").alias("near"))
        step = _chased(written(low.select("node", F.least("node", "near").alias("root")), "roots"))
        if label is None:
            label = step
        else:
            over = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            label = written(label.join(over, "root", "left").select("node", F.coalesce("next", "root").alias("root")),
                            "labels")
        left = edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(
            step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb")
        edges = written(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
                        "edges")
        if not edges.limit(1).count():
            return label


def near_duplicates(docs: DataFrame, *keep: str, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``keep`` columns, fp, root (fingerprint that names the component) and component_id (smallest doc_id reachable)."""
    rows = written(fingerprints(docs, *dict.fromkeys((*keep, "doc_id")), shingle=shingle), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    near = written(links(nodes, distance), "links")
    # components over fingerprints, then the smallest id of each component
    label = components(near)
    of = nodes.join(label.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "node", F.coalesce("root", "fp").alias("root"))
    smallest = of.groupBy("root").agg(F.min("node").alias("component_id"))
    by_fp = of.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(by_fp, "fp").select(*keep, "fp", "root", "component_id")
