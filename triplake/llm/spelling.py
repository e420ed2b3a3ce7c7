"""Operator 12, spelling variants by finite-state composition.

The vocabulary is counted by Spark. Near words (one inserted, deleted or replaced code point) are the pairs that
the composition acceptor . one-edit transducer . acceptor accepts. A composed state is (state, edits, state); with
the edit still to come both sides have read the same symbols. Initial states partition the work: of two near words,
the shorter one with m code points, either the first m // 2 code points are equal or the last m - m // 2 are. So each
word is dealt to the initial states named by these halves (the second kind for the reversed words), for m its length
and its length less one. Each partition builds minimised acceptors of what its words have left behind the shared
half, one for m and one for m + 1 code points over one set of states, composes them with the transducer and
enumerates the accepted pairs. A pair whose first half is equal is left to the first kind, so each pair comes out
once.

A half shared by more than ``LIMIT`` words is split exactly: by the next code point for pairs that share it too, and
for the pairs that differ just there by all the other code points (at most one word for each symbol).

Forms and roots: a word's form is its near word of largest count; roots follow the forms by pointer doubling (counts
at least double at each step, so a few rounds end it).

Defined results: null and empty texts have no words; a null doc_id enters the planted hash as an empty string; rows
are counted as often as they occur; a run of any length is one word; ties between forms go to the smallest in
code-point order; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

LETTERS = "[A-Za-zÀ-ÿ]+"
SHORTEST = 5                     # code points of a word
COUNT = 3                        # occurrences of a word
PLANT = 97
RATIO = 2                        # a form is at least so many times as frequent
LIMIT = 100_000                  # words of one partition; larger ones are split
OUT_ROWS = 50_000
_KEY = ["side", "m", "gap", "key"]


class Acceptor:
    """Minimised acceptors of sorted word lists over one set of states."""

    def __init__(self):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}

    def state(self, arcs: dict[str, int], final: bool) -> int:
        """The state with these arcs (in symbol order): equal states are one."""
        key = (final, *arcs.items())
        got = self.known.get(key)
        if got is None:
            got = self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return got

    def add(self, words: list[str]) -> int:
        """The initial state of the acceptor of ``words`` (sorted, distinct)."""
        path, final, before = [{}], [False], ""

        def close(k: int) -> None:                       # behind a prefix of k symbols nothing will be added
            while len(path) > k + 1:
                done = self.state(path.pop(), final.pop())
                path[-1][before[len(path) - 1]] = done
        for w in words:
            k, most = 0, min(len(before), len(w))
            while k < most and before[k] == w[k]:
                k += 1
            close(k)
            path += [{} for _ in w[k:]]
            final += [False] * len(w[k:])
            final[-1] = True
            before = w
        close(0)
        return self.state(path[0], final[0])

    def walk(self, *start: int) -> Iterator[tuple[list[str], tuple[int, ...]]]:
        """(pieces of the string, states) that the given states reach together, themselves first."""
        stack = [("", start)]
        while stack:
            read, at = stack.pop()
            more = [read]
            while True:
                yield more, at
                arcs = [self.arcs[q] for q in at]
                shared = [c for c in arcs[0] if all(c in a for a in arcs[1:])]
                if len(shared) != 1:
                    break
                more.append(shared[0])                   # a chain needs no stack
                at = tuple(a[shared[0]] for a in arcs)
            stack += [("".join(more) + c, tuple(a[c] for a in arcs)) for c in shared]

    def common(self, p: int, q: int) -> list[str]:
        """The strings that both states accept: composed states behind the edit."""
        return ["".join(s) for s, (x, y) in self.walk(p, q) if self.final[x] and self.final[y]]

    def replaced(self, q: int) -> list[tuple[str, str]]:
        """What is accepted from (q, no edit yet, q) when the next symbol is the replaced one."""
        return [(c + s, d + s) for (c, x), (d, y) in combinations(self.arcs[q].items(), 2) for s in self.common(x, y)]

    def inserted(self, p: int, q: int) -> list[tuple[str, str]]:
        """The same with a symbol inserted into the second word; of equal places the last one counts."""
        return [(s, d + s) for d, y in self.arcs[q].items() for s in self.common(p, y) if s[:1] != d]

    def pairs(self, short: int, long: int, only_here: bool) -> Iterator[tuple[str, str]]:
        """One-edit pairs within the words of ``short`` and between them and those of ``long``."""
        for edit, start in ((self.replaced, (short,)), (self.inserted, (short, long))):
            known: dict[tuple, list] = {}
            for read, at in self.walk(*start):
                if at not in known:
                    known[at] = edit(*at)
                if known[at]:
                    head = "".join(read)
                    yield from ((head + x, head + y) for x, y in known[at])
                if only_here:
                    break


def near_in_partition(side: int, m: int, depth: int, only_here: bool, words: list[str]) -> Iterator[tuple[str, str]]:
    """The near pairs of one initial state. ``words`` share their first ``depth`` code points (side 1: the last)."""
    forward = words if side == 0 else [w[::-1] for w in words]
    head = forward[0][:depth]
    acceptor = Acceptor()
    short, long = (acceptor.add(sorted(w[depth:] for w in forward if len(w) == n)) for n in (m, m + 1))
    for x, y in acceptor.pairs(short, long, only_here):
        if side == 0:
            yield head + x, head + y
        else:
            a, b = (head + x)[::-1], (head + y)[::-1]
            if a[:m // 2] != b[:m // 2]:                 # else side 0 has it
                yield a, b


def vocabulary(docs: DataFrame, at_least: int = COUNT) -> DataFrame:
    """(word, n): the words of all texts with their counts."""
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.explode(
        F.regexp_extract_all(F.translate("text", upper, lower), F.lit(LETTERS), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.col("__id"), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % PLANT == 0, cut).otherwise(F.col("run"))
    found = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= SHORTEST)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= at_least)


def _dealt(words: DataFrame) -> DataFrame:
    """Each word at its initial states: side, m, gap (-1: the half is shared), key, depth, t (the word as read)."""
    size = F.length("word")
    lengths = F.filter(F.array(size - 1, size), lambda m: m >= SHORTEST)
    rows = words.select("word", "n", F.explode(lengths).alias("m"), F.lit(-1).alias("gap"))
    rows = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    half = F.floor(F.col("m") / 2).cast("int")
    rows = rows.withColumn("depth", F.when(F.col("side") == 0, half).otherwise(F.col("m") - half))
    rows = rows.withColumn("t", F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")))
    return rows.withColumn("key", F.substring("t", F.lit(1), F.col("depth")))


def _split(rows: DataFrame) -> DataFrame:
    """The rows of a too large half: one code point deeper, and those that may differ just there."""
    k, size = F.col("depth"), F.length("word")
    rest = F.concat(F.substring("t", F.lit(1), k), F.substring("t", k + 2, size))

    def to(gap: Column, key: Column, depth: Column) -> Column:
        return F.struct(gap.cast("int").alias("gap"), key.alias("key"), depth.alias("depth"))
    forms = F.array_compact(F.array(
        F.when(size > k, to(F.lit(-1), F.substring("t", F.lit(1), k + 1), k + 1)),
        F.when((size == F.col("m")) & (size > k), to(2 * k, rest, k)),                   # replaced at k
        F.when(size == F.col("m"), to(2 * k + 1, F.col("t"), k)),                        # inserted at k
        F.when(size > F.col("m"), to(2 * k + 1, rest, k))))
    return rows.select("word", "n", "m", "side", "t", F.explode(forms).alias("__f")).select(
        "word", "n", "m", "side", "t", "__f.*")


def _counted(rows: DataFrame) -> DataFrame:
    """The rows whose initial state has several words, with their number."""
    sizes = rows.groupBy(*_KEY).agg(F.count("*").alias("size")).where(F.col("size") > 1)
    return rows.join(sizes, _KEY)


def partitions(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(side, m, gap, key, depth, word, n): the words of every initial state with at least two, split below ``limit``."""
    rows, out = _counted(_dealt(words)), None
    while True:
        rows = written(rows, "states")
        big = (F.col("size") > limit) & (F.col("gap") == -1)
        out = rows.where(~big) if out is None else out.unionByName(rows.where(~big))
        if rows.where(big).isEmpty():
            return out.select(*_KEY, "depth", "word", "n")
        rows = _counted(_split(rows.where(big)))


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(a, na, b, nb): every pair of near words once, with their counts."""
    dealt = partitions(words, limit).repartition(*_KEY).sortWithinPartitions(*_KEY)

    def run(batches):
        out: tuple[list, list, list, list] = ([], [], [], [])

        def batch():
            got = pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())],
                                             ["a", "na", "b", "nb"])
            for x in out:
                x.clear()
            return got

        def group(key, held):
            side, m, gap, _, depth = key
            for a, b in near_in_partition(side, m, depth, gap >= 0, list(held)):
                for x, v in zip(out, (a, held[a], b, held[b]), strict=True):
                    x.append(v)
                if len(out[0]) >= OUT_ROWS:
                    yield batch()
        key, held = None, {}
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            for *k, word, n in zip(*cols, strict=True):
                if k != key:
                    if held:
                        yield from group(key, held)
                    key, held = k, {}
                held[word] = n
        if held:
            yield from group(key, held)
        yield batch()

    return dealt.mapInArrow(run, "a string, na bigint, b string, nb bigint")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, from (word, form): pointer doubling."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        at = written(at.join(ahead, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def variants(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text)."""
    words = written(vocabulary(docs), "vocabulary")
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("k")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("k")))
    near = near_words(words, limit).select(F.explode(both).alias("__p")).select("__p.*")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("k")).alias("k"), F.col("near").alias("w"))).alias("__b"))
    taken = -F.col("__b.k") >= RATIO * F.col("n")
    found = written(words.join(best, "word", "left").select(
        "word", F.when(taken, F.col("__b.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(taken, -F.col("__b.k")).alias("form_n")), "forms")
    roots = follow(found.where(F.col("form").isNotNull()).select("word", "form"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
