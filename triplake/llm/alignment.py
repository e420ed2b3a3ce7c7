"""Operator 13, alignment of two tokenizers, Arrow-native.

Each task encodes its documents with both tokenizers (the byte-level one by tiktoken with the file's own vocabulary
where the text's characters have long been settled in Unicode, else by the tokenizers library: the same ids) and works on Arrow arrays of a bounded number of bytes:

1. the id lists are flattened; parent indices name the document of each token, and cumulative sums of the tokens'
   byte lengths, less the sum before the document, are the tokens' end offsets;
2. Acero joins the two token tables on document and end (one packed key), a full outer join: sorted by it, each row is a stretch
   of bytes between two neighbouring ends. Filling nulls backward gives the token of each side that covers the
   stretch, so each row is one link. Rows that both sides brought are the ends of groups;
3. ``Table.group_by`` reduces the links to pairs per document (with their number) and to the documents of each pair,
   kept as partial counts by the task.

The pairs are written beside the partial counts, so texts are encoded once. Spark merges the partial counts; sorted
arrays of pairs, counts and a mark for each first id's highest count are written in ranges of first ids, which the
vocabularies bound, and workers map them into memory to look up the written pairs.

Defined results: null and empty texts, and texts that either tokenizer changes (their bytes differ from space and
text), have no tokens: zeros and an empty digest; special tokens' strings are plain text; texts of any length (a long
one is a piece of work of its own); repeated rows count as often as they occur; null ids stay null; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import LATIN, byte_letters
from .common import arrow_batches, scratch, written
from .files import _located, write_whole
from .token_files import Encoder

WORK_BYTES = 1 << 20             # text of one round of Arrow tables (a longer document has a round of its own)
KEPT_PAIRS = 500_000             # partial counts of one task before they are merged, or handed on
ROW_PAIRS = 100_000              # pairs of one written row of partial counts
FIRST_BITS, SECOND_BITS = 9, 16  # first ids of one file; bits of an id in a pair
END_BITS = 40                    # bits of an end offset in a key of document and end
SPACE = "▁"
# The pattern that splits text before byte-level merges (a fixed value of the format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FAST_TEXT = 50_000               # code points of a text that tiktoken encodes; its pattern may not take very long runs
_UNSURE = re.compile("[\x1c-\x1f\x85]")
PAIRED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
          "pairs array<bigint>, times array<bigint>, partial boolean")


class Side:
    """One tokenizer: its encoding of texts, and the bytes of its tokens."""

    def __init__(self, tokens: list[bytes]):
        self.size = pa.array([len(t) for t in tokens], pa.int64())
        self.sizes = self.size.to_numpy()
        self.start = np.concatenate([[0], np.cumsum(self.sizes)])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.names = pa.array([str(i) for i in range(len(tokens))], pa.string())

    def joined(self, lists: pa.LargeListArray) -> list[bytes]:
        """The bytes of each list's tokens."""
        ids, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        start, size = self.start[ids], self.sizes[ids]
        until = np.cumsum(size, dtype=np.int64)
        data = self.bytes[np.repeat(start - until + size, size) + np.arange(until[-1] if len(until) else 0)].tobytes()
        cuts = np.concatenate([[0], until])[offsets].tolist()
        return [data[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


class ByteSide(Side):
    def __init__(self, path: str):
        self.tok = Encoder(path, plain=True)
        letters = {c: i for i, c in enumerate(byte_letters())}
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            tokens[i] = bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
        super().__init__(tokens)
        self.fast = self._ranked(path, tokens)

    def _ranked(self, path: str, tokens: list[bytes]):
        """The same vocabulary for tiktoken, where its ids are in the order of the merges; else nothing."""
        import tiktoken
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged):
            return None
        special = self.tok.tok.get_added_tokens_decoder()
        ranks = {t: i for i, t in enumerate(tokens) if i not in special}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _settled(self, text: str) -> bool:
        """Whether both libraries' character classes surely agree on a text."""
        return self.fast is not None and len(text) <= FAST_TEXT and (
            text.isascii() or max(text) <= LATIN) and not _UNSURE.search(text)

    def encode(self, texts: list[str]) -> list[list[int]]:
        settled = [self._settled(t) for t in texts]
        rest = iter(self.tok.encode([" " + t for t, ok in zip(texts, settled, strict=True) if not ok]))
        return [self.fast.encode_ordinary(" " + t) if ok else next(rest) for t, ok in zip(texts, settled, strict=True)]


class PieceSide(Side):
    def __init__(self, path: str):
        import sentencepiece
        self.tok = p = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__([bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else
                          p.id_to_piece(i).replace(SPACE, " ").encode() for i in range(p.get_piece_size())])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tok.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    pa.set_cpu_count(1)
    return ByteSide(path_a), PieceSide(path_b)


def _lists(ids: list[list[int]]) -> pa.LargeListArray:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, sizes.sum())
    return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]), flat)


def _tokens(lists: pa.LargeListArray, side: Side, name: str) -> pa.Table:
    """(document and end, id) of every token."""
    doc, ids = pc.list_parent_indices(lists), pc.list_flatten(lists)
    ends = pc.cumulative_sum(side.size.take(ids))
    before = pa.array(np.concatenate([[0], ends.to_numpy()])[lists.offsets.to_numpy()[:-1]])
    own = pc.subtract(ends, before.take(doc))
    return pa.table({"at": pc.bit_wise_or(pc.shift_left(doc, END_BITS), own), name: ids})


def _groups_text(links: pa.Table, doc: np.ndarray, cut: np.ndarray, docs: int, a: Side, b: Side) -> list[bytes]:
    """Per document the ids of its groups, as a1,a2|b1;a3|b2,b3."""
    halves = []
    for name, side in (("a", a), ("b", b)):
        own = links[name].combine_chunks()
        until = np.cumsum(own.is_valid().to_numpy(zero_copy_only=False))[cut]
        ids = side.names.take(own.drop_null())
        halves.append(pc.binary_join(pa.ListArray.from_arrays(np.concatenate([[0], until]).astype(np.int32), ids), ","))
    groups = pc.binary_join_element_wise(*halves, "|")
    ends = np.searchsorted(doc[cut], np.arange(docs + 1))
    return [(t.as_py() or "").encode()
            for t in pc.binary_join(pa.ListArray.from_arrays(ends.astype(np.int32), groups), ";")]


def align(texts: list[str | None], a: Side, b: Side) -> tuple[dict[str, list], pa.Table]:
    """Columns per text (n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) and the documents of each pair."""
    whole, n = [t or "" for t in texts], len(texts)
    sources = [(" " + t).encode() if t else b"" for t in whole]
    ids = [a.encode(whole), b.encode(whole)]
    lists = [_lists(x) for x in ids]
    bytes_of = [s.joined(x) for s, x in zip((a, b), lists, strict=True)]
    same = [t != b"" and t == x == y for t, x, y in zip(sources, *bytes_of, strict=True)]
    if not all(same):
        lists = [_lists([i if ok else [] for i, ok in zip(x, same, strict=True)]) for x in ids]
    links = _tokens(lists[0], a, "a").join(_tokens(lists[1], b, "b"), "at", join_type="full outer",
                                           use_threads=False).sort_by("at")
    cut = np.flatnonzero(pc.and_(links["a"].is_valid(), links["b"].is_valid()).to_numpy())
    doc = links["at"].to_numpy() >> END_BITS
    texts_of = _groups_text(links, doc, cut, n, a, b)
    pair = pc.bit_wise_or(pc.shift_left(pc.fill_null_backward(links["a"]), SECOND_BITS),
                          pc.fill_null_backward(links["b"]))
    held = pc.bit_wise_or(pc.shift_left(pa.array(doc), 2 * SECOND_BITS), pair.combine_chunks())
    of_doc = pa.table({"held": held}).group_by("held", use_threads=False).aggregate([([], "count_all")]).sort_by("held")
    pairs = pc.bit_wise_and(of_doc["held"], (1 << 2 * SECOND_BITS) - 1).combine_chunks()
    offsets = np.searchsorted(of_doc["held"].to_numpy() >> 2 * SECOND_BITS, np.arange(n + 1)).astype(np.int32)
    counted = pa.table({"pair": pairs}).group_by("pair", use_threads=False).aggregate(
        [([], "count_all")]).rename_columns(["pair", "n"])

    def per_doc(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=n).astype(np.int64)
    return {
        "n_a": lists[0].value_lengths(), "n_b": lists[1].value_lengths(), "n_groups": per_doc(doc[cut]),
        "n_links": per_doc(doc), "groups_sha256": [hashlib.sha256(t).hexdigest() if t else "" for t in texts_of],
        "pairs": pa.ListArray.from_arrays(offsets, pairs),
        "times": pa.ListArray.from_arrays(offsets, of_doc["count_all"].combine_chunks())}, counted


def _rounds(ids: list, texts: list[str | None]):
    """The documents of a batch in rounds of bounded text."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        more = len(t or "")
        if k > first and size + more > WORK_BYTES:
            yield ids[first:k], texts[first:k]
            first, size = k, 0
        size += more
    if ids:
        yield ids[first:], texts[first:]


def _added(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(
        ["pair", "n"])


_EMPTY = {"doc_id": None, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}


def _partial_rows(counts: pa.Table) -> pa.RecordBatch:
    """Partial counts as rows of the same table."""
    rows = [_EMPTY | {"pairs": counts["pair"][k:k + ROW_PAIRS].to_pylist(),
                      "times": counts["n"][k:k + ROW_PAIRS].to_pylist(), "partial": True}
            for k in range(0, len(counts), ROW_PAIRS)]
    return pa.RecordBatch.from_pylist(rows, _SCHEMA)


_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                     ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
                     ("partial", pa.bool_())])


def paired(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each document with its pairs, and rows of partial counts (``partial``)."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        a, b = sides(path_a, path_b)
        counts: list[pa.Table] = []
        for batch in batches:
            for ids, texts in _rounds(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out, counted = align(texts, a, b)
                columns = {"doc_id": ids, **out, "partial": [False] * len(ids)}
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                     for f, c in zip(_SCHEMA, columns.values(), strict=True)], schema=_SCHEMA)
                counts.append(counted)
                if sum(map(len, counts)) > KEPT_PAIRS:
                    counts = [_added(counts)]
                    if len(counts[0]) > KEPT_PAIRS // 2:
                        yield _partial_rows(counts.pop())
        if counts:
            yield _partial_rows(_added(counts))

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PAIRED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): how many documents hold each linked pair of ids."""
    parts = rows.where("partial").select(F.explode(F.arrays_zip("pairs", "times")).alias("__p"))
    return parts.groupBy(F.col("__p.pairs").alias("pair")).agg(F.sum("__p.times").alias("n"))


def write_counts(counts: DataFrame, folder: str) -> None:
    """Sorted pairs, their counts and marks for the highest count of a first id, one file for each range of first ids."""
    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by("pair")
        pair, n = t["pair"].to_numpy(), t["n"].to_numpy()
        starts = np.flatnonzero(np.diff(pair >> SECOND_BITS, prepend=-1))
        best = np.repeat(np.maximum.reduceat(n, starts), np.diff(starts, append=len(n))) == n
        write_whole(f"{folder}/pairs-{t['r'][0].as_py():06d}", pair.astype("<i8").tobytes(), n.astype("<i8").tobytes(),
                    best.astype(np.uint8).tobytes())
        return pa.table({"n": pa.array([len(n)], pa.int64())})

    rows = counts.withColumn("r", F.shiftright("pair", SECOND_BITS + FIRST_BITS))
    rows.groupBy("r").applyInArrow(run, "n bigint").agg(F.sum("n")).collect()


class Counts:
    """The written counts as a worker sees them: mapped files, or read ones where the folder is no mounted path."""

    def __init__(self, folder: str):
        self.folder, self.open = folder, {}

    def part(self, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if r not in self.open:
            system, path = _located(f"{self.folder}/pairs-{r:06d}")
            if "://" in self.folder and not self.folder.startswith("file:"):
                raw = np.frombuffer(system.open_input_file(path).read(), np.uint8)
            else:
                raw = np.memmap(path, np.uint8, "r")
            n = len(raw) // 17
            self.open[r] = raw[:8 * n].view("<i8"), raw[8 * n:16 * n].view("<i8"), raw[16 * n:]
        return self.open[r]

    def look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, is highest) of pairs that all have been counted."""
        n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        ranges = pairs >> (SECOND_BITS + FIRST_BITS)
        order = np.argsort(ranges, kind="stable")
        cuts = np.flatnonzero(np.diff(ranges[order], prepend=-1))
        for at in np.split(order, cuts[1:]) if len(pairs) else ():
            keys, counts, marks = self.part(int(ranges[at[0]]))
            k = np.searchsorted(keys, pairs[at])
            n[at], best[at] = counts[k], marks[k]
        return n, best


RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string")


def scored(rows: DataFrame, folder: str) -> DataFrame:
    """The documents of ``rows`` with n_best and count_sum from the counts in ``folder``."""
    arrow_batches(rows.sparkSession)

    def run(batches):
        counts = Counts(folder)
        for b in batches:
            offsets = b.column("pairs").offsets.to_numpy()
            pairs = b.column("pairs").values.to_numpy()[offsets[0]:offsets[-1]]
            times = b.column("times").values.to_numpy()
            first = b.column("times").offsets[0].as_py()
            times = times[first:first + len(pairs)]
            n, best = counts.look_up(pairs)
            offsets = offsets - offsets[0]
            sums = [np.concatenate([[0], np.cumsum(times * x)])[offsets] for x in (best, n)]
            more = [pa.array(np.diff(s), pa.int64()) for s in sums]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *more, b.column("groups_sha256")],
                                             ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                              "groups_sha256"])

    return rows.where(~F.col("partial")).drop("partial").mapInArrow(run, RESULT)


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: tokens of both sides, groups, links, links of highest count, sum of counts, digest of groups."""
    spark = docs.sparkSession
    rows = written(paired(docs, path_a, path_b), "paired")
    folder = scratch(spark, "pair-counts")
    write_counts(pair_counts(rows), folder)
    return scored(rows, folder)
