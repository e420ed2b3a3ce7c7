"""Operator 3, token files: frequency-ranked ids in byte-aligned variable-length code with separate control bytes.

1. Every text is encoded once by the tokenizers library, where the file's method allows in pieces cut at words, each
   different piece once and remembered (``Encoder``); its ids are kept in the shared folder as packed 16- or 32-bit integers, beside one row
   for each task that tells how often each id occurred in it. Ids are ranked by their summed count (ties: smaller id
   first), so that the most frequent 256 ids take one byte.
2. The packed documents are range-partitioned and sorted by id; each task writes files of up to ``FILE_TOKENS`` ids (a
   longer document has a file of its own) and tells what each file holds, so the ids before a file are known without
   reading it. A file is written under a passing name and then moved, so lost or repeated tasks leave whole files only.
3. The files are read back and decoded by numpy through a table of code lengths indexed by control byte.

File: 8 bytes magic, then int64 little-endian: part, first row of the file in the part, documents, ids, data
bytes; then int64 document ids, uint8 null-id flags, int64 id counts, control bytes (2 bits an id: code length
less one, first id in the low bits), data bytes. ``ranks.u32`` beside the files lists the id of each rank.

Defined results: null text encodes as empty (only the end id); null ids come first; equal ids are ordered by
their packed tokens, so order among rows that are still equal does not matter; empty table: no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_batches, scratch, written
from .files import write_whole

MAGIC = b"SVBRANK1"
END_ID = 2
FILE_TOKENS = 4 << 20

# Classes of bytes: two-byte letters (U+00C0 to U+023F without the two signs, U+0400 to U+047F) are letters too, and
# bytes of other characters and control bytes have class 0, beside which nothing is cut.
LETTER, DIGIT, SIGN, APOSTROPHE, SPACE, LINE = range(1, 7)
CLASS = bytes(LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else APOSTROPHE if b == 0x27 else
              SPACE if b == 0x20 else LINE if 9 <= b <= 13 else SIGN if 0x21 <= b <= 0x7E else 0
              for b in range(128)) + bytes(128)
# Pairs of classes (8 * former + latter) between which byte-level pre-tokenization always ends a token, whatever else a text
# holds. An apostrophe may begin a contraction, a space goes with what follows it.
ENDS = {LETTER: (DIGIT, SIGN, APOSTROPHE, SPACE, LINE), DIGIT: (LETTER, SIGN, APOSTROPHE, SPACE, LINE),
        SIGN: (LETTER, DIGIT, SPACE, LINE), APOSTROPHE: (SPACE, LINE)}
PAIR = bytes(b & 7 in ENDS.get(b >> 3, ()) for b in range(256))
VISIBLE = np.isin(np.arange(8), [LETTER, DIGIT, SIGN, APOSTROPHE])

PIECE_CHARS = 64          # pieces of more bytes are not remembered
PIECES = 1 << 19          # remembered pieces of one generation (some 100 MB a worker); there are two
CALL_PIECES = 500         # new pieces in one call of the library, whose results hold much more than the ids
SLICE_BYTES = 8 << 20     # text whose pieces are held at once (a longer text has its own slice)


def cuts_at_words(file: dict) -> bool:
    """Whether a tokenizers file encodes what is between two ``cuts`` on its own: byte-level BPE with the regular
    expression that splits before words, without a normaliser, an added prefix or chance."""
    pre, model = file["pre_tokenizer"] or {}, file["model"]
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex") is True and pre.get("add_prefix_space") is False
            and not file.get("normalizer") and model.get("type") == "BPE" and not model.get("dropout")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))


def cuts(data: np.ndarray) -> np.ndarray:
    """For each place in UTF-8 bytes, both ends included, whether pieces that end and begin there are encoded as the whole
    is: between ``ENDS``, and after a single line end or tab that stands between visible characters."""
    kind = np.frombuffer(bytearray(data.tobytes().translate(CLASS)), np.uint8)
    two = np.flatnonzero((data >= 0xC3) & (data <= 0xD1))
    lead, follow = data[two], data[two + 1]
    two = two[((lead <= 0xC8) | (lead >= 0xD0)) & ((lead != 0xC3) | (follow != 0x97) & (follow != 0xB7))]
    kind[two] = kind[two + 1] = LETTER
    out = np.zeros(len(data) + 1, bool)
    out[1:-1] = np.frombuffer((kind[:-1] << 3 | kind[1:]).tobytes().translate(PAIR), bool)
    line = np.flatnonzero(kind[1:-1] == LINE) + 1
    out[line[VISIBLE[kind[line - 1]] & VISIBLE[kind[line + 1]]] + 1] = True
    return out


class Encoder:
    """A tokenizers file. With ``plain`` the strings of special tokens are ordinary text.

    ``packed`` gives the same ids as ``encode``. Where ``cuts_at_words`` holds, it cuts many texts at once, looks each
    different piece up once, lets the library encode the new ones and remembers their ids. Texts that hold the string of
    an added token, which may span pieces, are encoded whole.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.by_word = cuts_at_words(file)
        self.added = [t["content"] for t in file.get("added_tokens") or []]
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.kind = width(self.tok.get_vocab_size())

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]

    def packed(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """The ids of each text as integers of ``kind``."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return []
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        size = off[-1] - off[0]
        rows = np.searchsorted(off[1:] - off[0], np.arange(1, size // SLICE_BYTES) * SLICE_BYTES) + 1
        rows = np.unique([0, *rows, len(texts)]).tolist()
        return [x for i, j in pairwise(rows) for x in self._packed(texts[i:j], off[i:j + 1])]

    def _packed(self, texts: pa.Array, off: np.ndarray) -> list[bytes]:
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        cut = cuts(data) if self.by_word else np.zeros(len(data) + 1, bool)
        for a in self.added:
            for i in np.flatnonzero(pc.match_substring(texts, a)):
                cut[off[i]:off[i + 1]] = False
        cut[off] = True
        at = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        ids = self._ids(pieces.dictionary.to_pylist())
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        which = pieces.indices.to_numpy()
        ends = np.cumsum(n[which])
        # the place of each id among those of the different pieces
        begin = np.repeat((np.cumsum(n) - n)[which] - ends + n[which], n[which])
        flat = np.frombuffer(b"".join(ids), self.kind)[begin + np.arange(len(begin))].tobytes()
        ends = (np.concatenate([[0], ends])[np.searchsorted(at, off)] * self.kind.itemsize).tolist()
        return [flat[i:j] for i, j in pairwise(ends)]

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of different pieces. What is asked for again moves from the old generation to the new one."""
        if len(self.known) >= PIECES:
            self.old, self.known = self.known, {}
        found = [*map(self.known.get, pieces)]
        lacking = [p for p, x in zip(pieces, found, strict=True) if x is None]
        moved = [*map(self.old.get, lacking)]
        new = [p for p, x in zip(lacking, moved, strict=True) if x is None]
        ids = iter(self._encoded(new))
        moved = [next(ids) if x is None else x for x in moved]
        self.known.update(zip(lacking, moved, strict=True))
        for p in new:
            if len(p) > PIECE_CHARS:
                del self.known[p]
        ids = iter(moved)
        return [next(ids) if x is None else x for x in found]

    def _encoded(self, pieces: list[bytes]) -> list[bytes]:
        out = []
        for i in range(0, len(pieces), CALL_PIECES):
            ids = self.encode([p.decode() for p in pieces[i:i + CALL_PIECES]])
            flat = np.fromiter(chain.from_iterable(ids), self.kind).tobytes()
            ends = (np.cumsum([0, *map(len, ids)], dtype=np.int64) * self.kind.itemsize).tolist()
            out += [flat[a:z] for a, z in pairwise(ends)]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of uint32 values."""
    v = values.astype("<u4")
    extra = ((v > 0xFF).view(np.uint8) + (v > 0xFFFF).view(np.uint8) + (v > 0xFFFFFF).view(np.uint8))
    quads = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    quads[:len(v)] = extra
    q = quads.reshape(-1, 4)
    control = q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


# code lengths of the four ids of each control byte
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    start = np.cumsum(lengths) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    v = padded[start].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        v |= padded[start + k].astype(np.uint32) << np.uint32(8 * k)
    return v & MASKS[lengths]


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at least ``SLICE_BYTES`` of text (the last one may be smaller)."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= SLICE_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


PACKED = "doc_id bigint, ids binary, counts array<bigint>"


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row for each document with its packed ids, and one for each task with the count of every id (``counts``)."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        enc = encoder(tokenizer)
        total = np.zeros(max(END_ID + 1, enc.tok.get_vocab_size()), np.int64)
        for b in gathered(batches):
            packed = enc.packed(b.column(1))
            n = np.bincount(np.frombuffer(b"".join(packed), enc.kind), minlength=len(total))
            total = n + np.pad(total, (0, len(n) - len(total)))
            total[END_ID] += len(packed)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(packed, pa.binary()), pa.nulls(len(packed), pa.list_(pa.int64()))],
                ["doc_id", "ids", "counts"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                          pa.array([total.tolist()], pa.list_(pa.int64()))],
                                         ["doc_id", "ids", "counts"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PACKED)


def width(vocabulary: int) -> np.dtype:
    """The integer that holds any id."""
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def count_ids(packed: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs over all texts, end ids included."""
    parts = packed.where(F.col("counts").isNotNull()).select(F.posexplode("counts").alias("id", "n"))
    return parts.where("n > 0").groupBy("id").agg(F.sum("n").alias("n"))


def _file(part: int, first: int, ids: list, nulls: list, counts: list, ranks: list[np.ndarray]) -> list[bytes]:
    v = np.concatenate(ranks)
    control, data = pack(v)
    head = np.array([part, first, len(ids), len(v), len(data)], "<i8")
    return [MAGIC, head.tobytes(), np.array(ids, "<i8").tobytes(), np.array(nulls, np.uint8).tobytes(),
            np.array(counts, "<i8").tobytes(), control, data]


FILES = "part bigint, first bigint, docs bigint, n bigint"


def write(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Write the files of ``docs`` (doc_id, text) and ``ranks.u32`` to ``folder``; (part, first, docs, n) of each file."""
    packed = written(encoded(docs, tokenizer), "packed", compression="zstd")
    # one row for each id of the vocabulary: bounded by the tokenizer, not by the corpus
    counted = count_ids(packed).orderBy(F.desc("n"), "id").select("id").collect()
    by_rank = np.array([r["id"] for r in counted] or [END_ID], "<u4")
    rank_of = np.zeros(int(by_rank.max()) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    arrow_batches(docs.sparkSession)

    def run(batches):
        part, kind = TaskContext.get().partitionId(), width(encoder(tokenizer).tok.get_vocab_size())
        first, row, size = 0, 0, 0
        held: tuple[list, list, list, list] = ([], [], [], [])
        if part == 0:
            write_whole(f"{folder}/ranks.u32", by_rank.tobytes())

        def flush():
            write_whole(f"{folder}/part-{part:06d}-{first:012d}.svb", *_file(part, first, *held))
            told = pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, first, len(held[0]), size)],
                                              ["part", "first", "docs", "n"])
            for x in held:
                x.clear()
            return told
        end = rank_of[END_ID:END_ID + 1]
        for b in batches:
            for doc, packed_ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(packed_ids, kind)
                held[0].append(doc or 0)
                held[1].append(doc is None)
                held[2].append(len(ids) + 1)
                held[3].extend((rank_of[ids], end))
                size, row = size + len(ids) + 1, row + 1
                if size >= FILE_TOKENS:
                    yield flush()
                    first, size = row, 0
        if size:
            yield flush()

    rows = packed.where(F.col("counts").isNull()).select("doc_id", "ids")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    return written(ordered.mapInArrow(run, FILES), "files")


def read_file(content: bytes) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """part, first row, document ids, null flags, id counts and ranks of a file's bytes."""
    if content[:8] != MAGIC:
        raise ValueError("not a token file")
    part, first, docs, n, size = np.frombuffer(content, "<i8", 5, 8).tolist()
    at = 48
    ids, at = np.frombuffer(content, "<i8", docs, at), at + 8 * docs
    nulls, at = np.frombuffer(content, np.uint8, docs, at), at + docs
    counts, at = np.frombuffer(content, "<i8", docs, at), at + 8 * docs
    quads = -(-n // 4)
    return part, first, ids, nulls, counts, unpack(content[at:at + quads], content[at + quads:at + quads + size], n)


def read(spark: SparkSession, folder: str, column: str = "ids array<int>", of=None) -> DataFrame:
    """Per document of the files: doc_id, part, first (of its file), at (ids of the file before it), n_tokens, ids.

    ``of`` maps the ids of one document (uint32) to the value of ``column`` instead, in the task that decodes them.
    """
    arrow_batches(spark, 1)
    table = spark.read.format("binaryFile").option("pathGlobFilter", "ranks.u32").load(folder).select("content").first()
    by_rank = np.frombuffer(table["content"], "<u4") if table else np.zeros(0, np.uint32)

    def run(batches):
        for b in batches:
            for content in b.column(0):
                part, first, ids, nulls, counts, ranks = read_file(content.as_py())
                ends = np.cumsum(counts)
                # half a million ids a batch, whatever the file holds
                cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1], 1 << 19), side="right"))
                for a, z in zip(cuts, [*cuts[1:], len(ids)], strict=True):
                    lo = ends[a] - counts[a]
                    flat = by_rank[ranks[lo:ends[z - 1]]]
                    off = np.concatenate([[0], ends[a:z] - lo]).astype(np.int32)
                    last = (pa.ListArray.from_arrays(off, flat.astype(np.int32)) if of is None else
                            pa.array([of(flat[i:j]) for i, j in zip(off[:-1], off[1:], strict=True)]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[a:z], mask=nulls[a:z].astype(bool)), pa.array(np.full(z - a, part), pa.int64()),
                        pa.array(np.full(z - a, first), pa.int64()), pa.array(ends[a:z] - counts[a:z], pa.int64()),
                        pa.array(counts[a:z], pa.int64()), last],
                        ["doc_id", "part", "first", "at", "n_tokens", column.split()[0]])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.svb").load(folder).select("content")
    return files.mapInArrow(run, f"doc_id bigint, part bigint, first bigint, at bigint, n_tokens bigint, {column}")


def file_starts(files: DataFrame) -> DataFrame:
    """(part, first, base): ids before each file. Files are summed per part, parts in one short window."""
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("__p"))
    inner = F.coalesce(F.sum("n").over(before.partitionBy("part").orderBy("first")), F.lit(0))
    return files.select("part", "first", inner.alias("__f")).join(parts, "part").select(
        "part", "first", (F.col("__p") + F.col("__f")).alias("base"))


def crc32_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode_and_read(docs: DataFrame, tokenizer: str, column: str = "ids array<int>", of=None) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder, read them back: doc_id, start, n_tokens, column."""
    spark = docs.sparkSession
    folder = scratch(spark, "tokens")
    files = write(docs, folder, tokenizer)
    if files.isEmpty():
        return spark.createDataFrame([], f"doc_id bigint, start bigint, n_tokens bigint, {column}")
    return read(spark, folder, column, of).join(file_starts(files), ["part", "first"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", column.split()[0])
