"""Operator 6, byte-pair encoding by backtracking, decoding by an offset table.

A word is cut into symbols (bytes, the last one marked as word end). An Aho-Corasick automaton over all tokens
gives the longest token that starts at each position. The encoder takes the longest token; a token may follow
its predecessor only if the pair is compatible, that is, if encoding the two joined texts from scratch yields
just these two tokens. Otherwise the next shorter prefix token is tried, and where none is left the predecessor
is taken back and its end marked as dead, so that no position is entered twice: linear time, and the result
equals the merges in rank order.

Texts are normalised as the file says: special tokens are found first, then NFC, white space to one space, lower
case by character; the split pattern never crosses white space, so encodings of chunks between white space are
remembered in a bounded cache.

Decoding joins the token strings with one space: ids index into one byte table through an array of offsets.

Defined results: null text encodes as empty, decodes to the empty string; texts and words of any length;
rows are handled one by one (repeated rows, null ids, clashing extra columns, empty tables as they are).
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import arrow_batches

CACHE_CHUNKS = 200_000           # entries of one generation; there are two
CACHE_WORDS = 100_000
CACHE_PAIRS = 300_000
LATIN = "\u024f"            # up to here Unicode has long been settled
WORD_END = "</w>"
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"     # Unicode White_Space
_SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
_SPACES = regex.compile(f"[{SPACE}]+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


def lower(text: str) -> str:
    """Lower case character by character (no final-sigma rule)."""
    return text.replace("Σ", "σ").lower() if "Σ" in text else text.lower()


class Remembered:
    """A bounded table in two generations: a full one becomes the old one, what is asked for again moves up."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        got = self.new.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(key) < 64:
            if len(self.new) >= self.size:
                self.old, self.new = self.new, {}
            self.new[key] = value


class Vocabulary:
    """Tokens as strings of symbols: character b is byte b inside a word, 256 + b is byte b at its end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        letters = {c: i for i, c in enumerate(byte_letters())}

        def symbols(token: str) -> str:
            end = token.endswith(WORD_END)
            b = [letters[c] for c in (token[:-len(WORD_END)] if end else token)]
            return "".join(map(chr, b[:-1])) + chr(b[-1] + 256 * end)

        # rank: the 512 symbols first, then the merges in their order
        base = {chr(i): i for i in range(512)}
        self.text: list[str] = list(base)
        self.split: list[tuple[int, int]] = [(i, i) for i in range(512)]
        rank = dict(base)
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in model["merges"]:
            pair = rank[symbols(left)], rank[symbols(right)]
            joined = self.text[pair[0]] + self.text[pair[1]]
            if joined in rank:
                raise ValueError(f"two merges make {left + right!r}")
            self.merged[pair] = rank[joined] = len(self.text)
            self.text.append(joined)
            self.split.append(pair)
        ids = {symbols(t): i for t, i in model["vocab"].items()}
        self.ids = np.array([ids.get(t, -1) for t in self.text], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # leftmost, then longest
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.length = [len(t) for t in self.text]
        self.known: dict[tuple[int, int], bool] = {}
        # only tokens that their own text encodes to can appear in a result
        self.usable = [True] * len(self.text)
        for t in range(512, len(self.text)):
            left, right = self.split[t]
            self.usable[t] = self.usable[left] and self.usable[right] and self.compatible(left, right, below=t)
            if not self.usable[t]:
                del self.merged[left, right]
        usable = {s: t for t, s in enumerate(self.text) if self.usable[t]}
        self.prefix = [next((usable[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in usable), -1)
                       for s in self.text]
        self.automaton = ahocorasick.Automaton()
        for s, t in usable.items():
            self.automaton.add_word(s, t)
        self.automaton.make_automaton()
        self.chunks, self.words = Remembered(CACHE_CHUNKS), Remembered(CACHE_WORDS)
        self.letters = letters
        self.tok = Tokenizer.from_file(path)
        content = dict(model["vocab"].items()) | self.special
        names = [""] * (max(content.values()) + 1)
        for t, i in content.items():
            names[i] = t
        joined = [(t + " ").encode() for t in names]
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in joined])])
        self.bytes = np.frombuffer(b"".join(joined), np.uint8)

    def compatible(self, a: int, b: int, below: int | None = None) -> bool:
        """Whether no merge ranked under ``below`` would join across the border of a and b.

        Undo the later of the two tokens' merges step by step, facing the border, and look at each step
        whether the two pieces that then meet would have been merged before.
        """
        limit = len(self.text) if below is None else below
        while True:
            if self.merged.get((a, b), limit) < limit:
                return False
            # the later merge is undone first; a base symbol splits into itself and leaves the other side
            if a >= 512 and (a > b or b < 512):
                limit, a = a, self.split[a][1]
            elif b >= 512:
                limit, b = b + 1, self.split[b][0]
            else:
                return True

    def pair_fits(self, a: int, b: int) -> bool:
        fits = self.known.get((a, b))
        if fits is None:
            if len(self.known) > CACHE_PAIRS:
                self.known.clear()
            fits = self.known[a, b] = self.compatible(a, b)
        return fits

    def word(self, data: bytes) -> list[int]:
        """Ranks of one word's tokens."""
        n = len(data)
        text = data[:-1].decode("latin-1") + chr(256 + data[-1])
        longest, size = [0] * n, [0] * n
        for end, t in self.automaton.iter(text):
            k = self.length[t]
            if k > size[end + 1 - k]:
                size[end + 1 - k], longest[end + 1 - k] = k, t
        out: list[int] = []
        alive = bytearray(b"\1" * (n + 1))
        at, t = 0, longest[0]
        while at < n:
            end = at + self.length[t]
            if alive[end] and (not out or self.pair_fits(out[-1], t)):
                out.append(t)
                at = end
                t = longest[at] if at < n else 0
            elif self.prefix[t] >= 0:
                t = self.prefix[t]
            else:                                        # dead end: take the last token back and shorten it
                alive[at] = 0
                t = out.pop()
                at -= self.length[t]
        return out

    def word_ids(self, data: bytes) -> bytes:
        got = self.words.get(data)
        if got is None:
            ids = self.ids[self.word(data)]
            got = ids[ids >= 0].astype(np.int32).tobytes()
            self.words.put(data, got)
        return got

    def chunk(self, chunk: str) -> bytes:
        """Ids (int32 bytes) of a text without special tokens."""
        got = self.chunks.get(chunk)
        if got is None:
            if chunk.isascii() or max(chunk, default="") <= LATIN:
                words = [w.encode() for w in _SPLIT.findall(lower(unicodedata.normalize("NFC", chunk)))]
            else:
                # rare scripts: the library's Unicode tables decide what is a letter or composes
                pieces = self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(chunk))
                words = [bytes(map(self.letters.__getitem__, w)) for w, _ in pieces]
            got = b"".join(map(self.word_ids, words))
            self.chunks.put(chunk, got)
        return got

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        out, parts = [], [text]
        if "<|" in text:                                 # plain text and special tokens in turn
            parts = self.specials.split(text)
        for text, special in zip(parts[::2], [*parts[1::2], None], strict=True):
            out += self.plain(text)
            if special is not None:
                out.append(np.int32(self.special[special]).tobytes())
        return np.frombuffer(b"".join(out), np.int32)

    def plain(self, text: str) -> Iterator[bytes]:
        """Ids of the chunks of a text without special tokens."""
        # str.split() knows four separators more than the pattern
        return map(self.chunk, _SPACES.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split())

    def decode(self, ids: np.ndarray) -> bytes:
        """The token strings joined with one space, in UTF-8."""
        if not len(ids):
            return b""
        ids = ids.astype(np.int64)
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        shift = np.repeat(start - (np.cumsum(size) - size), size)
        return self.bytes[shift + np.arange(len(shift))][:-1].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, *keep: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``keep`` columns and ``ids`` (array of int); with ``decoded`` also what these ids decode to, in the same task."""
    arrow_batches(docs.sparkSession)
    source = docs.select(*keep, docs[text].alias("__text"))

    def run(batches):
        v = vocabulary(path)
        for b in batches:
            ids = [v.encode(t) for t in b.column("__text").to_pylist()]
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int32), *ids]))
            more = [pa.array(map(v.decode, ids), pa.binary()).cast(pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], flat, *more],
                                             [*b.schema.names[:-1], "ids", *["decoded"][:decoded]])

    kept = source.drop("__text").schema.fields
    more = [T.StructField("decoded", T.StringType())] if decoded else []
    return source.mapInArrow(run, T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType())), *more]))


def decode(df: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded`` to a table with ``ids`` (a null element of ids is left out)."""
    fields = df.schema.fields
    at = df.columns.index("ids")

    def run(batches):
        v = vocabulary(path)
        for b in batches:
            col = b.column(at)
            flat, off = col.flatten().to_numpy(zero_copy_only=False), col.offsets.to_numpy()
            off = off - off[0]
            texts = [v.decode(flat[s:e]) for s, e in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary()).cast(pa.string())],
                                             [*b.schema.names, "decoded"])

    return df.mapInArrow(run, T.StructType([*fields, T.StructField("decoded", T.StringType())]))
