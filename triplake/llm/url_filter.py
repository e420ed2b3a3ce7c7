"""Operator 10, URL filter: host and path rules, word segmentation of host names, multinomial naive Bayes.

Rules decide where one fits (the longest wins). Every other url is judged by the method: host labels and path
parts are split at non-letters, each piece is cut into words by a unigram Viterbi search, and a multinomial
naive Bayes model scores the words. The unigram model is counted in Spark over all words of the pages' html plus the
seed words. The naive Bayes model learns from the pages themselves, which carry no labels, by a list of seed words
(a parameter): a url with a seed word among its segmented words is an example of the class to block, any other is an example of
the class to allow; token counts per class are summed in Spark. Word counts and
token weights, all of them, lie in the shared folder as sorted hash arrays that workers memory-map.

Defined results: null url or one without ``://`` has empty host and path, no rule, verdict allow; urls of any
length are judged, and words of any length count; equal urls get equal verdicts; null ids and extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, scratch, written
from .files import HashTable, write_hash_table

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
# Words that mark an example of the class to block.
SEEDS = ("spam", "farm", "cheap", "pills", "casino", "bets", "bet", "win", "adult", "xxx", "porn", "sex", "viagra",
         "loan", "loans", "free", "ads", "track", "tracker", "poker", "lottery", "replica", "escort", "clickbait")
SEED_COUNT = 200                 # count a seed word has in the unigram model at least
UNKNOWN = 0.9                    # cost of each letter of an unknown word
ASKED = 500_000                  # parts of pieces looked up at a time
ASKED_LETTERS = 5_000_000        # letters of the parts looked up at a time, of a long piece
SMOOTH = 20
_PIECE = re.compile(r"[a-z]+|[0-9]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text or null, its action or null): longest fitting rule."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, action = F.when(fits, h + p).otherwise(text), F.when(fits, act).otherwise(action)
    return text, action


class Segmenter:
    """Unigram Viterbi word segmentation; counts in memory go before those of a mapped table.

    A known word costs -log10 of its share; any other stretch is one unknown word that costs more the longer it is, so
    the best one ending at a place begins where ``best - UNKNOWN * place`` is least. Only known lengths are tried."""

    def __init__(self, counts: dict[str, int], table: HashTable | None = None, total: int = 0,
                 lengths: tuple[int, ...] = ()):
        total = (total or sum(counts.values())) + 1
        self.total = total
        self.held = {w: -math.log10(c / total) for w, c in counts.items()}
        self.cost = self.held
        self.table, self.lengths = table, lengths
        # the longest word first, so that ties go to fewer words
        self.tried = sorted({*map(len, counts), *lengths}, reverse=True)
        self.unknown = math.log10(total)
        self.seen: dict[str, list[str]] = {}

    def words(self, piece: str) -> list[str]:
        got = self.seen.get(piece)
        if got is None:
            self.learn([piece])
            got = self.seen[piece]
        return got

    def learn(self, pieces: list[str]) -> None:
        """Cut the pieces not cut yet; the table is asked for many of their parts at a time."""
        if len(self.seen) > 200_000:
            self.seen.clear()
        batch: list[str] = []
        asked: set[str] = set()
        for p in set(pieces).difference(self.seen):
            fits = [n for n in self.lengths if n <= len(p)] if self.table else []
            if len(p) * len(fits) > ASKED:               # parts of some places at a time
                self.seen[p] = self._cut(p, max(1, ASKED_LETTERS // sum(fits)))
                continue
            batch.append(p)
            asked.update(p[b:b + n] for n in fits for b in range(len(p) - n + 1))
            if len(asked) > ASKED:
                self._learn(batch, asked)
                batch, asked = [], set()
        self._learn(batch, asked)

    def _learn(self, batch: list[str], asked: set[str]) -> None:
        self._look(asked)
        for p in batch:
            self.seen[p] = self._cut(p)

    def _look(self, asked: set[str]) -> None:
        if self.table:
            got = self.table.found(list(asked))
            self.cost = {w: -math.log10(c / self.total) for w, c in got.items()} | self.held

    def all_tokens(self, hosts: list[str], paths: list[str]) -> list[list[str]]:
        """The tokens of many urls."""
        texts = [x for h in hosts for x in h.split(".")[:-1]] + [p.lower() for p in paths]
        self.learn([p for t in texts for p in _PIECE.findall(t) if p[0] > "9"])
        return [self.tokens(h, p) for h, p in zip(hosts, paths, strict=True)]

    def _cut(self, s: str, places: int = 0) -> list[str]:
        """The cheapest words of ``s``; with ``places`` the table is asked for the words that end at so many at a time."""
        best, back, begin = [0.0], [0], 0
        for e in range(1, len(s) + 1):
            if places and (e - 1) % places == 0:
                self._look({s[x - n:x] for x in range(e, min(e + places, len(s) + 1)) for n in self.lengths if n <= x})
            cost, start = best[begin] + self.unknown + UNKNOWN * (e - begin), begin
            for n in self.tried:
                c = self.cost.get(s[e - n:e]) if n <= e else None
                if c is not None and (best[e - n] + c < cost or (best[e - n] + c == cost and e - n < start)):
                    cost, start = best[e - n] + c, e - n
            best.append(cost)
            back.append(start)
            if cost - UNKNOWN * e < best[begin] - UNKNOWN * begin:
                begin = e
        out, e = [], len(s)
        while e:
            out.append(s[back[e]:e])
            e = back[e]
        return out[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of the host without its last label, then of the path; numbers become one token."""
        out = []
        for label in host.split(".")[:-1]:
            for p in _PIECE.findall(label):
                out += self.words(p) if p[0] > "9" else ["<num>"]
        for p in _PIECE.findall(path.lower()):
            out += ["/" + w for w in (self.words(p) if p[0] > "9" else ["<num>"])]
        return out


class Bayes:
    """Multinomial naive Bayes over tokens; class 1 is the one to block."""

    def __init__(self, table: HashTable, pages: tuple[int, int]):
        self.prior = math.log((pages[1] + 1) / (pages[0] + 1))
        self.table = table

    def log_odds(self, urls: list[list[str]]) -> list[float]:
        weight = self.table.found(list({t for tokens in urls for t in tokens}))
        return [self.prior + sum(weight.get(t, 0.0) for t in tokens) for tokens in urls]


def unigrams(html: DataFrame, seed_words=SEEDS) -> Segmenter:
    """The segmenter of all words of a table with one column of html, seed words included."""
    text = F.lower(F.regexp_replace(F.coalesce(html[0], F.lit("")), "<[^>]*>", " "))
    w = html.select(F.explode(F.split(text, "[^a-z]+", -1)).alias("w")).where("w != ''")
    counts = written(w.groupBy("w").agg(F.count("*").alias("n")), "url-words")
    seeds = {r["w"]: r["n"] for r in counts.where(F.col("w").isin(*seed_words)).collect()}
    raised = {s: max(SEED_COUNT, seeds.get(s, 0)) for s in seed_words}
    # one row a length
    sizes = counts.groupBy(F.length("w").alias("len")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in sizes) + sum(raised.values()) - sum(seeds.values())
    rows = counts.select(F.col("w").alias("key"), F.col("n").alias("value"))
    table = write_hash_table(rows, sum(r["words"] for r in sizes), scratch(html.sparkSession, "url-unigrams"))
    return Segmenter(raised, table, total, tuple(sorted(r["len"] for r in sizes)))


def token_counts(urls: DataFrame, segmenter: Segmenter, seed_words=SEEDS) -> Bayes:
    """The naive Bayes model of a table (host, path)."""
    arrow_batches(urls.sparkSession, 10_000)
    seeds = frozenset(seed_words)

    def run(batches):
        seen: Counter = Counter()
        for b in batches:
            urls = [(h, p) for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if h]
            for tokens in segmenter.all_tokens([h for h, _ in urls], [p for _, p in urls]):
                k = int(any(t in seeds for t in tokens))
                seen["", k] += 1
                for t in tokens:
                    seen[t, k] += 1
            if len(seen) > 200_000:
                yield _counted(seen)
                seen = Counter()
        yield _counted(seen)

    sums = urls.mapInArrow(run, "token string, block int, n bigint").groupBy("token").agg(
        F.sum(F.when(F.col("block") == 0, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("block") == 1, F.col("n")).otherwise(0)).alias("b"))
    sums = written(sums, "url-tokens")
    pages = sums.where("token = ''").select("a", "b").first() or (0, 0)
    words = sums.where("token != ''")
    n, *totals = words.agg(F.count("*"), F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    # each class is smoothed with SMOOTH tokens of the mixture of both, so that a token of one rare class is
    # not taken for the other class because that one is smaller
    mix = SMOOTH * (F.col("a") + F.col("b")) / F.lit(max(sum(totals), 1))
    weight = (F.log((F.col("b") + mix) / F.lit(totals[1] + SMOOTH))
              - F.log((F.col("a") + mix) / F.lit(totals[0] + SMOOTH)))
    rows = words.select(F.col("token").alias("key"), weight.alias("value"))
    return Bayes(write_hash_table(rows, n, scratch(urls.sparkSession, "url-weights")), tuple(pages))


def _counted(seen: Counter) -> pa.RecordBatch:
    items = list(seen.items())
    return pa.RecordBatch.from_arrays([
        pa.array([t for (t, _), _ in items], pa.string()), pa.array([k for (_, k), _ in items], pa.int32()),
        pa.array([n for _, n in items], pa.int64())], ["token", "block", "n"])


def judge(pages: DataFrame, *keep: str, seed_words=SEEDS) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict, words (segmented) and log_odds (of block) of every page."""
    host, path = parts(F.col("url"))
    urls = pages.select(*keep, host.alias("__host"), path.alias("__path"))
    segmenter = unigrams(pages.select("html"), seed_words)
    model = token_counts(urls.select("__host", "__path"), segmenter, seed_words)
    arrow_batches(pages.sparkSession, 10_000)

    def run(batches):
        for b in batches:
            hosts, paths = b.column("__host").to_pylist(), b.column("__path").to_pylist()
            words = segmenter.all_tokens(hosts, paths)
            odds = model.log_odds([w if h else [] for h, w in zip(hosts, words, strict=True)])
            yield pa.RecordBatch.from_arrays([
                *b.columns, pa.array([" ".join(w) for w in words], pa.string()), pa.array(odds, pa.float64())],
                [*b.schema.names, "__words", "__odds"])

    out = urls.mapInArrow(run, T.StructType([*urls.schema.fields, T.StructField("__words", T.StringType()),
                                             T.StructField("__odds", T.DoubleType())]))
    rule, action = rule_of(F.col("__host"), F.col("__path"))
    learned = F.when((F.col("__host") != "") & (F.col("__odds") > 0), "block").otherwise("allow")
    return out.select(*keep, F.col("__host").alias("host"), F.col("__path").alias("path"), rule.alias("rule"),
                      F.coalesce(action, learned).alias("verdict"), F.col("__words").alias("words"),
                      F.col("__odds").alias("log_odds"))
