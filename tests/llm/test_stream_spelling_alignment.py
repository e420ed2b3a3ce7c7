"""Stream de-duplication, spelling variants and token alignment against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from triplake.llm import alignment, spelling, stream_dedup
from triplake.llm.common import scratch

SCHEMA = "doc_id bigint, text string, digest string, pairs string, word string"
TEXTS = [None, "", " ", "a", "A", "a ", "Straße", "STRASSE", "É", "é", "x" * 70_000, "X" * 70_000, "n\x00ul", "日本語 😀"]


@pytest.fixture(autouse=True)
def few_groups(monkeypatch):
    monkeypatch.setattr(stream_dedup, "BUCKET", 1)


def lowered(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def rows_of(texts, first=0):
    return [(first + i, t, "clash", "clash", "clash") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(11)
    words = ["Alpha", "alpha", "beta", "the", "THE", "naïve", "supercalifragilistic", "don't", "x1", "ß"]
    texts = TEXTS + [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 30]))) for _ in range(120)]
    return rows_of(texts) + [(None, "a", "clash", "clash", "clash"), (None, None, None, None, None)] + rows_of(["a"], 3)


def groups_of(rows):
    found = collections.defaultdict(list)
    for r in rows:
        found[lowered(r[1])].append(-1 if r[0] is None else r[0])
    return sorted(((r[0] if r[0] is not None else -1), hashlib.sha256(lowered(r[1]).encode()).hexdigest(),
                   max(found[lowered(r[1])]), len(found[lowered(r[1])]),
                   (-1 if r[0] is None else r[0]) == max(found[lowered(r[1])])) for r in rows)


def streamed(spark, folder, name, rows):
    """Add ``rows`` to a landing folder; the stream over it."""
    path = f"{folder}/{name}"
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(path)
    return stream_dedup.stream(spark, path), spark.read.schema(SCHEMA).parquet(path)


def as_rows(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.digest, -1 if r.keep_id is None else r.keep_id, r.group_size,
                   r.kept) for r in df.collect())


def test_stream_dedup_keeps_state_between_runs(spark, docs):
    folder = scratch(spark, "test")
    half = len(docs) // 2
    for rows in (docs[:half], docs[half:], []):
        stream, batch = streamed(spark, folder, "landing", rows)
        stream_dedup.advance(stream, f"{folder}/dedup")
    got = as_rows(stream_dedup.result(batch, f"{folder}/dedup"))
    assert got == groups_of(docs)


def test_stream_dedup_compares_bytes_when_digests_are_equal(spark, docs):
    folder = scratch(spark, "test")

    def weak(text):                                      # many different texts share a digest
        return F.when(F.length(text) < 40, F.lit("0")).otherwise(F.sha2(text, 256))
    for rows in (docs[::2], docs[1::2]):
        stream, batch = streamed(spark, folder, "landing", rows)
        stream_dedup.advance(stream, f"{folder}/dedup", weak)
    got = stream_dedup.result(batch, f"{folder}/dedup", weak)
    want = [(a, c, d, e) for a, _, c, d, e in groups_of(docs)]
    assert sorted((a, c, d, e) for a, _, c, d, e in as_rows(got)) == sorted(want)


def test_stream_dedup_of_an_empty_table(spark):
    folder = scratch(spark, "test")
    stream, batch = streamed(spark, folder, "landing", [])
    stream_dedup.advance(stream, f"{folder}/dedup")
    assert stream_dedup.result(batch, f"{folder}/dedup").count() == 0


def test_content_is_compared_in_pieces(tmp_path, monkeypatch):
    monkeypatch.setattr(stream_dedup, "PIECE", 7)
    monkeypatch.setattr(stream_dedup, "OPEN_FILES", 1)
    at = []
    for data in (b"abcdefghij" * 3, b"abcdefghij" * 2 + b"abcdefghiX", b""):
        writer = stream_dedup.ContentWriter(str(tmp_path))
        at += [writer.put(data), writer.put(data)]
        writer.close()
    reader = stream_dedup.ContentReader()
    assert [reader.equal(at[0], x) for x in at] == [True, True, False, False, False, False]
    assert reader.equal(at[4], at[5]) and reader.read(*at[2]).endswith(b"X")


# ---------------------------------------------------------------- spelling variants
def is_near(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute_variants(rows):
    n = collections.Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = collections.defaultdict(list)
    for u, v in itertools.combinations(sorted(n), 2):
        if is_near(u, v):
            near[u].append(v)
            near[v].append(u)
    form = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: f for w, f in form.items() if n[f] >= 2 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w, ""), root(w), n[w], len(near[w]), n[form[w]] if w in form else -1) for w in n)


def variants_of(df, **kw):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n)
                  for r in spelling.variants(df, **kw).collect())


@pytest.fixture(scope="module")
def spelled():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abÀ") for _ in range(rnd.choice([5, 5, 6, 7, 9]))) for _ in range(260)]
    weights = [rnd.choice([1, 1, 2, 5, 30]) for _ in words]
    texts = [" ".join(rnd.choices(words, weights, k=60)) + rnd.choice(["", ".", " X1y", " ÷ñandú"]) for _ in range(90)]
    long = "q" * 20_000
    texts += [None, "", "abcde" * 2000, f"{long} {long}a {long} {long} {long}a {long}a"]
    return rows_of(texts) + [(None, "aaaaa aaaab", "c", "c", "c"), *rows_of(["aaaaa"], 3), *rows_of(["aaaaa"], 3)]


def test_spelling_variants_equal_brute_force(spark, spelled):
    want = brute_variants(spelled)
    assert variants_of(spark.createDataFrame(spelled, SCHEMA)) == want
    assert sum(f != "" for _, f, *_ in want) > 20 and any(r not in (f, w) for w, f, r, *_ in want)


def test_spelling_split_of_hot_halves_is_exact(spark, spelled):
    assert variants_of(spark.createDataFrame(spelled, SCHEMA), limit=6) == brute_variants(spelled)


def test_spelling_of_empty_tables(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None, "", "", "")], SCHEMA)).count() == 0


def test_acceptor_is_minimal():
    a = spelling.Acceptor()
    a.add(["abx", "aby", "cbx", "cby"])
    assert len(a.arcs) == 4                              # start, behind the first, behind the second, end


def test_forms_are_followed_over_many_steps(spark):
    chain = [(f"w{k:03d}", f"w{k + 1:03d}") for k in range(40)]
    got = spelling.follow(spark.createDataFrame(chain, "word string, form string")).collect()
    assert len(got) == 40 and {r.root for r in got} == {"w040"}


# ---------------------------------------------------------------- token alignment
def paths():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_alignment(rows):
    from tokenizers import Tokenizer
    import sentencepiece
    tok = Tokenizer.from_file(paths()[0])
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=paths()[1])
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(
        b for b in range(256) if b not in plain)}

    def piece(i):
        return (bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
                sp.id_to_piece(i).replace("▁", " ").encode())
    out, seen = [], collections.Counter()
    for i, t, *_ in rows:
        text, linked, digest, counts = t or "", [], "", (0, 0, 0)
        ids = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        parts = [bytes(letter[c] for c in tok.id_to_token(k)) for k in ids[0]], [piece(k) for k in ids[1]]
        if text and all(b"".join(p) == (" " + text).encode() for p in parts):
            at = [[(sum(map(len, p[:k])), sum(map(len, p[:k + 1]))) for k in range(len(p))] for p in parts]
            linked = [(a, b) for a, (s, e) in zip(ids[0], at[0], strict=True)
                      for b, (u, v) in zip(ids[1], at[1], strict=True) if s < v and u < e]
            cuts = sorted({e for _, e in at[0]} & {e for _, e in at[1]})
            groups = [[",".join(str(k) for k, (_, e) in zip(own, place, strict=True) if lo < e <= hi)
                       for own, place in zip(ids, at, strict=True)] for lo, hi in zip([0, *cuts], cuts, strict=False)]
            digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest()
            counts = len(ids[0]), len(ids[1]), len(cuts)
        seen.update(set(linked))
        out.append((i, *counts, linked, digest))
    best = collections.defaultdict(int)
    for (a, _), k in seen.items():
        best[a] = max(best[a], k)
    return sorted((-1 if i is None else i, na, nb, ng, len(ls), sum(seen[x] == best[x[0]] for x in ls),
                   sum(seen[x] for x in ls), d) for i, na, nb, ng, ls, d in out)


def aligned(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in alignment.alignment(df, *paths()).collect())


def test_alignment_equals_brute_force(spark, docs):
    more = ["<s> hi </s> <|endoftext|>", "a▁b", "é ﬁ ①", "tab\tnl\n\nx  y", "\x85z", "é", "🇩🇪👩‍👩‍👧"]
    rows = [(i, t if t is None or len(t) < 900 else t[:900], *c) for i, t, *c in docs] + rows_of(more, 900)
    assert aligned(spark.createDataFrame(rows, SCHEMA)) == brute_alignment(rows)


def test_both_encoders_give_the_same_ids():
    """Texts that the fast encoder takes, character by character and at random, against the library."""
    a, _ = alignment.sides(*paths())
    rnd = random.Random(3)
    letters = [chr(c) for c in range(0x250)]
    texts = [f"a{c}b {c}{c} 1{c}'{c}s" for c in letters]
    texts += ["".join(rnd.choice(letters + list(" \n\t'sdl19.,")*20) for _ in range(rnd.choice([5, 80]))) for _ in range(2000)]
    assert a.fast is not None and sum(map(a._settled, texts)) > 2000
    assert a.encode(texts) == a.tok.encode([" " + t for t in texts])


def test_alignment_in_small_rounds(spark, docs, monkeypatch):
    """Rounds, merged partial counts and their rows give what one round gives."""
    a, b = alignment.sides(*paths())
    texts = [t for _, t, *_ in docs]
    whole, counted = alignment.align(texts, a, b)
    monkeypatch.setattr(alignment, "WORK_BYTES", 100)
    parts = [alignment.align(t, a, b) for _, t in alignment._rounds(list(range(len(texts))), texts)]
    assert len(parts) > 20
    assert [x for p, _ in parts for x in p["groups_sha256"]] == whole["groups_sha256"]
    merged = alignment._added([c for _, c in parts])
    assert sorted(zip(*merged.to_pydict().values(), strict=True)) == sorted(zip(*counted.to_pydict().values(), strict=True))
    monkeypatch.setattr(alignment, "ROW_PAIRS", 7)
    assert sum(len(p) for p in alignment._partial_rows(counted).column("pairs").to_pylist()) == len(counted)


def test_alignment_of_an_empty_table(spark):
    assert alignment.alignment(spark.createDataFrame([], SCHEMA), *paths()).count() == 0
