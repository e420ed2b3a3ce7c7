"""Operator 4, benchmark decontamination by templates.

Canonicalisation turns numbers, units behind numbers and names into typed placeholders that keep their value beside
the type; other words are lower-cased and lose punctuation. A name is any capitalised word, whatever stands before it;
windows with names are also probed with the names as ordinary words, and items also with names only inside sentences,
so that a first word in lower case and a copy all in lower case are found. Windows of ``WINDOW``
placeholder-typed words are hashed and hash-joined with the windows of the benchmark. Benchmark items with the same
template and the same pattern of equal slots form one class, so re-parameterised copies of a question are one join
partner. For each document, class and alignment, slot consistency is checked: slots that are equal in the item
must have one value in the document, and windows that hold a slot with several values do not count. A document is
contaminated by a class if the windows left cover ``COVER`` of the item's, or if one alignment has ``RUN``
consecutive tokens of it.

The benchmark side is written first, so that its size is known: while it is below Spark's broadcast threshold
the windows of the documents are probed where they are read, without a shuffle; above it Spark joins by a
shuffle of both sides. Only matching windows are aggregated.

Items shorter than a window are one window of their own length, and items shorter than two also have windows of half
their length (``LEAST`` tokens or more), which count by the share of tokens they cover; documents have windows of
each length that occurs. Windows of placeholders alone match by their values.

Defined results: null or empty texts match nothing; items without words match nothing; null item ids are reported as 'null'; rows with equal id and text get the
same result; extra columns are ignored; an empty documents or benchmark table gives no contamination.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, written
from .line_dedup import document_key

WINDOW = 8
COVER = 0.5
LEAST = 6                        # tokens of the shortest window of an item of eight tokens or more
RUN = 14                         # 13 tokens may lie between two slots that differ (tests)
# placeholder types, put before the value of a slot
NUMBER, UNIT, NAME = "\x01", "\x02", "\x03"
UNITS = ("km|kg|cm|mm|mg|ml|kb|mb|gb|tb|kwh|mph|kmh|m|g|l|s|h|ft|lb|lbs|oz|hz|khz|mhz|ghz|usd|eur|gbp|dollars?|euros?|"
         "cents?|percent|%|miles?|meters?|metres?|kilometers?|grams?|kilograms?|liters?|litres?|seconds?|minutes?|"
         "hours?|days?|weeks?|months?|years?|degrees?")


def template_tokens(text: Column, inside: bool = False) -> Column:
    """Tokens of a text: words, or a type character followed by the value of the slot. Any capitalised word is a name,
    or with ``inside`` only one behind a lower-case letter or , ; : and a space."""
    t = F.translate(F.coalesce(text, F.lit("")), WHITE + NUMBER + UNIT + NAME, " " * (len(WHITE) + 3))
    numbers = F.regexp_replace(t, r"(?<![\p{L}\p{N}.,])[0-9][0-9.,:/]*", NUMBER + "$0")
    units = F.regexp_replace(numbers, rf"(?i)({NUMBER}[0-9.,:/]+ ?)({UNITS})(?![\p{{L}}\p{{N}}])", rf"$1 {UNIT}$2 ")
    t = F.when(t.rlike("[0-9]"), units).otherwise(t)
    before = r"(?<=[\p{Ll},;:] \p{Lu})" if inside else r"(?<![\p{L}\p{N}]\p{Lu})(?<![\p{L}\p{N}]['’-]\p{Lu})"
    t = F.regexp_replace(t, rf"(\p{{Lu}}){before}(?=['’]?\p{{L}}?\p{{Ll}})", NAME + "$1")
    t = F.regexp_replace(F.lower(t), rf"[^\p{{L}}\p{{N}}{NUMBER}-{NAME} ]+", "")
    return F.array_remove(F.array_remove(F.split(t, " ", -1), ""), NUMBER)


def _is_slot(token: Column) -> Column:
    return token < F.lit("\x04")


def _steps(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """How the hashes of windows of each length come from shorter ones: length to (half, shift of the second half)."""
    steps = {}
    for k in sorted(lengths, reverse=True):
        while k > 1 and k not in steps:
            half = 1 << (k - 1).bit_length() - 1
            steps[k] = half, k - half
            k = half
    return dict(sorted(steps.items()))


def _probes(df: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """``keep`` columns, n (tokens) and the window hashes (at, wh) of column __tok, one row each: first all windows with
    typed names, then all with names as ordinary words, for each length in order. Windows of k tokens are hashed from
    two overlapping windows of a power of two."""
    df = df.withColumn("__h1", F.transform("__tok", lambda t: F.xxhash64(
        F.when(_is_slot(t), F.substring(t, 1, 1)).otherwise(t))))
    df = df.withColumn("__p1", F.transform("__tok", lambda t, i: F.when(t.contains(NAME), F.xxhash64(
        F.translate(t, NAME, ""))).otherwise(F.get("__h1", i))))
    df = df.withColumn("n", F.size("__h1"))
    for k, (half, shift) in _steps(lengths).items():
        size = F.greatest(F.col("n") - k + 1, F.lit(0))
        df = df.withColumns({f"__{f}{k}": F.zip_with(
            F.slice(f"__{f}{half}", F.lit(1), size), F.slice(f"__{f}{half}", F.lit(shift + 1), size),
            lambda x, y: F.xxhash64(x, y)) for f in "hp"})
    return df.select(*keep, "n", F.posexplode(F.concat(*[f"__{f}{k}" for f in "hp" for k in lengths])).alias("at", "wh"))


def _placed(probes: DataFrame, lengths: list[int]) -> DataFrame:
    """``probes`` with pos, len and plain (names are ordinary words) instead of n and at."""
    sizes = {k: F.greatest(F.col("n") - k + 1, F.lit(0)) for k in lengths}
    typed = reduce(add, sizes.values())
    left = F.when(F.col("at") >= typed, F.col("at") - typed).otherwise(F.col("at"))
    place, before = F.lit(None), F.lit(0)
    for k, size in reversed(sizes.items()):              # the first length whose windows reach beyond ``left``
        before = reduce(add, [sizes[j] for j in lengths[:lengths.index(k)]], F.lit(0))
        here = F.struct((F.col("__left") - before).alias("pos"), F.lit(k).alias("len"))
        place = F.when(F.col("__left") < before + size, here).otherwise(place)
    df = probes.withColumns({"__left": left, "plain": F.col("at") >= typed}).withColumn("__place", place)
    return df.select(*[c for c in probes.columns if c not in ("n", "at")], "plain", "__place.pos", "__place.len")


def _slots(tok: Column, pos: Column, size: Column, plain: Column) -> Column:
    """The slots of a window of ``tok``; a plain one has no names."""
    return F.filter(F.slice(tok, pos + 1, size), lambda t: _is_slot(t) & (~plain | (t < F.lit(NAME))))


def _lengths(n: Column) -> Column:
    """Lengths of the windows of an item of n tokens."""
    return F.when(n < WINDOW, F.array(n)).when(n < 2 * WINDOW, F.array(
        F.lit(WINDOW), F.greatest(F.lit(LEAST), F.floor(n / 2).cast("int")))).otherwise(F.array(F.lit(WINDOW)))


def benchmark_classes(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class, items) and (wh, class, bpos, len, ids, n, total): classes of items and the windows of their items."""
    b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                         template_tokens(F.col("text")).alias("__tok"),
                         template_tokens(F.col("text"), True).alias("__in")).where(F.size("__tok") > 0)
    # a slot's identity inside its item: its type and the place of its first occurrence
    b = b.withColumn("__ids", F.transform("__tok", lambda t: F.when(_is_slot(t), F.concat(
        F.substring(t, 1, 1), F.array_position("__tok", t).cast("string"))).otherwise(t)))
    template = F.when(F.forall("__tok", _is_slot), F.col("__tok")).otherwise(F.col("__ids"))
    b = b.withColumn("class", F.xxhash64(F.array_join(template, " ")))
    classes = b.groupBy("class").agg(F.array_sort(F.collect_set("item")).alias("items"))
    b = b.withColumn("n", F.size("__tok")).withColumn("own", _lengths(F.col("n")))
    # a second form of each item: names inside sentences only, as in a copy whose first word is not capitalised
    inside = b.withColumns({"__tok": F.col("__in"), "__ids": F.zip_with("__in", "__ids", lambda t, i: F.when(
        _is_slot(t), i).otherwise(t))})
    both = b.unionByName(inside)
    every = list(range(1, WINDOW + 1))
    windows = _placed(_probes(both.drop("n"), every, "class", "own", "__tok", "__ids"), every).where(
        F.array_contains("own", F.col("len"))).withColumn("n", F.size("__tok"))
    place = (F.col("pos"), F.col("len"), F.col("plain"))
    values = _slots(F.col("__tok"), *place)
    windows = windows.select("wh", "class", F.col("pos").alias("bpos"), "len", _slots(
        F.col("__ids"), *place).alias("ids"), F.when(F.size(values) == F.col("len"), values).alias("values"), "n",
        (F.col("n") - WINDOW + 1).alias("total"))
    return classes, windows.distinct()


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(__id, __th, items): contaminated documents by key, with the items found."""
    classes, windows = benchmark_classes(benchmark)
    classes, windows = written(classes, "classes"), written(windows, "windows")
    keys = written(windows.select("wh").distinct(), "hashes")
    lengths = sorted({r["len"] for r in windows.select("len").distinct().collect()} | {WINDOW})   # at most eight
    d = document_key(docs.select("doc_id", "text")).select(
        "__id", F.col("__th").alias("__key"), template_tokens(F.col("text")).alias("__tok"))
    hit = _placed(_probes(d, lengths, "__id", "__key").join(keys, "wh", "left_semi"), lengths)
    hit = written(hit, "hits").groupBy("__id", "__key").agg(
        F.collect_set(F.struct("pos", "len", "wh", "plain")).alias("__hits"))
    # slots are taken from the documents with hits only
    texts = document_key(docs.select("doc_id", "text")).withColumnRenamed("__th", "__key").join(hit, ["__id", "__key"])
    texts = texts.withColumn("__tok", template_tokens(F.col("text")))
    hit = texts.select("__id", "__key", F.explode(F.transform("__hits", lambda h: F.struct(
        h["pos"].alias("pos"), h["len"].alias("len"), h["wh"].alias("wh"),
        _slots(F.col("__tok"), h["pos"], h["len"], h["plain"]).alias("slots")))).alias("__h"))
    hit = hit.select("__id", "__key", "__h.*").join(windows, ["wh", "len"])
    # a window of slots alone matches by their values
    hit = hit.where(F.col("values").isNull() | (F.col("values") == F.col("slots")))
    pairs = F.arrays_zip(F.col("ids").alias("i"), F.col("slots").alias("v"))
    key = ["__id", "__key", "class", "len", "n", "total"]
    aligned = hit.select(*key, "bpos", (F.col("pos") - F.col("bpos")).alias("shift"), pairs.alias("pairs"))
    # bounded by the windows of one item
    by_shift = aligned.groupBy(*key, "shift").agg(F.collect_set(F.struct("bpos", "pairs")).alias("at"))
    seen = F.array_distinct(F.flatten(F.col("at")["pairs"]))
    by_shift = by_shift.withColumn("bad", F.filter(seen, lambda p: F.exists(
        seen, lambda q: (q["i"] == p["i"]) & (q["v"] != p["v"])))["i"])
    by_shift = by_shift.withColumn("at", F.array_sort(F.array_distinct(F.filter("at", lambda w: ~F.arrays_overlap(
        w["pairs"]["i"], F.col("bad")))["bpos"])))
    more = RUN - WINDOW                                  # windows after the first one of a run
    run = (F.size("at") > more) & F.exists(F.sequence(F.lit(0), F.greatest(F.size("at") - 1, F.lit(0))),
                                           lambda i: F.get("at", i + more) - F.get("at", i) == more)
    cover = by_shift.groupBy(*key).agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("all"),
                                       F.max(F.coalesce(run, F.lit(False))).alias("run"))
    tokens = F.size(F.array_distinct(F.flatten(F.transform("all", lambda p: F.sequence(p, p + F.col("len") - 1)))))
    whole = F.when(F.col("len") == WINDOW, (F.size("all") >= COVER * F.col("total")) | F.col("run")).otherwise(
        tokens >= COVER * F.col("n"))
    found = cover.where(whole).select("__id", "__key", "class").distinct().join(classes, "class")
    return found.groupBy("__id", F.col("__key").alias("__th")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("__items"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the contaminated ones."""
    found = written(matches(docs, benchmark), "leaks")
    return document_key(docs).join(found, ["__id", "__th"], "left_anti").select(*docs.columns)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, items (ids joined by comma) of every row."""
    found = written(matches(docs, benchmark), "leaks")
    d = document_key(docs.select("doc_id", "text")).drop("text").join(found, ["__id", "__th"], "left")
    return d.select("doc_id", F.col("__items").isNotNull().alias("contaminated"),
                    F.coalesce(F.size("__items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce(F.array_join("__items", ","), F.lit("")).alias("items"))
