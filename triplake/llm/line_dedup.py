"""Operator 7, line de-duplication by winnowing over line hashes.

Lines with words are the units; positions count words. A gram is the shortest run of lines from a line on with at
least ``GRAM`` words, hashed from the line hashes. In every window (the shortest run of lines with at least ``RUN``
words) the gram with the smallest hash that starts in the first RUN - GRAM + 1 words is selected, so any two equal
windows select an equal gram: the guarantee of winnowing. Selected grams are joined with their positions: only windows
whose gram stands at two places or more go on.

A match of a gram is extended both ways to windows: the one from each line on, and the one back from each line, that
hold it. An extended match is known by the hash of its lines, so both places agree line by line, in one alignment, and
the first place (by document id, text hash, line) of each is found by one aggregation, never by pairs of a group. Any
repeated run of RUN words or more is the union of such windows; those at later places are joined to runs and deleted,
the first place stays. Nothing else is deleted: each deleted line lies in RUN words that stand elsewhere as they are.

All steps are DataFrame expressions, aggregations, joins and windows within one document. Hot grams are summed on the
map side, and the join back to the first place is one that Spark splits when it is skewed.

Lines are deleted whole: a passage that shares its first or last line with other words is deleted without that line.

Defined results: a null text stays null and an empty one empty; a document that loses all its lines keeps its row
with an empty text; lines without words are dropped only inside a deleted run; repeats within one document
count as later places; rows with equal id and equal text are one document and get the same result (an equal text
under another id is a copy); null ids come first in the order; other columns pass through whatever their
names; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WHITE, words, written

RUN = 50
GRAM = 25
_KEY = ["__id", "__th"]


def document_key(docs: DataFrame) -> DataFrame:
    """Adds the key of a document: its id (null: smallest) and the hash of its text."""
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-2 ** 63)),
                             "__th": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})


def line_table(docs: DataFrame) -> DataFrame:
    """One row for each line with words: key, position, hash, words, words of the document up to its end."""
    t = document_key(docs.select("doc_id", "text")).select(*_KEY, F.posexplode(F.split("text", "\n", -1)).alias(
        "pos", "line"))
    t = t.select(*_KEY, "pos", F.xxhash64(F.trim(F.translate("line", WHITE, " " * len(WHITE)))).alias("h"),
                 F.size(words(F.col("line"))).cast("long").alias("w")).where("w > 0")
    t = t.repartition(*_KEY).dropDuplicates([*_KEY, "pos"])
    by_line = Window.partitionBy(*_KEY).orderBy("pos")
    t = t.withColumn("pe", F.sum("w").over(by_line.rowsBetween(Window.unboundedPreceding, 0)))
    return t.withColumn("ps", F.col("pe") - F.col("w"))


def marks(lines: DataFrame, run: int, gram: int) -> DataFrame:
    """Windows of ``run`` words from each line on and back from each line: selected gram (gh, gpos), hash, lines [a, b]."""
    ahead, back = Window.partitionBy(*_KEY).orderBy("ps"), Window.partitionBy(*_KEY).orderBy("pe")
    near, whole, behind = ahead.rangeBetween(0, gram - 1), ahead.rangeBetween(0, run - 1), back.rangeBetween(1 - run, 0)
    t = lines.withColumns({
        "gh": F.when(F.sum("w").over(near) >= gram, F.xxhash64(F.collect_list("h").over(near))),
        "fh": F.when(F.sum("w").over(whole) >= run, F.xxhash64(F.collect_list("h").over(whole))),
        "fb": F.max("pos").over(whole)})
    best = F.min(F.struct("gh", F.col("pos").alias("gpos"))).over(ahead.rangeBetween(0, run - gram))
    t = t.withColumn("sel", F.when(F.col("fh").isNotNull(), best))
    # a window back from a line holds the one from its first line on, and is marked by that one's gram
    t = t.withColumns({
        "bh": F.when(F.sum("w").over(behind) >= run, F.xxhash64(F.collect_list("h").over(behind))),
        "ba": F.min("pos").over(behind), "bsel": F.first("sel").over(behind)})

    def mark(sel: str, h: str, a: str, b: str) -> Column:
        return F.when(F.col(h).isNotNull(), F.struct(
            F.col(sel)["gh"].alias("gh"), F.col(sel)["gpos"].alias("gpos"), F.col(h).alias("hash"),
            F.col(a).alias("a"), F.col(b).alias("b")))
    ahead_mark, back_mark = mark("sel", "fh", "pos", "fb"), mark("bsel", "bh", "ba", "pos")
    return t.select(*_KEY, F.explode(F.array_compact(F.array(ahead_mark, back_mark))).alias("m")).select(*_KEY, "m.*")


def repeated_runs(docs: DataFrame, run: int = RUN, gram: int = GRAM) -> DataFrame:
    """(__id, __th, runs): the line ranges [a, b] to delete from each document that has any."""
    m = written(marks(line_table(docs), run, gram), "marks")

    def places(rows: DataFrame, key: str, at: str) -> DataFrame:
        """The first place of each key that has several."""
        place = F.struct("__id", "__th", at)
        return rows.groupBy(key).agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
            F.col("first") < F.col("last")).drop("last")
    found = m.join(places(m, "gh", "gpos").select("gh"), "gh", "left_semi")
    seen = found.join(places(found, "hash", "a"), "hash").where(F.struct("__id", "__th", "a") > F.col("first"))
    order = Window.partitionBy(*_KEY).orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    seen = seen.withColumn("fresh", F.coalesce(F.col("a") > reach, F.lit(True)).cast("int"))
    seen = seen.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = seen.groupBy(*_KEY, "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return runs.groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("__runs"))


def dedup_lines(docs: DataFrame, run: int = RUN, gram: int = GRAM) -> DataFrame:
    """The columns of ``docs`` with the cleaned text, then n_lines, n_removed and removed ('a-b' line ranges)."""
    runs = repeated_runs(docs, run, gram)
    d = document_key(docs).join(runs, _KEY, "left")
    d = d.withColumn("__lines", F.when(F.col("__runs").isNotNull(), F.split("text", "\n", -1)))
    drop = F.flatten(F.transform("__runs", lambda r: F.sequence(r["a"], r["b"])))
    d = d.withColumn("__keep", F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), drop))
    kept = F.array_join(F.transform("__keep", lambda i: F.get("__lines", i)), "\n")
    return d.select(
        *[F.when(F.col("__runs").isNotNull(), kept).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c)
          for c in docs.columns],
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__lines") - F.size("__keep"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("__runs", lambda r: F.concat_ws("-", r["a"].cast("string"),
                                                                            r["b"].cast("string"))), ","),
                   F.lit("")).alias("removed"))
