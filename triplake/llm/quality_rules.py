"""Operator 1, quality rules: plain rules, then robust multivariate outliers per language and source.

Every document gets a vector of transformed statistics. For each (language, source) a minimum-covariance-
determinant estimate of centre and scatter is fitted by C-steps: order the documents of the group by
Mahalanobis distance, keep the closest share ``SUPPORT``, re-estimate centre and covariance from those, repeat.
Three deterministic starts race for ``RACE_STEPS`` steps, all in the same aggregations; in each group the one whose
covariance has the least determinant goes on to ``C_STEPS``. A reweighting step follows, and a document is rejected when its squared distance exceeds the chi-square
quantile at ``TAIL``. All work is DataFrame aggregation over one small statistics table: moments and quantile
sketches are pre-aggregated on the map side, so a source with a third of all rows ships one partial row per task.
Estimates are joined on (group, salt), each repeated for every salt: where Spark shuffles that join instead of
broadcasting the estimates, a hot group is spread over ``SALTS`` keys and its aggregates still combine map-side.

Defined results
* null text: no words, base_failed. Documents that fail a base rule take no part in the fit.
* groups below ``MIN_ROWS`` documents are pooled per language, then over all; a pool that is still too small
  gives no verdict (distance2 null, kept unless base_failed).
* null language or source is a group value of its own. Equal rows are rated equally, ids are not used as keys.
* extra columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, words, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
SPAN = 5                 # words of a repetition window
MIN_ROWS = 200           # documents a group needs for an estimate of its own
SUPPORT = 0.75           # share of a group that the C-steps keep
C_STEPS = 5
RACE_STEPS = 2           # C-steps that every start takes before the least determinant decides which one goes on
START_FLOOR = 0.01       # added to the diagonal of a start's scaled scatter
SALTS = 64               # keys that the rows of one group are spread over when they meet its estimate
SKETCH = 2000            # accuracy of the per-group distance quantiles
TAIL_Z = 5.0             # normal quantile of the rejection cutoff (about 3e-7 of a normal group lies beyond)
REWEIGHT_Z = 1.959964    # normal quantile 0.975
# Smallest standard deviation assumed along each statistic: keeps the estimate regular where more than SUPPORT of a
# group have the same value (no symbols, no repeated lines), and says which difference is worth noting at all.
FLOOR = {"x_len": 0.06, "x_sym": 0.04, "x_upper": 0.04, "x_dup": 0.2, "x_rep": 0.15, "x_uniq": 0.05}
STATS = list(FLOOR)
# Words of typical text (letters, capitals, different words a word) that are added to every document before its
# statistics are taken, so that a few words of a short text do not make an outlier.
PRIOR_WORDS, PRIOR_CHARS, PRIOR_UPPER = 30, 5.0, 0.08
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def document_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns plus the base counts and the transformed statistics, computed row by row."""
    t = F.coalesce(F.col("__t"), F.lit(""))
    d = docs.select(*keep, F.col("text").alias("__t"))
    d = d.withColumn("__w", words(F.col("__t")))
    d = d.withColumn("__wh", F.transform("__w", lambda w: F.xxhash64(w)))
    n = F.size("__w")
    d = d.withColumn("__h", F.when(n >= SPAN, F.transform(
        F.sequence(F.lit(1), n - (SPAN - 1)),
        lambda i: F.xxhash64(*[F.get("__wh", i + (k - 1)) for k in range(SPAN)]))))
    repeated = F.size(F.array_distinct("__h")) < F.size("__h")
    # windows found twice or more: sort (hash, position), keep those equal to a neighbour
    d = d.withColumn("__s", F.when(repeated, F.array_sort(F.transform(
        "__h", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    d = d.withColumn("__p", F.array_sort(F.transform(F.filter("__s", lambda e, i: F.coalesce(
        (F.get("__s", i - 1)["h"] == e["h"]), F.lit(False)) | F.coalesce(
        (F.get("__s", i + 1)["h"] == e["h"]), F.lit(False))), lambda e: e["p"])))
    covered = F.aggregate(
        F.transform("__p", lambda p, i: F.least(F.lit(SPAN), F.coalesce(F.get("__p", i + 1) - p, F.lit(SPAN)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    d = d.withColumn("__l", F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, WHITE, "")) > 0))
    d = d.withColumn("n_words", n.cast("long"))
    d = d.withColumn("word_chars", F.length(F.translate(t, WHITE, "")).cast("long"))
    d = d.withColumn("n_symbols", _count(t, SYMBOLS))
    d = d.withColumn("n_dup_lines", (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"))
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    d = d.withColumn("__upper", _count(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    d = d.withColumn("__uniq", F.size(F.array_distinct("__wh")))
    d = d.withColumn("__nl", F.size("__l"))

    def share(a: Column, b: Column) -> Column:           # variance-stabilised share
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.coalesce(F.try_divide(a, b), F.lit(0.0)))))

    nw = F.greatest(F.col("n_words"), F.lit(1))
    more, chars = F.col("n_words") + PRIOR_WORDS, F.col("word_chars") + PRIOR_WORDS * PRIOR_CHARS
    return d.select(
        *keep, *BASE,
        F.log(chars / more).alias("x_len"),
        share(F.col("n_symbols"), chars).alias("x_sym"),
        share(F.col("__upper") + PRIOR_WORDS * PRIOR_UPPER, chars).alias("x_upper"),
        share(F.col("n_dup_lines"), F.col("__nl")).alias("x_dup"),
        share(F.col("n_repeat_words"), nw).alias("x_rep"),
        # different words against the length of the text (a constant slope of Heaps' law)
        (F.log(F.col("__uniq") + F.lit(0.9 * PRIOR_WORDS)) - 0.9 * F.log(more)).alias("x_uniq"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def chi2_quantile(d: int, z: float) -> float:
    """Wilson-Hilferty approximation of the chi-square quantile whose normal quantile is z."""
    return d * (1 - 2 / (9 * d) + z * (2 / (9 * d)) ** 0.5) ** 3


def _groups(s: DataFrame) -> DataFrame:
    """Adds ``g``: the (language, source) group, or the pool a small group falls into, or null."""
    def part(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    s = s.withColumn("__g1", F.concat_ws("\x1f", part("lang"), part("source")))
    fit = s.where(~F.col("base_failed"))
    sizes = fit.groupBy("__g1", F.col("lang").alias("__lang")).count()
    sizes = sizes.withColumn("__g2", F.when(F.col("count") >= MIN_ROWS, F.col("__g1")).otherwise(
        F.coalesce(F.concat(F.lit("="), F.col("__lang")), F.lit("-"))))
    pool = sizes.groupBy("__g2").agg(F.sum("count").alias("__n2"))
    sizes = sizes.join(pool, "__g2").withColumn("__g3", F.when(F.col("__n2") >= MIN_ROWS, F.col("__g2")).otherwise(
        F.lit("*")))
    last = sizes.groupBy("__g3").agg(F.sum("count").alias("__n3"))
    sizes = sizes.join(last, "__g3").select(
        F.col("__g1"), F.when(F.col("__n3") >= MIN_ROWS, F.col("__g3")).alias("g"))
    return s.join(_for_salts(sizes, "groups"), ["__g1", "__salt"], "left").drop("__g1")


def _for_salts(small: DataFrame, name: str) -> DataFrame:
    """A table of one row a group, written with that row for every salt (its written size decides on broadcasting)."""
    return written(small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), name)


def _moments(rows: DataFrame, *by: str) -> DataFrame:
    """Per group: mean and inverse Cholesky factor of the covariance of the statistics (regularised)."""
    d, by = len(STATS), by or ("g",)
    # second moments around zero; statistics are of order one, so doubles hold them well
    sums = [F.avg(c).alias(f"m{i}") for i, c in enumerate(STATS)]
    prods = [F.avg(F.col(STATS[i]) * F.col(STATS[j])).alias(f"q{i}_{j}") for i in range(d) for j in range(i + 1)]
    p = rows.groupBy(*by).agg(*sums, *prods)
    p = p.select(*by, *[f"m{i}" for i in range(d)], *[
        (F.col(f"q{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}")
         + (F.lit(FLOOR[STATS[i]] ** 2) if i == j else F.lit(0.0))).alias(f"c{i}_{j}")
        for i in range(d) for j in range(i + 1)])
    return _inverse_factor(p).select(*by, *[f"m{i}" for i in range(d)], *_FACTOR, F.lit(1.0).alias("scale"))


_FACTOR = [f"w{i}_{j}" for i in range(len(STATS)) for j in range(i + 1)]


def _inverse_factor(p: DataFrame) -> DataFrame:
    """Adds the inverse (w) of the Cholesky factor (l) of the matrix (c)."""
    d = len(STATS)
    for j in range(d):
        diag = F.sqrt(F.greatest(F.lit(1e-12), reduce(
            lambda a, k: a - F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}"), range(j), F.col(f"c{j}_{j}"))))
        p = p.withColumn(f"l{j}_{j}", diag)
        p = p.withColumns({f"l{i}_{j}": reduce(
            lambda a, k, i=i: a - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}"), range(j),
            F.col(f"c{i}_{j}")) / F.col(f"l{j}_{j}") for i in range(j + 1, d)}) if j + 1 < d else p
    for i in range(d):                                   # forward substitution against the identity
        p = p.withColumns({f"w{i}_{j}": (1 / F.col(f"l{i}_{i}")) if i == j else -reduce(add, [
            F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)]) / F.col(f"l{i}_{i}")
            for j in range(i + 1)})
    return p


def _starts(rows: DataFrame) -> DataFrame:
    """Per group three deterministic starts of the C-steps, all around the coordinate-wise medians: with the
    interquartile scales alone, with the correlation of tanh of the scaled statistics, with their spatial signs."""
    d = len(STATS)
    p = rows.groupBy("g").agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], SKETCH).alias(f"p{i}")
                                for i, c in enumerate(STATS)])
    means = [f"m{i}" for i in range(d)]
    cols = []
    for i, c in enumerate(STATS):
        iqr = (F.get(f"p{i}", F.lit(2)) - F.get(f"p{i}", F.lit(0))) / 1.349
        cols += [F.get(f"p{i}", F.lit(1)).alias(means[i]), (1 / F.sqrt(iqr * iqr + FLOOR[c] ** 2)).alias(f"v{i}")]
    p = _for_salts(p.select("g", *cols), "scales")
    z = rows.join(p, ["g", "__salt"]).select("g", *[((F.col(c) - F.col(means[i])) * F.col(f"v{i}")).alias(f"z{i}")
                                                   for i, c in enumerate(STATS)])
    z = z.withColumn("__len", F.greatest(F.lit(1e-9), F.sqrt(reduce(add, [F.col(f"z{i}") ** 2 for i in range(d)]))))
    z = z.withColumns({f"t{i}": F.tanh(f"z{i}") for i in range(d)} | {f"u{i}": F.col(f"z{i}") / F.col("__len")
                                                                      for i in range(d)})
    s = z.groupBy("g").agg(*[F.avg(f"t{i}").alias(f"a{i}") for i in range(d)], *[
        F.avg(F.col(f"{k}{i}") * F.col(f"{k}{j}")).alias(f"{k}{i}_{j}")
        for k in ("t", "u") for i in range(d) for j in range(i + 1)])

    def matrix(start: int, cell) -> DataFrame:
        part = s.select("g", *[(cell(i, j) + F.lit(START_FLOOR if i == j else 0.0)).alias(f"c{i}_{j}")
                               for i in range(d) for j in range(i + 1)])
        return _inverse_factor(part).select("g", F.lit(start).alias("start"), *_FACTOR)

    def spread(i: int, j: int) -> Column:
        return F.col(f"t{i}_{j}") - F.col(f"a{i}") * F.col(f"a{j}")

    def correlation(i: int, j: int) -> Column:
        return spread(i, j) / F.sqrt((spread(i, i) + START_FLOOR) * (spread(j, j) + START_FLOOR))

    shapes = [s.select("g", F.lit(0).alias("start"), *[F.lit(float(i == j)).alias(f"w{i}_{j}")
                                                       for i in range(d) for j in range(i + 1)]),
              matrix(1, correlation), matrix(2, lambda i, j: F.col(f"u{i}_{j}"))]
    scales = p.where(F.col("__salt") == 0).drop("__salt")
    return reduce(DataFrame.unionByName, shapes).join(scales, "g").select(
        "g", "start", *means, *[(F.col(f"w{i}_{j}") * F.col(f"v{j}")).alias(f"w{i}_{j}")
                                for i in range(d) for j in range(i + 1)], F.lit(1.0).alias("scale"))


def _least_determinant(params: DataFrame) -> DataFrame:
    """The start of each group whose covariance has the least determinant (ties: the first)."""
    p = params.where(F.col("__salt") == 0).drop("__salt")
    log_det = -2 * reduce(add, [F.log(F.col(f"w{i}_{i}")) for i in range(len(STATS))])
    rest = [c for c in p.columns if c not in ("g", "start")]
    best = p.groupBy("g").agg(F.min(F.struct(log_det.alias("log_det"), "start", *rest)).alias("b"))
    return best.select("g", "b.start", *[f"b.{c}" for c in rest])


def _distance(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance under the group's estimate (null without one); joins on (g, salt)."""
    d = len(STATS)
    z = [reduce(add, [F.col(f"w{i}_{j}") * (F.col(STATS[j]) - F.col(f"m{j}")) for j in range(i + 1)])
         for i in range(d)]
    keep = rows.columns + ["start"] * ("start" in params.columns)
    return rows.join(params, ["g", "__salt"], "left").select(*keep, (reduce(add, [x * x for x in z]) / F.col("scale")).alias("d2"))


def _rescaled(rows: DataFrame, params: DataFrame) -> DataFrame:
    """``params`` with a scale that puts the group's median distance at the chi-square median (never enlarging it:
    floored statistics make the median small)."""
    med = _distance(rows, params).groupBy("g").agg(F.percentile_approx("d2", 0.5, SKETCH).alias("__med"))
    return params.where(F.col("__salt") == 0).drop("__salt").join(med, "g").withColumn("scale", F.greatest(F.lit(1.0), F.coalesce(
        F.col("__med"), F.lit(1.0)) / chi2_quantile(len(STATS), 0.0))).drop("__med")


def fit(rows: DataFrame) -> DataFrame:
    """The estimate of every group of ``rows`` (columns g, salt and the statistics): a small row per group and salt."""
    rows = rows.where(F.col("g").isNotNull()).select("g", "__salt", *STATS)
    params = _for_salts(_starts(rows), "mcd")
    for step in range(C_STEPS):
        if step == RACE_STEPS:
            params = _for_salts(_least_determinant(params), "mcd")
        far = _distance(rows, params)
        near = _for_salts(far.groupBy("g", "start").agg(F.percentile_approx("d2", SUPPORT, SKETCH).alias("__h")), "mcd")
        half = far.join(near, ["g", "start", "__salt"]).where(F.col("d2") <= F.col("__h"))
        params = _for_salts(_moments(half, "g", "start"), "mcd")
    params = _for_salts(_rescaled(rows, params.drop("start")), "mcd")
    inner = _distance(rows, params).where(F.col("d2") <= chi2_quantile(len(STATS), REWEIGHT_Z))
    params = _for_salts(_moments(inner), "mcd")
    return _for_salts(_rescaled(rows, params), "mcd")


def rate(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, base counts, base_failed, distance2 and kept for every row of ``docs``."""
    s = document_statistics(docs.select(*dict.fromkeys((*keep, "lang", "source")), "text"),
                            *dict.fromkeys((*keep, "lang", "source")))
    # the salt is the row's place in its task's output, written with the row: equal rows are spread too
    s = s.withColumns({"base_failed": base_failed(), "__salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")})
    s = written(s, "stats")
    s = written(_groups(s), "grouped")
    params = fit(s.where(~F.col("base_failed")))
    out = _distance(s, params)
    cutoff = chi2_quantile(len(STATS), TAIL_Z)
    return out.select(*keep, *BASE, "base_failed", F.when(~F.col("base_failed"), F.col("d2")).alias("distance2"),
                      (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"))
