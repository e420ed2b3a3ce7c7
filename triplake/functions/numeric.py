"""Rounding and ratio helpers shared by marts and measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


WHOLE_CENTS = 2.0 ** 52 / 100   # NaN compares as the largest value, so it is beyond this too


def round2(c) -> Column:
    """Round to 2 decimals, halves away from zero (as SQL ROUND does), on the double value.

    Written as integer arithmetic on |x|*100 instead of ``F.round`` so every engine returns
    the same IEEE double (``round`` on doubles breaks ties differently across engines), and
    no negative zero appears.  NaN, infinities and values from ``WHOLE_CENTS`` on, whose hundredfold has no
    fraction, come back unchanged: the integer would clip them.
    """
    x = _col(c).cast("double")
    cents = F.when(x < 0, -F.floor(-x * F.lit(100.0) + F.lit(0.5))).otherwise(F.floor(x * F.lit(100.0) + F.lit(0.5)))
    return F.when(F.abs(x) >= F.lit(WHOLE_CENTS), x).otherwise((cents / F.lit(100.0)).cast("double"))


def ratio(num, den, scale: float = 1.0) -> Column:
    """scale * num / NULLIF(den, 0) in double; NULL instead of a division-by-zero error."""
    n = _col(num).cast("double")
    d = F.nullif(_col(den).cast("double"), F.lit(0.0))
    return (F.lit(float(scale)) * n / d) if scale != 1.0 else n / d


EXACT = "decimal(22,6)"   # exact for amounts and distances with up to 6 decimals


def exact(c) -> Column:
    """The value as a decimal: sums do not depend on their order; NaN and values beyond it become NULL."""
    return _col(c).try_cast(EXACT)


def mean(c) -> Column:
    """AVG as SUM/COUNT of the values that are summed, as a double.

    Summing decimals first keeps the result independent of order and lets the same (sum, count)
    pair be stored and merged later (monthly state of the annual marts).
    """
    col = exact(c)
    return F.sum(col).cast("double") / F.nullif(F.count(col), F.lit(0))


def nz_sum(c) -> Column:
    """SUM as double (NULL when every input is NULL)."""
    return F.sum(exact(c)).cast("double")


def mean_exact(c, dtype: str = "decimal(18,2)") -> Column:
    """Mean of values that already have a fixed number of decimals (e.g. rounded mart values).

    Sums in ``dtype`` so the result does not depend on summation order.
    """
    col = _col(c)
    return F.sum(col.cast(dtype)).cast("double") / F.nullif(F.count(col), F.lit(0))
