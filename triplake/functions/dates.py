"""Date parts used by the marts (P14, P20, weekday/hour functions) and pushdown-friendly ranges."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_weekday(c) -> Column:
    """Monday = 1 ... Sunday = 7 (``dayofweek`` would give Sunday = 1)."""
    return (F.weekday(_col(c)) + 1).cast("bigint")


def weekday_name(c) -> Column:
    """Full English weekday name, e.g. 'Monday'."""
    return F.date_format(_col(c), "EEEE")


def trip_minutes(pickup, dropoff) -> Column:
    """Whole seconds between the two timestamps, in minutes (double)."""
    return F.timestamp_diff("SECOND", _col(pickup), _col(dropoff)).cast("double") / F.lit(60.0)


def anio_of(c) -> Column:
    return F.year(_col(c)).cast("string")


def mes_of(c) -> Column:
    return F.lpad(F.month(_col(c)).cast("string"), 2, "0")


def year_range_predicate(c, first_year: int, last_year: int) -> Column:
    """``year(c) BETWEEN first AND last`` written as a timestamp range so Parquet can push both bounds."""
    lo = _dt.datetime(first_year, 1, 1)
    hi = _dt.datetime(last_year + 1, 1, 1)
    col = _col(c)
    return (col >= F.lit(lo).cast("timestamp_ntz")) & (col < F.lit(hi).cast("timestamp_ntz"))
