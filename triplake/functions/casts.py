"""Safe casts and code normalisation.

Every cast goes through ``try_cast`` so malformed input becomes NULL instead of failing the
job under ANSI mode.  Integers go text -> double -> bigint, so '1.0' and 1.7 become 1
(truncation toward zero) and '1e30' or NaN become NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.schema import PAYMENT_TEXT_CODES, VENDOR_NAME_CODES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_EXACT_NUMERIC = _INTEGRAL + (T.DoubleType, T.DecimalType)


def safe_long(c, source: T.DataType | None = None) -> Column:
    """Any value -> bigint, truncating toward zero; NULL when malformed, NaN or out of range.

    With the source type known, numbers are cast directly (same result as the text route,
    without formatting and parsing every value); text and unknown types go text -> double.
    """
    col = _col(c)
    if isinstance(source, _INTEGRAL):
        return col.cast("bigint")
    if isinstance(source, (T.DoubleType, T.DecimalType)):
        return col.try_cast("bigint")
    return col.cast("string").try_cast("double").try_cast("bigint")


def safe_double(c, source: T.DataType | None = None) -> Column:
    """Any value -> double; NULL when malformed.  float32 keeps the text route (1.1f -> 1.1)."""
    col = _col(c)
    if isinstance(source, _EXACT_NUMERIC):
        return col.cast("double")
    return col.cast("string").try_cast("double")


def safe_cast(c, target: T.DataType | str) -> Column:
    """Any type -> target; NULL where the value does not parse."""
    t = T._parse_datatype_string(target) if isinstance(target, str) else target
    if isinstance(t, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return safe_long(c).try_cast(t)
    if isinstance(t, T.TimestampNTZType):
        return parse_timestamp(c)
    return _col(c).cast("string").try_cast(t)


def _code_map(text: Column, codes: dict[str, int]) -> Column:
    """CASE upper(text) WHEN k THEN v ... grouped by code value; NULL when nothing matches."""
    by_code: dict[int, list[str]] = {}
    for k, v in codes.items():
        by_code.setdefault(v, []).append(k)
    up = F.upper(text)
    out = None
    for v, keys in by_code.items():
        cond = up.isin(keys)
        out = F.when(cond, F.lit(v).cast("bigint")) if out is None else out.when(cond, F.lit(v).cast("bigint"))
    return out


def payment_code(c, source: T.DataType | None = None) -> Column:
    """P9: 'CAS'/'Cash' -> 2, 'CRD'/'Credit' -> 1, 'NOC'/'No Charge' -> 3, 'DIS'/'Dispute' -> 4, else numeric."""
    if isinstance(source, _EXACT_NUMERIC):
        return safe_long(c, source)                     # a numeric column holds no text codes
    text = _col(c).cast("string")
    return F.coalesce(_code_map(text, PAYMENT_TEXT_CODES), safe_long(text))


def vendor_code(c, source: T.DataType | None = None) -> Column:
    """P4: 'CMT' -> 1, 'VTS' -> 2, else the numeric value (NULL if text)."""
    if isinstance(source, _EXACT_NUMERIC):
        return safe_long(c, source)
    text = _col(c).cast("string")
    return F.coalesce(_code_map(text, VENDOR_NAME_CODES), safe_long(text))


def parse_timestamp(c, source: T.DataType | None = None) -> Column:
    """Timestamp (wall clock, no zone) from timestamp or text; NULL if unparsable."""
    col = _col(c)
    if isinstance(source, T.TimestampNTZType):
        return col
    if isinstance(source, (T.TimestampType, T.DateType)):
        return col.cast("timestamp_ntz")                # session time zone is UTC
    return F.coalesce(col.try_cast("timestamp_ntz"),
                      F.try_to_timestamp(col.cast("string")).try_cast("timestamp_ntz"))
