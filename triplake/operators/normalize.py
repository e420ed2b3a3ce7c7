"""Bring one raw file's columns to the canonical staging schema.

Pure column expressions in one ``select``: no shuffle, stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.functions.casts import parse_timestamp, payment_code, safe_double, safe_long, vendor_code
from triplake.schema import ALIASES, CANONICAL, FHV_DROPOFF_SENTINEL


def lower_names(df: DataFrame) -> DataFrame:
    """P1 for every format (the reference skipped green; lower-casing it is the documented intent)."""
    return df.toDF(*[c.lower() for c in df.columns])


def resolve_aliases(columns: list[str]) -> dict[str, str]:
    """Canonical name -> source column, renaming a legacy name only when the target is absent."""
    present = {c: c for c in columns}
    for old, new in ALIASES:
        if old in present and new not in present:
            present[new] = present.pop(old)
    return present


def _typed(src: Column, name: str, dtype: T.DataType, source: T.DataType | None) -> Column:
    """Cast to the canonical type; the source type (known per schema fingerprint) picks the cheapest exact route."""
    if name == "payment_type":
        return payment_code(src, source)
    if name == "vendorid":
        return vendor_code(src, source)
    if isinstance(dtype, T.LongType):
        return safe_long(src, source)
    if isinstance(dtype, T.DoubleType):
        return safe_double(src, source)
    if isinstance(dtype, T.TimestampNTZType):
        return parse_timestamp(src, source)
    return src if source == dtype else src.cast(dtype)


def canonical_columns(df: DataFrame, fmt: str) -> list[Column]:
    schema = CANONICAL[fmt]
    src = resolve_aliases(df.columns)
    if "vendorid" in schema.fieldNames() and "vendorid" not in src:
        for legacy in ("vendor_name", "vendor_id"):       # P4 / Q2: text map for either name
            if legacy in src:
                src["vendorid"] = src[legacy]
                break
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name in src:
            c = _typed(F.col(src[f.name]), f.name, f.dataType, types.get(src[f.name]))
        else:
            c = F.lit(None).cast(f.dataType)               # P6/P7/P16/Q12: create when absent
        if fmt == "fhv" and f.name == "dropoff_datetime":  # P12: sentinel means "not reported"
            c = F.nullif(c, F.lit(FHV_DROPOFF_SENTINEL).cast("timestamp_ntz"))
        out.append(c.alias(f.name))
    return out


def normalize(df: DataFrame, fmt: str, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Canonical columns of ``fmt`` (unknown source columns dropped, Q3) plus the ``keep`` columns."""
    low = lower_names(df)
    names = set(CANONICAL[fmt].fieldNames())
    kept = [F.col(k.lower()).alias(k) for k in keep if k.lower() in low.columns and k not in names]
    return low.select(*canonical_columns(low, fmt), *kept)
