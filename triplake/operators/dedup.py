"""Deterministic de-duplication on the natural trip key.

``groupBy(key + scope).agg(min(struct(order..., rest...)))`` keeps, per key, the smallest row
by ``order_by`` (then by every other column), so reruns pick the same survivor.  Unlike
``row_number()`` over a window, the aggregate is combined map-side: a key holding a third
of all rows ships one row per map task, not the whole group to one task.  NULL key values
group together, as ``dropDuplicates`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.schema import DEDUP_KEYS

_ROW = "_survivor"


def key_columns(df: DataFrame, fmt: str) -> list[str] | None:
    keys, minimum = DEDUP_KEYS[fmt]
    present = [k for k in keys if k in df.columns]
    return present if len(present) >= minimum else None


def dedup_on(df: DataFrame, keys: list[str], order_by: list[str] | tuple = ()) -> DataFrame:
    order = [c for c in order_by if c not in keys and c in df.columns]
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.select(*keys).distinct()
    row = F.min(F.struct(*[F.col(c) for c in rest])).alias(_ROW)
    out = df.groupBy(*keys).agg(row)
    return out.select(*keys, *[F.col(f"{_ROW}.{c}").alias(c) for c in rest]).select(*df.columns)


def dedup(df: DataFrame, fmt: str, scope: list[str] | tuple = ("source_anio", "source_mes"),
          order_by: list[str] | tuple = ()) -> DataFrame:
    """D1-D4 within each source period (``scope`` columns that exist are added to the key)."""
    keys = key_columns(df, fmt)
    if keys is None:
        return df
    return dedup_on(df, keys + [s for s in scope if s in df.columns and s not in keys], order_by)
