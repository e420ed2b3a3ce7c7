"""Data-quality rules as columns: a reject reason (NULL = clean) and audit flags.

The reference filters rows silently; here every rule is a boolean Column, the first failing
rule names the reason, and ``split`` gives the clean rows and a quarantine with the reason.
Filtering on ``reject_reason IS NULL`` is equivalent to the reference's chain of filters
(a rule whose predicate is NULL rejects, as a SQL WHERE would).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.functions.dates import year_range_predicate
from triplake.schema import (FLEX_FARE_CODE, FLEX_FARE_LABEL, TAXI_AMOUNT_PARTS, UNKNOWN_ZONE_IMPUTE, UNKNOWN_ZONES,
                             VENDOR_LABELS, YEAR_WINDOW, ZERO_PAY_LICENSES)

REASON = "reject_reason"


def _nonneg_or_null(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) >= 0)


def chronology(nullable_dropoff: bool = False) -> Column:
    """F1 (dropoff >= pickup, NULL on either side fails) or F2 for fhv (dropoff NULL passes)."""
    ok = F.col("dropoff_datetime") >= F.col("pickup_datetime")
    return (F.col("dropoff_datetime").isNull() | ok) if nullable_dropoff else ok


def year_window(fmt: str) -> Column:
    """pickup year inside the format's inclusive window (timestamp range, pushes to Parquet)."""
    lo, hi = YEAR_WINDOW[fmt]
    return year_range_predicate("pickup_datetime", lo, hi)


def not_placeholder() -> Column:
    """F6 (green): NOT (distance = 0 AND pickup zone unknown), three-valued as in SQL."""
    return ~((F.col("trip_distance") == 0) & F.col("pulocationid").isin(*UNKNOWN_ZONES))


def rules(fmt: str) -> list[tuple[str, Column]]:
    """(reason, predicate that must be TRUE) in the order the reference applies them."""
    r = [("dropoff_before_pickup", chronology(nullable_dropoff=(fmt == "fhv"))),
         ("pickup_year_out_of_range", year_window(fmt))]
    if fmt in ("yellow", "green"):
        r += [("negative_fare", _nonneg_or_null("fare_amount")),
              ("negative_distance", _nonneg_or_null("trip_distance"))]
    if fmt == "green":
        r += [("placeholder_unknown_zone", not_placeholder())]
    if fmt == "fhvhv":
        r += [("negative_trip_miles", _nonneg_or_null("trip_miles")),
              ("negative_trip_time", _nonneg_or_null("trip_time")),
              ("negative_base_fare", _nonneg_or_null("base_passenger_fare"))]
    return r


def reason_column(fmt: str) -> Column:
    out = None
    for name, pred in rules(fmt):
        failed = ~F.coalesce(pred, F.lit(False))
        out = F.when(failed, F.lit(name)) if out is None else out.when(failed, F.lit(name))
    return out


def passes(fmt: str) -> Column:
    """Conjunction of every rule (the reference's filter chain) for pushdown-friendly filtering."""
    out = None
    for _, pred in rules(fmt):
        out = pred if out is None else out & pred
    return out


def apply_rules(df: DataFrame, fmt: str) -> DataFrame:
    return df.withColumn(REASON, reason_column(fmt))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows without the reason column, quarantined rows with it)."""
    return df.where(F.col(REASON).isNull()).drop(REASON), df.where(F.col(REASON).isNotNull())


# ----------------------------------------------------------------------- audit flags (never overwrite)
def vendor_label(c: str = "vendorid") -> Column:
    """Official and unofficial vendor ids to a label; NULL id stays NULL."""
    out = None
    for k, v in VENDOR_LABELS.items():
        cond = F.col(c) == k
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.when(F.col(c).isNotNull(), F.lit("Other"))


def calculated_total(parts=TAXI_AMOUNT_PARTS) -> Column:
    """Sum of the fare components, a missing component counting as 0."""
    total = None
    for p in parts:
        term = F.coalesce(F.col(p).cast("double"), F.lit(0.0))
        total = term if total is None else total + term
    return total


def add_flags(df: DataFrame, fmt: str) -> DataFrame:
    cols = {}
    if fmt in ("yellow", "green"):
        cols["is_reversal"] = F.coalesce(F.col("fare_amount") < 0, F.lit(False))                    # E16
        cols["payment_label"] = F.when(F.col("payment_type") == FLEX_FARE_CODE, F.lit(FLEX_FARE_LABEL))  # E17
        cols["calculated_total"] = calculated_total()                                                # E19
        cols["vendor_label"] = vendor_label()                                                        # E20
    cols["pulocationid_filled"] = F.coalesce(F.col("pulocationid"), F.lit(UNKNOWN_ZONE_IMPUTE).cast("bigint"))  # E18
    cols["dolocationid_filled"] = F.coalesce(F.col("dolocationid"), F.lit(UNKNOWN_ZONE_IMPUTE).cast("bigint"))
    if fmt == "fhvhv":                                                                               # E21
        cols["zero_pay_allowed"] = F.col("hvfhs_license_num").isin(*ZERO_PAY_LICENSES)
        cols["driver_pay_suspect"] = F.coalesce((F.col("driver_pay") == 0)
                                                & ~F.col("hvfhs_license_num").isin(*ZERO_PAY_LICENSES), F.lit(False))
    return df.withColumns(cols)
