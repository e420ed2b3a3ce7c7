"""Registered queries for profiles (E), measures (M), report views (V), questions (B) and period gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.operators import marts, measures as M, profile as P
from triplake.operators import quality as Q
from triplake.operators.normalize import normalize
from triplake.plans.incremental import rows_per_period
from triplake.sources import adapter
from triplake.sources.files import expected_periods, missing_periods, pending_periods

# Boroughs of the derived zone lookup (the pivot's columns), with the label of unknown zones.
BOROUGHS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown"]
AS_OF = "2026-12"   # report date of the gap report (a parameter, never the clock)


def normalized(spark, root) -> dict[str, DataFrame]:
    """Normalised trips per format with ``formato`` and the file period (anio, mes)."""
    t = adapter.trips_taxi(spark, root).withColumnRenamed("payment_type_raw", "payment_type")
    out = {}
    for tipo in ("yellow", "green"):
        out[tipo] = normalize(t.where(F.col("tipo_taxi") == tipo), tipo, keep=["trip_key", "trip_line", "anio", "mes"])
    out["fhvhv"] = normalize(adapter.trips_fhvhv(spark, root), "fhvhv", keep=["event_id", "anio", "mes"])
    out["fhv"] = normalize(adapter.trips_fhv(spark, root), "fhv", keep=["event_id", "anio", "mes"])
    return {k: v.withColumn("formato", F.lit(k)) for k, v in out.items()}


def _union(frames, cols):
    out = None
    for f in frames:
        f = f.select(*cols)
        out = f if out is None else out.unionByName(f)
    return out


def _taxi_norm(spark, root):
    n = normalized(spark, root)
    return n["yellow"].unionByName(n["green"])


def profile_volume(spark, root):
    return P.volume_coverage(_union(normalized(spark, root).values(), ["formato", "anio", "mes"]))


def profile_inverted_dates(spark, root):
    return P.inverted_dates(_taxi_norm(spark, root))


def profile_sentinel(spark, root):
    return P.sentinel_by_year(adapter.trips_fhv(spark, root))


def profile_year_overflow(spark, root):
    return P.year_overflow(_union(normalized(spark, root).values(), ["formato", "anio", "dropoff_datetime"]))


def profile_year_overflow_pickup(spark, root):
    """E5 by the pickup's year."""
    return P.year_overflow(_union(normalized(spark, root).values(), ["formato", "anio", "pickup_datetime"]),
                           "pickup_datetime")


def profile_duplicates(spark, root):
    n = normalized(spark, root)
    out = None
    for fmt, df in n.items():
        p = P.duplicate_profile(df, fmt)
        out = p if out is None else out.unionByName(p)
    return out


def profile_amounts(spark, root):
    return P.amount_ranges(_taxi_norm(spark, root))


def profile_amount_parts(spark, root):
    """E7 for the components of the taxi total."""
    return P.amount_ranges(_taxi_norm(spark, root), ("tip_amount", "tolls_amount", "congestion_surcharge"))


def profile_app_amounts(spark, root):
    """E7 for the app columns."""
    return P.amount_ranges(normalized(spark, root)["fhvhv"], ("base_passenger_fare", "tips", "airport_fee", "driver_pay"))


def profile_negative_cash(spark, root):
    return P.negative_cash_fares(_taxi_norm(spark, root))


def profile_negative_distance(spark, root):
    n = normalized(spark, root)
    apps = n["fhvhv"].withColumn("trip_distance", F.col("trip_miles"))
    return P.negative_distances(_union([n["yellow"], n["green"], apps], ["formato", "anio", "trip_distance"]))


def profile_zero_driver_pay(spark, root):
    return P.zero_driver_pay(adapter.trips_fhvhv(spark, root))


def profile_vendor_census(spark, root):
    return P.vendor_census(_taxi_norm(spark, root))


def profile_flex_contingency(spark, root):
    return P.ratecode_flex_contingency(_taxi_norm(spark, root))


def profile_accounting_gap(spark, root):
    return P.accounting_gap(_taxi_norm(spark, root))


def profile_unknown_zones(spark, root):
    return P.unknown_zone_share(_union(normalized(spark, root).values(),
                                       ["formato", "anio", "pulocationid", "dolocationid"]))


# ------------------------------------------------------------------ marts for the measures
def _share(spark, root):
    t = adapter.trip_tables(spark, root)
    return marts.market_share(t["taxi"], t["fhvhv"], t["fhv"])


def _kpis(spark, root):
    return marts.financial_kpis(adapter.trips_taxi(spark, root), adapter.trips_fhvhv(spark, root))


def _demand(spark, root):
    t = adapter.trip_tables(spark, root)
    return marts.territorial_demand(t["taxi"], t["fhvhv"], t["zones"])


def _temporal(spark, root):
    return marts.temporal_patterns(adapter.trips_taxi(spark, root), adapter.trips_fhvhv(spark, root))


def missing_periods_q(spark, root):
    """Expected months per format (from its first month to before the report date) minus present ones."""
    n = normalized(spark, root)
    present = _union(n.values(), ["formato", "anio", "mes"])
    return missing_periods(expected_periods(spark, list(n), AS_OF), present)


def pending_periods_q(spark, root):
    """Periods of every format with raw rows but no row surviving the cleaning rules (nothing to stage)."""
    n = normalized(spark, root)
    cols = ["formato", "anio", "mes"]
    return pending_periods(_union(n.values(), cols).distinct(),
                           _union([Q.split(Q.apply_rules(df, fmt))[0] for fmt, df in n.items()], cols))


QUERIES = {
    "profile_volume": profile_volume,
    "profile_inverted_dates": profile_inverted_dates,
    "profile_sentinel": profile_sentinel,
    "profile_year_overflow": profile_year_overflow,
    "profile_year_overflow_pickup": profile_year_overflow_pickup,
    "profile_duplicates": profile_duplicates,
    "profile_amounts": profile_amounts,
    "profile_amount_parts": profile_amount_parts,
    "profile_app_amounts": profile_app_amounts,
    "profile_negative_cash": profile_negative_cash,
    "profile_negative_distance": profile_negative_distance,
    "profile_zero_driver_pay": profile_zero_driver_pay,
    "profile_vendor_census": profile_vendor_census,
    "profile_flex_contingency": profile_flex_contingency,
    "profile_accounting_gap": profile_accounting_gap,
    "profile_unknown_zones": profile_unknown_zones,
    "measure_total_trips": lambda s, r: M.total_trips(_share(s, r)),
    "measure_app_share": lambda s, r: M.latest_year_share(_share(s, r), "fhvhv"),
    "measure_yellow_share": lambda s, r: M.latest_year_share(_share(s, r), "yellow"),
    "measure_yellow_share_last_present": lambda s, r: M.latest_year_share(_share(s, r), "yellow", present=True),
    "measure_peak_month": lambda s, r: M.peak_month(_share(s, r)),
    "measure_financial": lambda s, r: M.financial_summary(_kpis(s, r)),
    "measure_top_pickup_borough": lambda s, r: M.top_pickup_borough(_demand(s, r)),
    "measure_top_airport_corridor": lambda s, r: M.top_airport_corridor(_demand(s, r), adapter.zones(s, r)),
    "measure_peak_hour": lambda s, r: M.peak_hour(_temporal(s, r)),
    "measure_peak_days": lambda s, r: M.peak_days(_temporal(s, r)),
    "view_share_over_time": lambda s, r: M.share_over_time(_share(s, r)),
    "view_fare_by_service_year": lambda s, r: M.fare_by_service_year(_kpis(s, r)),
    "view_borough_matrix": lambda s, r: M.borough_matrix(_demand(s, r)),
    "view_borough_matrix_wide": lambda s, r: M.borough_matrix(_demand(s, r), wide=True, boroughs=BOROUGHS),
    "view_hourly_curve": lambda s, r: M.hourly_curve(_temporal(s, r), days=[1, 2, 3, 4, 5]),
    "view_hourly_curve_borough": lambda s, r: M.hourly_curve_by_borough(
        adapter.trips_taxi(s, r), adapter.trips_fhvhv(s, r), adapter.zones(s, r), days=[1, 2, 3, 4, 5]),
    "question_apps_overtake_yellow": lambda s, r: M.apps_overtake_yellow(_share(s, r)),
    "question_year_on_year": lambda s, r: M.year_on_year(_share(s, r)),
    "question_weekday_weekend_night": lambda s, r: M.weekday_weekend_night(_temporal(s, r)),
    "question_revenue_per_mile_minute": lambda s, r: M.revenue_per_mile_minute(adapter.trips_taxi(s, r),
                                                                                adapter.trips_fhvhv(s, r)),
    "staging_period_rows": lambda s, r: rows_per_period(adapter.trip_tables(s, r)),
    "missing_periods": missing_periods_q,
    "pending_periods": pending_periods_q,
}
