"""Registered queries for normalisation, quality rules, flags and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.functions.casts import payment_code, safe_double, safe_long, vendor_code
from triplake.operators import quality as Q
from triplake.operators.dedup import dedup
from triplake.operators.normalize import normalize
from triplake.plans.clean import clean
from triplake.sources import adapter

TAXI_ID = ["trip_key", "trip_line"]


def _taxi(spark, root, tipo=None):
    t = adapter.trips_taxi(spark, root)
    return t if tipo is None else t.where(F.col("tipo_taxi") == tipo)


def clean_chronology(spark, root) -> DataFrame:
    """F1 on taxi rows: dropoff >= pickup, NULL on either side rejects."""
    return (_taxi(spark, root).where(Q.chronology())
            .select(*TAXI_ID, "tipo_taxi", "pickup_datetime", "dropoff_datetime"))


def clean_chronology_nullable(spark, root) -> DataFrame:
    """P12 + F2 on fhv rows: sentinel dropoff becomes NULL and the row stays."""
    n = normalize(adapter.trips_fhv(spark, root), "fhv", keep=["event_id"])
    return n.where(Q.chronology(nullable_dropoff=True)).select("event_id", "pickup_datetime", "dropoff_datetime")


def clean_year_window(spark, root) -> DataFrame:
    """F3 per format on every trip table."""
    t = _taxi(spark, root)
    taxi = t.where(((F.col("tipo_taxi") == "yellow") & Q.year_window("yellow"))
                   | ((F.col("tipo_taxi") == "green") & Q.year_window("green")))
    taxi = taxi.select(F.col("tipo_taxi").alias("formato"), F.concat_ws(":", *TAXI_ID).alias("trip_id"), "anio")
    h = (adapter.trips_fhvhv(spark, root).where(Q.year_window("fhvhv"))
         .select(F.lit("fhvhv").alias("formato"), F.col("event_id").cast("string").alias("trip_id"), "anio"))
    f = (adapter.trips_fhv(spark, root).where(Q.year_window("fhv"))
         .select(F.lit("fhv").alias("formato"), F.col("event_id").cast("string").alias("trip_id"), "anio"))
    return taxi.unionByName(h).unionByName(f)


def clean_nonnegative(spark, root) -> DataFrame:
    """fare and distance non-negative or NULL."""
    t = _taxi(spark, root)
    return (t.where(Q._nonneg_or_null("fare_amount") & Q._nonneg_or_null("trip_distance"))
            .select(*TAXI_ID, F.col("fare_amount").cast("double").alias("fare_amount"), "trip_distance"))


def clean_app_nonnegative(spark, root) -> DataFrame:
    """miles, seconds and base fare non-negative or NULL."""
    h = adapter.trips_fhvhv(spark, root)
    return (h.where(Q._nonneg_or_null("trip_miles") & Q._nonneg_or_null("trip_time")
                    & Q._nonneg_or_null("base_passenger_fare"))
            .select("event_id", "trip_miles", "trip_time"))


def clean_placeholder_3vl(spark, root) -> DataFrame:
    """F6 on green rows, three-valued: NULL distance or zone with the other condition true rejects."""
    g = _taxi(spark, root, "green")
    return g.where(Q.not_placeholder()).select(*TAXI_ID, "trip_distance", "pulocationid")


def _cast_text():
    """Text values derived from lineitem that exercise every branch of the safe casts."""
    ln = F.col("l_linenumber")
    pk = F.col("l_partkey").cast("string")
    return (F.when(ln == 1, pk).when(ln == 2, F.concat(pk, F.lit(".0"))).when(ln == 3, F.concat(pk, F.lit(".7")))
             .when(ln == 4, F.concat(F.lit("-"), pk, F.lit(".5"))).when(ln == 5, F.lit("UNK"))
             .when(ln == 6, F.lit("")).when(ln == 7, F.concat(pk, F.lit("e30"))))


def safe_cast_matrix(spark, root) -> DataFrame:
    """P5: text -> bigint (via double, truncating) and -> double; malformed or out of range -> NULL."""
    li = adapter.table(spark, root, "lineitem")
    txt = _cast_text()
    return li.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                     txt.alias("raw_text"), safe_long(txt).alias("as_bigint"), safe_double(txt).alias("as_double"))


def normalize_payment(spark, root) -> DataFrame:
    t = _taxi(spark, root)
    return t.select(*TAXI_ID, "payment_type_raw", payment_code("payment_type_raw").alias("payment_type"))


def normalize_vendor(spark, root) -> DataFrame:
    t = _taxi(spark, root)
    return t.select(*TAXI_ID, "vendor_raw", vendor_code("vendor_raw").alias("vendorid"))


def legacy_yellow(spark, root) -> DataFrame:
    """Taxi rows laid out like an early yellow file: mixed case, legacy names, text timestamps, a double id."""
    t = _taxi(spark, root)
    return t.select(
        F.col("vendor_raw").alias("vendor_name"),
        F.col("pickup_datetime").cast("string").alias("Trip_Pickup_DateTime"),
        F.col("dropoff_datetime").cast("string").alias("Trip_Dropoff_DateTime"),
        F.col("trip_line").alias("Passenger_Count"),
        F.col("trip_distance").alias("Trip_Distance"),
        F.col("payment_type_raw").alias("Payment_Type"),
        F.col("fare_amount").alias("Fare_Amt"),
        F.col("tip_amount").alias("Tip_Amt"),
        F.col("tolls_amount").alias("Tolls_Amt"),
        F.col("total_amount").alias("Total_Amt"),
        F.col("congestion_surcharge").alias("surcharge"),
        F.col("pulocationid").cast("double").alias("PULocationID"),
        F.col("dolocationid").alias("DOLocationID"),
        F.lit("N").alias("store_and_forward"),
        F.col("trip_key").alias("Trip_Key"),
        F.col("trip_line").alias("Trip_Line"),
    )


def canonical_schema(spark, root) -> DataFrame:
    """A legacy layout projected to the 25 staging columns."""
    return normalize(legacy_yellow(spark, root), "yellow", keep=["trip_key", "trip_line"])


def _dedup_taxi(tipo):
    def q(spark, root):
        return dedup(_taxi(spark, root, tipo), tipo, scope=["anio", "mes"], order_by=TAXI_ID).select(
            *TAXI_ID, "anio", "mes", "vendorid", "pickup_datetime", "dropoff_datetime",
            "pulocationid", "dolocationid", F.col("fare_amount").cast("double").alias("fare_amount"))
    q.__name__ = f"dedup_{tipo}"
    return q


def dedup_fhv(spark, root) -> DataFrame:
    f = normalize(adapter.trips_fhv(spark, root), "fhv", keep=["event_id", "anio", "mes"])
    return dedup(f, "fhv", scope=["anio", "mes"], order_by=["event_id"]).select(
        "event_id", "anio", "mes", "dispatching_base_num", "pickup_datetime", "dropoff_datetime",
        "pulocationid", "dolocationid")


def dedup_fhvhv(spark, root) -> DataFrame:
    h = adapter.trips_fhvhv(spark, root)
    return dedup(h, "fhvhv", scope=["anio", "mes"], order_by=["event_id"]).select(
        "event_id", "anio", "mes", "hvfhs_license_num", "dispatching_base_num", "pickup_datetime",
        "dropoff_datetime", "pulocationid", "dolocationid")


def _formats(spark, root):
    """(format, normalised frame) for every trip table; taxi split by tipo_taxi."""
    t = _taxi(spark, root).withColumnRenamed("payment_type_raw", "payment_type")
    out = [(tipo, normalize(t.where(F.col("tipo_taxi") == tipo), tipo, keep=TAXI_ID)) for tipo in ("yellow", "green")]
    out.append(("fhvhv", normalize(adapter.trips_fhvhv(spark, root), "fhvhv", keep=["event_id"])))
    out.append(("fhv", normalize(adapter.trips_fhv(spark, root), "fhv", keep=["event_id"])))
    return out


def quarantine_reasons(spark, root) -> DataFrame:
    """Rejected rows per format and first failing rule."""
    parts = [Q.apply_rules(df, fmt).where(F.col(Q.REASON).isNotNull())
             .groupBy(F.lit(fmt).alias("formato"), Q.REASON).agg(F.count(F.lit(1)).alias("filas"))
             for fmt, df in _formats(spark, root)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rule_flags(spark, root) -> DataFrame:
    """E16-E20 on normalised taxi rows."""
    parts = []
    for fmt, df in _formats(spark, root)[:2]:
        parts.append(Q.add_flags(df, fmt).select(
            *TAXI_ID, F.lit(fmt).alias("formato"), "is_reversal", "payment_label", "calculated_total",
            "vendor_label", "pulocationid_filled", "dolocationid_filled"))
    return parts[0].unionByName(parts[1])


def rule_flags_app(spark, root) -> DataFrame:
    """E18, E21 on normalised app rows."""
    fmt, df = _formats(spark, root)[2]
    return Q.add_flags(df, fmt).select("event_id", "hvfhs_license_num", "zero_pay_allowed", "driver_pay_suspect",
                                       "pulocationid_filled", "dolocationid_filled")


def clean_taxi_staging(spark, root) -> DataFrame:
    """The whole cleaning job on taxi rows: normalise, rules, per-period dedup, partition tags."""
    t = _taxi(spark, root).withColumnRenamed("payment_type_raw", "payment_type").withColumnsRenamed(
        {"anio": "source_anio", "mes": "source_mes"})
    outs = []
    for tipo in ("yellow", "green"):
        rows, _ = clean(t.where(F.col("tipo_taxi") == tipo), tipo, order_by=TAXI_ID, keep=TAXI_ID)
        outs.append(rows.select(*TAXI_ID, "tipo_taxi", "anio", "mes", "vendorid", "pickup_datetime",
                                "dropoff_datetime", "payment_type", "fare_amount", "trip_distance",
                                "pulocationid", "dolocationid"))
    return outs[0].unionByName(outs[1])


QUERIES = {
    "clean_chronology": clean_chronology,
    "clean_chronology_nullable": clean_chronology_nullable,
    "clean_year_window": clean_year_window,
    "clean_nonnegative": clean_nonnegative,
    "clean_app_nonnegative": clean_app_nonnegative,
    "clean_placeholder_3vl": clean_placeholder_3vl,
    "safe_cast_matrix": safe_cast_matrix,
    "normalize_payment": normalize_payment,
    "normalize_vendor": normalize_vendor,
    "canonical_schema": canonical_schema,
    "dedup_yellow": _dedup_taxi("yellow"),
    "dedup_green": _dedup_taxi("green"),
    "dedup_fhv": dedup_fhv,
    "dedup_fhvhv": dedup_fhvhv,
    "quarantine_reasons": quarantine_reasons,
    "rule_flags": rule_flags,
    "rule_flags_app": rule_flags_app,
    "clean_taxi_staging": clean_taxi_staging,
}
