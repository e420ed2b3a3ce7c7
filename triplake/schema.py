"""Canonical schemas and the fixed values the pipeline must agree on.

Column names stay in the source language of the data model (anio = year, mes = month,
viajes = trips, cuota = share, tarifa = fare, propina = tip, peajes = tolls,
recargo = surcharge).
"""

from __future__ import annotations

from pyspark.sql import types as T

FORMATS = ("yellow", "green", "fhv", "fhvhv")
TAXI_FORMATS = ("yellow", "green")

L, D, S, TS = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _struct(cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# --- Staging contracts (payload columns, partition columns excluded) -----------------------
TAXI_COLUMNS = [
    ("vendorid", L), ("pickup_datetime", TS), ("dropoff_datetime", TS),
    ("passenger_count", L), ("trip_distance", D),
    ("pickup_longitude", D), ("pickup_latitude", D),
    ("ratecodeid", L), ("store_and_fwd_flag", S),
    ("dropoff_longitude", D), ("dropoff_latitude", D),
    ("payment_type", L), ("fare_amount", D), ("extra", D), ("mta_tax", D),
    ("tip_amount", D), ("tolls_amount", D), ("total_amount", D),
    ("pulocationid", L), ("dolocationid", L), ("trip_type", L),
    ("improvement_surcharge", D), ("congestion_surcharge", D),
    ("airport_fee", D), ("ehail_fee", D),
]
FHVHV_COLUMNS = [
    ("hvfhs_license_num", S), ("dispatching_base_num", S), ("originating_base_num", S),
    ("request_datetime", TS), ("on_scene_datetime", TS),
    ("pickup_datetime", TS), ("dropoff_datetime", TS),
    ("pulocationid", L), ("dolocationid", L), ("trip_miles", D), ("trip_time", L),
    ("base_passenger_fare", D), ("tolls", D), ("bcf", D), ("sales_tax", D),
    ("congestion_surcharge", D), ("airport_fee", D), ("tips", D), ("driver_pay", D),
    ("shared_request_flag", S), ("shared_match_flag", S), ("access_a_ride_flag", S),
    ("wav_request_flag", S), ("wav_match_flag", S),   # string on purpose: raw alternates numeric/text
]
FHV_COLUMNS = [
    ("dispatching_base_num", S), ("pickup_datetime", TS), ("dropoff_datetime", TS),
    ("pulocationid", L), ("dolocationid", L), ("sr_flag", L), ("affiliated_base_number", S),
]
CANONICAL = {
    "yellow": _struct(TAXI_COLUMNS),
    "green": _struct(TAXI_COLUMNS),
    "fhvhv": _struct(FHVHV_COLUMNS),
    "fhv": _struct(FHV_COLUMNS),
}
ZONE_SCHEMA = _struct([("locationid", S), ("borough", S), ("zone", S), ("service_zone", S)])

# Staging layout: table -> partition columns (all partition values are strings, month zero-padded).
STAGING_TABLE = {"yellow": "taxi", "green": "taxi", "fhvhv": "fhvhv", "fhv": "fhv"}
# Below the partition columns when rows land in their pickup's period: the source file's period, YYYY-MM.
SOURCE_FOLDER = "origen"
PARTITION_COLS = {"taxi": ["tipo_taxi", "anio", "mes"], "fhvhv": ["anio", "mes"], "fhv": ["anio", "mes"]}

# --- Fixed values (must equal the reference's for identical results) -----------------------
# Legacy column name -> canonical name; applied in this order, only when the target is absent.
ALIASES = [
    ("fare_amt", "fare_amount"),
    ("total_amt", "total_amount"),
    ("tip_amt", "tip_amount"),
    ("tolls_amt", "tolls_amount"),
    ("surcharge", "extra"),
    ("rate_code", "ratecodeid"),
    ("trip_pickup_datetime", "pickup_datetime"),
    ("tpep_pickup_datetime", "pickup_datetime"),
    ("trip_dropoff_datetime", "dropoff_datetime"),
    ("tpep_dropoff_datetime", "dropoff_datetime"),
    ("store_and_forward", "store_and_fwd_flag"),
    # green timestamps
    ("lpep_pickup_datetime", "pickup_datetime"),
    ("lpep_dropoff_datetime", "dropoff_datetime"),
]
# Vendor text -> id.
VENDOR_NAME_CODES = {"CMT": 1, "VTS": 2}
# Payment text (upper-cased) -> code.
PAYMENT_TEXT_CODES = {"CAS": 2, "CASH": 2, "CRD": 1, "CREDIT": 1,
                      "NOC": 3, "NO CHARGE": 3, "DIS": 4, "DISPUTE": 4}
# Inclusive pickup-year window per format.
YEAR_WINDOW = {"yellow": (2009, 2026), "green": (2014, 2026), "fhv": (2015, 2026), "fhvhv": (2019, 2026)}
# fhv dropoff placeholder meaning "not reported".
FHV_DROPOFF_SENTINEL = "1989-01-01 00:00:00"
# Zone ids meaning Unknown / Outside the city.
UNKNOWN_ZONES = (264, 265)
UNKNOWN_ZONE_IMPUTE = 264
# Natural trip keys for de-duplication, and the minimum number that must be present.
DEDUP_KEYS = {
    "yellow": (["vendorid", "pickup_datetime", "dropoff_datetime", "fare_amount"], 3),
    "green": (["vendorid", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid", "fare_amount"], 4),
    "fhv": (["dispatching_base_num", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid"], 3),
    "fhvhv": (["hvfhs_license_num", "dispatching_base_num", "pickup_datetime", "dropoff_datetime",
               "pulocationid", "dolocationid"], 4),
}
# First published period per format (YYYY-MM); default for anything else.
FORMAT_START = {"yellow": "2009-01", "green": "2013-08", "fhv": "2015-01", "fhvhv": "2019-02"}
DEFAULT_START = "2015-01"
# Vendor labels: 1 and 2 are official, 3-7 were seen in the data without documentation.
VENDOR_LABELS = {1: "CMT", 2: "VeriFone", 3: "Unofficial 3", 4: "Unofficial 4", 5: "Unofficial 5",
                 6: "Unofficial 6", 7: "Unofficial 7"}
# High-volume licence labels.
LICENSE_LABELS = {"HV0003": "Uber", "HV0004": "Via", "HV0005": "Lyft"}
# Licence allowed to report driver_pay = 0 (paid per shift).
ZERO_PAY_LICENSES = ("HV0004",)
# payment_type 0 label.
FLEX_FARE_CODE, FLEX_FARE_LABEL = 0, "Flex Fare"
# Components of the taxi accounting identity (total = sum of these).
TAXI_AMOUNT_PARTS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                     "improvement_surcharge", "congestion_surcharge", "airport_fee"]
# Components of the app gross amount.
FHVHV_AMOUNT_PARTS = ["base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge",
                      "airport_fee", "tips"]
# Minimum year for the zone-based demand mart on taxi data (string compare on the partition value).
DEMAND_TAXI_MIN_ANIO = "2016"

# Declared raw table columns and types (the external table definitions; files drift from these).
RAW_DECLARED = {
    "yellow": [("vendorid", "int"), ("tpep_pickup_datetime", "timestamp"), ("tpep_dropoff_datetime", "timestamp"),
               ("passenger_count", "bigint"), ("trip_distance", "double"), ("ratecodeid", "bigint"),
               ("store_and_fwd_flag", "string"), ("pulocationid", "int"), ("dolocationid", "int"),
               ("payment_type", "bigint"), ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"),
               ("tip_amount", "double"), ("tolls_amount", "double"), ("improvement_surcharge", "double"),
               ("total_amount", "double"), ("congestion_surcharge", "double"), ("airport_fee", "double")],
    "green": [("vendorid", "int"), ("lpep_pickup_datetime", "timestamp"), ("lpep_dropoff_datetime", "timestamp"),
              ("store_and_fwd_flag", "string"), ("ratecodeid", "bigint"), ("pulocationid", "int"),
              ("dolocationid", "int"), ("passenger_count", "bigint"), ("trip_distance", "double"),
              ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"), ("tip_amount", "double"),
              ("tolls_amount", "double"), ("ehail_fee", "double"), ("improvement_surcharge", "double"),
              ("total_amount", "double"), ("payment_type", "bigint"), ("trip_type", "bigint"),
              ("congestion_surcharge", "double")],
    "fhv": [("dispatching_base_num", "string"), ("pickup_datetime", "timestamp"), ("dropoff_datetime", "timestamp"),
            ("pulocationid", "bigint"), ("dolocationid", "bigint"), ("sr_flag", "bigint"),
            ("affiliated_base_number", "string")],
    "fhvhv": [("hvfhs_license_num", "string"), ("dispatching_base_num", "string"), ("originating_base_num", "string"),
              ("request_datetime", "timestamp"), ("on_scene_datetime", "timestamp"), ("pickup_datetime", "timestamp"),
              ("dropoff_datetime", "timestamp"), ("pulocationid", "int"), ("dolocationid", "int"),
              ("trip_miles", "double"), ("trip_time", "bigint"), ("base_passenger_fare", "double"),
              ("tolls", "double"), ("bcf", "double"), ("sales_tax", "double"), ("congestion_surcharge", "double"),
              ("airport_fee", "double"), ("tips", "double"), ("driver_pay", "double"),
              ("shared_request_flag", "string"), ("shared_match_flag", "string"), ("access_a_ride_flag", "string"),
              ("wav_request_flag", "string"), ("wav_match_flag", "string")],
}
