"""Trip tables derived from the TPC-H-style driver tables (test and bench input).

The driver tables carry no trips, so these views give every trip column a deterministic
source column.  They are built with the DataFrame API, read the whole tables, and keep the
staging column names so the marts, rules and profiles run on them unchanged.

Design notes
  * Money is DECIMAL(18,2) so sums are exact and every engine agrees on them.
  * Taxi rows include unknown pickup zones (265), NULL zones and NULL distances, and text
    spellings of vendor and payment codes, so every cleaning rule has rows to act on.
  * Taxi timestamps are the order/ship dates moved forward 16 years (a multiple of four, so
    leap days stay valid), which puts them in 2011-2017: inside the taxi era, partly before
    the green window (2014) and partly after the zone-id era (2016).
  * Joins are plain equi-joins: Catalyst/AQE choose broadcast only when a side is under
    ``spark.sql.autoBroadcastJoinThreshold`` (a checked size bound), else sort-merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.functions.dates import anio_of, mes_of

TAXI_SHIFT = "INTERVAL 16 YEARS"
FHV_SENTINEL_TS = "1989-01-01 00:00:00"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One driver table, read as it lies."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def _money(c) -> F.Column:
    return c.cast("decimal(18,2)")


def trips_taxi(spark: SparkSession, root: str) -> DataFrame:
    """yellow + green trips: one per lineitem row."""
    li = table(spark, root, "lineitem")
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    s = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    c = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(s, li.l_suppkey == s.s_suppkey)
           .join(c, o.o_custkey == c.c_custkey))
    price = F.col("l_extendedprice")
    pickup = F.col("o_orderdate") + F.expr(TAXI_SHIFT)
    return j.select(
        F.col("l_orderkey").alias("trip_key"),
        F.col("l_linenumber").cast("bigint").alias("trip_line"),
        (F.col("l_suppkey") % 7).alias("vendorid"),
        F.when(F.col("l_linestatus") == "F", "yellow").otherwise("green").alias("tipo_taxi"),
        F.when(F.col("l_suppkey") % 7 == 1, "CMT").when(F.col("l_suppkey") % 7 == 2, "vts")
         .when(F.col("l_suppkey") % 7 == 3, "XYZ").otherwise((F.col("l_suppkey") % 7).cast("string"))
         .alias("vendor_raw"),
        F.when(F.col("l_returnflag") == "A", "CAS").when(F.col("l_returnflag") == "R", "Credit")
         .when(F.col("l_linenumber") == 1, "NO CHARGE").when(F.col("l_linenumber") == 2, "Dispute")
         .when(F.col("l_linenumber") == 3, "UNK").when(F.col("l_linenumber") == 4, "0")
         .otherwise("1.0").alias("payment_type_raw"),
        pickup.alias("pickup_datetime"),
        (F.col("l_shipdate") + F.expr(TAXI_SHIFT)).alias("dropoff_datetime"),
        F.when(F.col("l_quantity") != 50, F.col("l_quantity") - 1).alias("trip_distance"),
        _money(F.when(((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7))
                      | ((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 6)), -1).otherwise(1) * price)
        .alias("fare_amount"),
        _money(F.round(price * F.col("l_discount"))).alias("tip_amount"),
        _money(F.round(price * F.col("l_tax"))).alias("tolls_amount"),
        _money(F.when(F.col("l_linenumber") % 2 == 0, F.lit(2.50))).alias("congestion_surcharge"),
        _money(F.round(price * (1 + F.col("l_discount") + F.col("l_tax")))).alias("total_amount"),
        F.when(F.col("s_nationkey") == 23, 265)
         .when((F.col("s_nationkey") == 22) & (F.col("l_linenumber") == 3), F.lit(None))
         .otherwise(F.col("s_nationkey")).cast("bigint").alias("pulocationid"),
        F.when(F.col("c_nationkey") == 24, 264).otherwise(F.col("c_nationkey")).cast("bigint").alias("dolocationid"),
        anio_of(pickup).alias("anio"),
        mes_of(pickup).alias("mes"),
    )


def _app_seconds() -> F.Column:
    return F.col("user_id") % 40 * 60 - 180


def trips_fhvhv(spark: SparkSession, root: str) -> DataFrame:
    """High-volume app trips: one per event.  airport_fee is NULL for every fifth user on purpose."""
    e = table(spark, root, "events")
    n = _app_seconds()
    value = F.col("value")
    zero = _money(F.lit(0))
    return e.select(
        F.col("event_id"),
        F.when(F.col("user_id") % 3 == 0, "HV0003").when(F.col("user_id") % 3 == 1, "HV0004")
         .otherwise("HV0005").alias("hvfhs_license_num"),
        F.col("event_type").alias("dispatching_base_num"),
        F.col("ts").alias("pickup_datetime"),
        F.timestamp_add("SECOND", n, F.col("ts")).alias("dropoff_datetime"),
        n.cast("bigint").alias("trip_time"),
        (F.round(value * 100).cast("bigint") % 97).cast("double").alias("trip_miles"),
        _money(value).alias("base_passenger_fare"),
        zero.alias("tolls"), zero.alias("bcf"), zero.alias("sales_tax"), zero.alias("congestion_surcharge"),
        _money(F.when(F.col("user_id") % 5 != 0, F.lit(1.25))).alias("airport_fee"),
        _money(F.col("user_id") % 4).alias("tips"),
        _money(F.when(F.col("user_id") % 3 == 1, F.lit(0)).otherwise(value)).alias("driver_pay"),
        (F.col("user_id") % 26).alias("pulocationid"),
        (F.col("event_id") % 26).alias("dolocationid"),
        anio_of("ts").alias("anio"),
        mes_of("ts").alias("mes"),
    )


def trips_fhv(spark: SparkSession, root: str) -> DataFrame:
    """Traditional for-hire trips: sentinel dropoffs for a quarter of users, NULL for another quarter."""
    e = table(spark, root, "events")
    k = F.col("user_id") % 4
    dropoff = (F.when(k == 0, F.lit(FHV_SENTINEL_TS).cast("timestamp_ntz"))
                .when(k == 1, F.lit(None).cast("timestamp_ntz"))
                .otherwise(F.timestamp_add("SECOND", _app_seconds(), F.col("ts"))))
    return e.select(
        F.col("event_id"),
        F.col("event_type").alias("dispatching_base_num"),
        F.col("ts").alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        F.when(F.col("user_id") % 6 != 0, F.col("user_id") % 26).alias("pulocationid"),
        (F.col("event_id") % 26).alias("dolocationid"),
        anio_of("ts").alias("anio"),
        mes_of("ts").alias("mes"),
    )


def zones(spark: SparkSession, root: str) -> DataFrame:
    """Zone lookup (all string columns, like the CSV dimension): nation = zone, region = borough;
    every tenth zone is an airport (service_zone 'Airports')."""
    n = table(spark, root, "nation")
    r = table(spark, root, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.when(F.col("n_nationkey") % 10 == 0, "Airports").otherwise("Boro Zone").alias("service_zone"),
    )


def trip_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {"taxi": trips_taxi(spark, root), "fhvhv": trips_fhvhv(spark, root),
            "fhv": trips_fhv(spark, root), "zones": zones(spark, root)}
