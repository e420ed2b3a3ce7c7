"""P1-P4, P6-P12, Q1-Q3, Q12 and D1-D4 (deterministic, per source period, skew-safe plan)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import plan_text

from triplake.operators.dedup import dedup, dedup_on
from triplake.operators.normalize import normalize, resolve_aliases
from triplake.schema import CANONICAL

D = dt.datetime


def test_alias_only_when_target_absent():
    m = resolve_aliases(["fare_amt", "fare_amount", "tpep_pickup_datetime", "surcharge"])
    assert m["fare_amount"] == "fare_amount" and "fare_amt" in m
    assert m["pickup_datetime"] == "tpep_pickup_datetime" and m["extra"] == "surcharge"


def test_legacy_yellow_to_canonical(spark):
    raw = spark.createDataFrame(
        [("VTS", "2009-01-04 02:52:00", "2009-01-04 03:02:00", 1.0, 2.6, "CASH", 8.9, 0.5, 9.4, "junk")],
        "vendor_name string, Trip_Pickup_DateTime string, Trip_Dropoff_DateTime string, Passenger_Count double, "
        "Trip_Distance double, Payment_Type string, Fare_Amt double, surcharge double, Total_Amt double, "
        "unknown_col string")
    n = normalize(raw, "yellow")
    assert n.schema == CANONICAL["yellow"]                      # Q3: unknown column dropped; Q12: lon/lat created
    r = n.first()
    assert (r.vendorid, r.passenger_count, r.payment_type, r.fare_amount, r.extra) == (2, 1, 2, 8.9, 0.5)
    assert r.pickup_datetime == D(2009, 1, 4, 2, 52) and r.pickup_longitude is None and r.airport_fee is None


def test_green_mixed_case_and_lpep(spark):
    raw = spark.createDataFrame([(2, "2021-11-01 10:00:00", "2021-11-01 10:10:00", 74.0, 264.0, 1.0)],
                                "VendorID bigint, lpep_pickup_datetime string, lpep_dropoff_datetime string, "
                                "PULocationID double, DOLocationID double, payment_type double")
    r = normalize(raw, "green").first()
    assert (r.vendorid, r.pulocationid, r.dolocationid, r.payment_type) == (2, 74, 264, 1)
    assert r.pickup_datetime == D(2021, 11, 1, 10)


def test_vendor_id_text_gets_code_map(spark):
    raw = spark.createDataFrame([("CMT",), ("2",), ("bad",)], "vendor_id string")
    assert [r.vendorid for r in normalize(raw, "yellow").collect()] == [1, 2, None]


def test_fhvhv_wav_flag_stays_text(spark):
    raw = spark.createDataFrame([(1, "Y")], "airport_fee int, wav_match_flag string")
    r = normalize(raw, "fhvhv").first()
    assert r.airport_fee == 1.0 and r.wav_match_flag == "Y"


def _trips(spark, data):
    return spark.createDataFrame(data, "id bigint, vendorid bigint, pickup_datetime timestamp_ntz, "
                                       "dropoff_datetime timestamp_ntz, fare_amount double, tip double, "
                                       "source_anio string, source_mes string")


def test_dedup_one_survivor_smallest_order(spark):
    t, e = D(2020, 1, 6), D(2020, 1, 6, 0, 10)
    data = [(3, 2, t, e, 5.0, 1.0, "2020", "01"), (1, 2, t, e, 5.0, 9.0, "2020", "01"),
            (2, None, t, e, 5.0, 0.0, "2020", "01"), (4, None, t, e, 5.0, 0.0, "2020", "01"),
            (5, 2, t, e, 5.0, 2.0, "2020", "02")]                       # same key, other source period
    out = dedup(_trips(spark, data), "yellow", order_by=["id"])
    assert sorted(r.id for r in out.collect()) == [1, 2, 5]
    # deterministic: same survivor on another run and another partitioning
    again = dedup(_trips(spark, data).repartition(3), "yellow", order_by=["id"])
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in out.collect())


def test_dedup_skips_when_too_few_keys(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0)], "vendorid bigint, fare_amount double")
    assert dedup(df, "yellow").count() == 2


def test_dedup_plan_combines_map_side(spark):
    df = _trips(spark, [(1, 2, D(2020, 1, 1), D(2020, 1, 1), 5.0, 1.0, "2020", "01")])
    plan = plan_text(dedup(df, "yellow", order_by=["id"]))
    # a partial aggregate feeds the exchange: a hot key ships one row per map task
    assert plan.count("SortAggregate") + plan.count("HashAggregate") >= 2 and "Window" not in plan


def test_dedup_hot_key_whole_result(spark):
    """A key holding most rows still yields exactly one survivor and every other key untouched."""
    t = D(2020, 1, 1)
    hot = spark.range(0, 20000).select(F.col("id"), F.lit(1).cast("bigint").alias("vendorid"),
                                       F.lit(t).cast("timestamp_ntz").alias("pickup_datetime"),
                                       F.lit(t).cast("timestamp_ntz").alias("dropoff_datetime"),
                                       F.lit(2.5).alias("fare_amount"), F.lit(0.0).alias("tip"),
                                       F.lit("2020").alias("source_anio"), F.lit("01").alias("source_mes"))
    cold = hot.where(F.col("id") < 500).withColumn("fare_amount", F.col("id").cast("double") + 10)
    out = dedup(hot.unionByName(cold).repartition(8), "yellow", order_by=["id"])
    assert out.count() == 501
    assert out.where(F.col("fare_amount") == 2.5).first().id == 0


def test_dedup_on_all_columns_distinct(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "a bigint")
    assert sorted(r.a is None for r in dedup_on(df, ["a"]).collect()) == [False, True]
