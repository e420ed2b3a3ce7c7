"""F1-F6 with every NULL case of FIXTURES §1, reasons, flags and the split."""

import datetime as dt

from pyspark.sql import functions as F

from triplake.operators import quality as Q
from triplake.operators.normalize import normalize

D = dt.datetime


def _taxi(spark, data):
    return spark.createDataFrame(data, "id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
                                       "fare_amount double, trip_distance double, pulocationid bigint")


def kept(df, fmt):
    return sorted(r.id for r in Q.split(Q.apply_rules(df, fmt))[0].select("id").collect())


def test_chronology_null_rejects_except_fhv(spark):
    t0 = D(2020, 5, 1, 10)
    data = [(1, t0, t0 - dt.timedelta(minutes=1), 5.0, 1.0, 7), (2, t0, None, 5.0, 1.0, 7),
            (3, None, t0, 5.0, 1.0, 7), (4, t0, t0, 5.0, 1.0, 7)]
    df = _taxi(spark, data)
    for fmt in ("yellow", "green"):
        assert kept(df, fmt) == [4]
    fhv = df.select("id", "pickup_datetime", "dropoff_datetime")
    assert kept(fhv, "fhv") == [2, 4]


def test_fhv_sentinel_becomes_null_and_row_stays(spark):
    t0 = D(2016, 3, 1, 8)
    raw = spark.createDataFrame([(1, t0, D(1989, 1, 1)), (2, t0, D(2016, 3, 1, 7))],
                                "event_id int, Pickup_DateTime timestamp_ntz, DropOff_datetime timestamp_ntz")
    raw = raw.withColumnsRenamed({"Pickup_DateTime": "pickup_datetime", "DropOff_datetime": "dropoff_datetime"})
    n = normalize(raw, "fhv", keep=["event_id"]).withColumnRenamed("event_id", "id")
    out = Q.split(Q.apply_rules(n, "fhv"))
    assert [(r.id, r.dropoff_datetime) for r in out[0].collect()] == [(1, None)]
    assert [r.reject_reason for r in out[1].collect()] == ["dropoff_before_pickup"]


def test_year_window_per_format(spark):
    data = [(i, D(y, 6, 1), D(y, 6, 1, 1), 5.0, 1.0, 7) for i, y in
            enumerate([2002, 2008, 2009, 2013, 2014, 2015, 2018, 2019, 2026, 2027, 2088])]
    df = _taxi(spark, data)
    years = {i: y for i, (_, y) in enumerate([(0, 2002), (1, 2008), (2, 2009), (3, 2013), (4, 2014), (5, 2015),
                                              (6, 2018), (7, 2019), (8, 2026), (9, 2027), (10, 2088)])}
    assert [years[i] for i in kept(df, "yellow")] == [2009, 2013, 2014, 2015, 2018, 2019, 2026]
    assert [years[i] for i in kept(df, "green")] == [2014, 2015, 2018, 2019, 2026]
    assert [years[i] for i in kept(df.drop("fare_amount", "trip_distance"), "fhv")] == [2015, 2018, 2019, 2026]


def test_non_negative_or_null(spark):
    t = D(2020, 1, 1)
    e = t + dt.timedelta(minutes=5)
    data = [(1, t, e, -1.0, 1.0, 7), (2, t, e, 0.0, 1.0, 7), (3, t, e, None, 1.0, 7),
            (4, t, e, 5.0, -1.0, 7), (5, t, e, 5.0, 0.0, 7), (6, t, e, 5.0, None, 7)]
    assert kept(_taxi(spark, data), "yellow") == [2, 3, 5, 6]


def test_green_placeholder_three_valued(spark):
    t = D(2020, 1, 1)
    e = t + dt.timedelta(minutes=5)
    cases = [(0.0, 264), (0.0, 7), (0.0, None), (None, 264), (None, 7), (1.0, None)]
    data = [(i, t, e, 5.0, d, pu) for i, (d, pu) in enumerate(cases)]
    # dropped, kept, dropped, dropped, kept, kept
    assert kept(_taxi(spark, data), "green") == [1, 4, 5]
    # yellow has no placeholder rule
    assert kept(_taxi(spark, data), "yellow") == [0, 1, 2, 3, 4, 5]


def test_first_failing_rule_is_the_reason(spark):
    t = D(2002, 1, 1)
    df = _taxi(spark, [(1, t, t - dt.timedelta(1), -1.0, -1.0, 264), (2, D(2020, 1, 1), D(2020, 1, 2), -1.0, -3.0, 1)])
    r = {x.id: x.reject_reason for x in Q.apply_rules(df, "yellow").collect()}
    assert r == {1: "dropoff_before_pickup", 2: "negative_fare"}


def test_app_rules(spark):
    t = D(2021, 1, 1)
    e = t + dt.timedelta(minutes=3)
    df = spark.createDataFrame([(1, t, e, -0.5, 10, 3.0), (2, t, e, 1.0, -1, 3.0), (3, t, e, 1.0, 10, -3.0),
                                (4, t, e, None, None, None), (5, D(2018, 12, 31), e, 1.0, 1, 1.0)],
                               "id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
                               "trip_miles double, trip_time bigint, base_passenger_fare double")
    r = {x.id: x.reject_reason for x in Q.apply_rules(df, "fhvhv").collect()}
    assert r == {1: "negative_trip_miles", 2: "negative_trip_time", 3: "negative_base_fare", 4: None,
                 5: "pickup_year_out_of_range"}


def test_flags_add_columns_and_never_overwrite(spark):
    df = spark.createDataFrame([(1, -2.5, 0, None, None, 10.0), (7, 3.0, 1, 7, 5, 3.0)],
                               "vendorid bigint, fare_amount double, payment_type bigint, pulocationid bigint, "
                               "dolocationid bigint, tip_amount double")
    for c in ("extra", "mta_tax", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee"):
        df = df.withColumn(c, F.lit(None).cast("double"))
    out = Q.add_flags(df, "yellow").orderBy("vendorid").collect()
    assert out[0].is_reversal is True and out[0].payment_label == "Flex Fare" and out[0].pulocationid is None
    assert out[0].pulocationid_filled == 264 and out[0].calculated_total == 7.5 and out[0].vendor_label == "CMT"
    assert out[1].is_reversal is False and out[1].payment_label is None and out[1].vendor_label == "Unofficial 7"


def test_zero_pay_rule(spark):
    df = spark.createDataFrame([("HV0004", 0.0, 1, 2), ("HV0003", 0.0, 1, 2), ("HV0005", 3.0, 1, 2)],
                               "hvfhs_license_num string, driver_pay double, pulocationid bigint, dolocationid bigint")
    out = {r.hvfhs_license_num: (r.zero_pay_allowed, r.driver_pay_suspect) for r in Q.add_flags(df, "fhvhv").collect()}
    assert out == {"HV0004": (True, False), "HV0003": (False, True), "HV0005": (False, False)}
