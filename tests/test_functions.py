"""P4, P5, P9, P11 and the numeric helpers on the literal rows of FIXTURES §1."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import plan_text

from triplake.functions import (iso_weekday, payment_code, round2, safe_double, safe_long, vendor_code,
                                weekday_name, trip_minutes, year_range_predicate)


def test_safe_long_truncates_and_nulls(spark):
    vals = ["1", "1.0", "1.7", "UNK", "", "1e30", None, "-2.5", "NaN"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(safe_long("t")).collect()]
    assert got == [1, 1, 1, None, None, None, None, -2, None]


def test_safe_cast_from_double_column(spark):
    df = spark.createDataFrame([(1.7,), (float("nan"),), (1e30,), (None,)], "x double")
    assert [r[0] for r in df.select(safe_long("x")).collect()] == [1, None, None, None]
    assert [r[0] for r in df.select(safe_double("x")).collect()][0] == 1.7


def test_payment_codes(spark):
    vals = ["cas", "Credit", "NO CHARGE", "Dispute", "2", "1.0", "0", "UNK", "CRD", "noc", "DIS", None]
    df = spark.createDataFrame([(v,) for v in vals], "p string")
    got = [r[0] for r in df.select(payment_code("p")).collect()]
    assert got == [2, 1, 3, 4, 2, 1, 0, None, 1, 3, 4, None]


def test_payment_numeric_column(spark):
    df = spark.createDataFrame([(1,), (4,), (None,)], "p bigint")
    assert [r[0] for r in df.select(payment_code("p")).collect()] == [1, 4, None]


def test_vendor_codes(spark):
    df = spark.createDataFrame([("CMT",), ("vts",), ("XYZ",), ("6",), (None,)], "v string")
    assert [r[0] for r in df.select(vendor_code("v")).collect()] == [1, 2, None, 6, None]


def test_weekday_iso_sunday_is_seven(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 18, 30),), (dt.datetime(2024, 1, 8, 0, 0),)], "ts timestamp_ntz")
    got = df.select(iso_weekday("ts").alias("n"), weekday_name("ts").alias("w")).collect()
    assert [(r.n, r.w) for r in got] == [(7, "Sunday"), (1, "Monday")]


def test_trip_minutes_whole_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 7, 0, 900000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(trip_minutes("a", "b")).first()[0] == 7.0


def test_round2_half_up_and_stable(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (-0.125,), (-1.234,), (-0.001,), (None,)], "x double")
    got = [r[0] for r in df.select(round2(F.col("x") / 100)).collect()]
    assert got[:2] == [0.03, -0.03]                       # halves away from zero
    got = [r[0] for r in df.select(round2("x")).collect()]
    assert got[2:6] == [0.13, -0.13, -1.23, 0.0] and got[6] is None
    assert repr(got[5]) == "0.0"                          # no negative zero


def test_year_range_predicate_bounds(spark):
    ts = [dt.datetime(2008, 12, 31, 23, 59), dt.datetime(2009, 1, 1), dt.datetime(2026, 12, 31, 23, 59, 59),
          dt.datetime(2027, 1, 1), None]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    got = [r[0] for r in df.select(year_range_predicate("ts", 2009, 2026)).collect()]
    assert got == [False, True, True, False, None]


def test_year_range_pushes_both_bounds(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(dt.datetime(2010, 1, 1),)], "pickup_datetime timestamp_ntz").write.parquet(p)
    plan = plan_text(spark.read.parquet(p).where(year_range_predicate("pickup_datetime", 2009, 2026)))
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert "GreaterThanOrEqual(pickup_datetime" in pushed and "LessThan(pickup_datetime" in pushed


def test_typed_casts_equal_text_route(spark):
    """The direct numeric route gives what the text route gives, except that integers above 2**53
    keep their exact value instead of being rounded through a double."""
    from pyspark.sql import types as T
    vals = [(1.7, 3, 2.5), (-1.7, -3, -0.5), (1e30, 9007199254740993, 1e-7), (float("nan"), None, None),
            (None, 0, 123.456), (-0.0, 2**62, 7.0)]
    df = spark.createDataFrame(vals, "d double, l bigint, x double")
    for c, t in (("d", T.DoubleType()), ("l", T.LongType()), ("x", T.DoubleType())):
        a = [r[0] for r in df.select(safe_long(c, t)).collect()]
        b = [r[0] for r in df.select(safe_long(c)).collect()]
        src = [r[0] for r in df.select(c).collect()]
        for v, x, y in zip(src, a, b):
            if c == "l" and v is not None and abs(v) > 2**53:
                assert x == v
            else:
                assert x == y, (c, v)
        a = [r[0] for r in df.select(safe_double(c, t)).collect()]
        b = [r[0] for r in df.select(safe_double(c)).collect()]
        assert [repr(v) for v in a] == [repr(v) for v in b], c


def test_round2_keeps_what_has_no_cents(spark):
    import math
    from triplake.functions.numeric import round2
    values = [float("nan"), float("inf"), float("-inf"), 1e300, -9.3e16, 4e13 + 0.25, -2.005, 0.125, None]
    got = [r.x for r in spark.createDataFrame([(v,) for v in values], "x double").select(round2("x").alias("x")).collect()]
    assert math.isnan(got[0]) and got[1:5] == values[1:5]
    assert got[5:] == [4e13 + 0.25, -2.01, 0.13, None]
