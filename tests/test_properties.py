"""Properties from the test strategy: casts agree with a Python model; clean + quarantine = input - duplicates;
quarantine table carries every rejected row with its reason."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from triplake.catalog_jobs import write_raw_taxi
from triplake.functions.casts import safe_long
from triplake.operators import quality as Q
from triplake.operators.dedup import dedup
from triplake.plans.clean import clean, clean_periods
from triplake.sources import adapter


def model_long(text):
    if text is None:
        return None
    try:
        v = float(text.strip())
    except ValueError:
        return None
    if math.isnan(v) or math.isinf(v):
        return None
    t = math.trunc(v)
    return t if -2**63 <= t < 2**63 else None


texts = st.one_of(st.none(), st.integers(-10**6, 10**6).map(str),
                  st.floats(-1e6, 1e6, allow_nan=False).map(lambda f: f"{f:.3f}"),
                  st.sampled_from(["", "UNK", "1e30", "-1e30", "NaN", "1.0", "-0.5", "7.999"]))


@settings(max_examples=25, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_safe_long_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(safe_long("t")).collect()]
    assert got == [model_long(v) for v in values]


def test_clean_plus_quarantine_is_input_minus_duplicates(spark):
    t = adapter.trips_taxi(spark, SF_SMALL).withColumnRenamed("payment_type_raw", "payment_type") \
        .withColumnsRenamed({"anio": "source_anio", "mes": "source_mes"})
    for tipo in ("yellow", "green"):
        raw = t.where(F.col("tipo_taxi") == tipo)
        rows, rejected = clean(raw, tipo, order_by=["trip_key", "trip_line"], keep=["trip_key", "trip_line"])
        from triplake.operators.normalize import normalize
        n = normalize(raw, tipo, keep=["source_anio", "source_mes", "trip_key", "trip_line"])
        passing = Q.split(Q.apply_rules(n, tipo))[0]
        dups = passing.count() - dedup(passing, tipo, order_by=["trip_key", "trip_line"]).count()
        assert rows.count() + rejected.count() == raw.count() - dups
        assert rejected.where(F.col("reject_reason").isNull()).count() == 0


def test_quarantine_table_written(spark, tmp_path):
    raw, staging, quarantine = (str(tmp_path / x) for x in ("raw", "staging", "q"))
    write_raw_taxi(spark, SF_SMALL, raw)
    clean_periods(spark, raw, staging, "yellow", quarantine_root=quarantine)
    q = spark.read.parquet(f"{quarantine}/yellow")
    reasons = {r.reject_reason for r in q.select("reject_reason").distinct().collect()}
    assert "dropoff_before_pickup" in reasons and {"anio", "mes"} <= set(q.columns)
