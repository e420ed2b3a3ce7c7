"""Marts on the trip views: invariants, P19 NULL propagation, the pre-aggregated demand rewrite."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from triplake.functions.numeric import round2
from triplake.operators import marts
from triplake.sources import adapter


def test_shares_sum_to_100(spark):
    t = adapter.trip_tables(spark, SF_SMALL)
    s = marts.market_share(t["taxi"], t["fhvhv"], t["fhv"])
    sums = s.groupBy("anio", "mes").agg(F.sum("cuota_mercado_pct").alias("s")).collect()
    assert sums and all(abs(r.s - 100) <= 0.05 for r in sums)


def test_gross_amount_null_propagates(spark):
    df = spark.createDataFrame([(10.0, 1.0, 0.0, 0.0, 0.0, None, 2.0), (10.0, 1.0, 0.0, 0.0, 0.0, 1.25, 2.0)],
                               ", ".join(f"{c} double" for c in marts.FHVHV_AMOUNT_PARTS))
    assert [r[0] for r in df.select(marts.gross_amount()).collect()] == [None, 14.25]


def test_app_kpis_count_null_airport_fee_rows(spark):
    h = adapter.trips_fhvhv(spark, SF_SMALL)
    k = marts.app_kpis(h).first()
    scope = marts.app_kpi_scope(h)
    assert k.total_viajes == scope.count()
    gross = scope.select(F.sum(marts.gross_amount()).cast("double")).first()[0]
    assert k.ingreso_bruto_total == round(gross, 2)


def test_demand_preaggregation_equals_row_level_join(spark):
    t = adapter.trip_tables(spark, SF_SMALL)
    z = t["zones"]
    # duplicate one lookup id and add a non-numeric id: both engines must agree with the row-level form
    z = z.unionByName(z.where(F.col("locationid") == "3")).unionByName(
        spark.createDataFrame([("N/A", "X", "Y", "Z")], z.schema))
    got = marts.territorial_demand(t["taxi"], t["fhvhv"], z)
    v = marts.demand_trips(t["taxi"], t["fhvhv"])
    zz = z.select(F.col("locationid").try_cast("bigint").alias("id"), "borough", "zone")
    pu, do = zz.alias("pu"), zz.alias("do")
    j = v.join(pu, v.pulocationid == F.col("pu.id"), "left").join(do, v.dolocationid == F.col("do.id"), "left")
    unk = F.lit("Unknown")
    ref = j.groupBy("anio", "tipo_servicio", F.coalesce("pu.borough", unk).alias("pu_borough"),
                    F.coalesce("pu.zone", unk).alias("pu_zone"), F.coalesce("do.borough", unk).alias("do_borough"),
                    F.coalesce("do.zone", unk).alias("do_zone")).agg(
        F.count(F.lit(1)).alias("total_viajes"),
        round2(F.sum("millas").cast("double") / F.count("millas")).alias("distancia_promedio_millas"),
        round2(F.sum("monto").cast("double")).alias("monto_total"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.select(*got.columns).collect()))


def test_demand_uses_broadcast_lookup(spark):
    t = adapter.trip_tables(spark, SF_SMALL)
    plan = plan_text(marts.territorial_demand(t["taxi"], t["fhvhv"], t["zones"]))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_temporal_rows_are_years_services_days_hours(spark):
    start = dt.datetime(2024, 1, 1)
    ts = [start + dt.timedelta(hours=h) for h in range(24 * 7)]
    df = spark.createDataFrame([(t, 1.0, 2.0, "2024", "01", "yellow") for t in ts],
                               "pickup_datetime timestamp_ntz, fare_amount double, trip_distance double, anio string, "
                               "mes string, tipo_taxi string")
    app = spark.createDataFrame([], "pickup_datetime timestamp_ntz, base_passenger_fare double, trip_miles double, "
                                    "anio string, mes string")
    out = marts.temporal_patterns(df, app)
    assert out.count() == 7 * 24
    assert out.where((F.col("dia_semana_num") == 7) & (F.col("dia_semana_nombre") == "Sunday")).count() == 24


def test_period_file_vs_pickup(spark):
    from triplake.plans.clean import with_period
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 5), "2019", "12")],
                               "pickup_datetime timestamp_ntz, source_anio string, source_mes string")
    f = with_period(df, "yellow").first()
    p = with_period(df, "yellow", period="pickup").first()
    assert (f.anio, f.mes, f.tipo_taxi) == ("2019", "12", "yellow") and (p.anio, p.mes) == ("2020", "01")


def test_share_is_double_with_two_decimals(spark):
    counts = spark.createDataFrame([("2019", "06", "fhvhv", 2), ("2019", "06", "yellow", 1)],
                                   "anio string, mes string, tipo_servicio string, total_viajes bigint")
    out = {r.tipo_servicio: r.cuota_mercado_pct for r in marts.share_of_month(counts).collect()}
    assert out == {"fhvhv": 66.67, "yellow": 33.33}


def test_building_a_query_starts_no_aggregation_job(spark):
    """The plan is static: no row counts while a mart or a question is being built."""
    from triplake import catalog
    sc = spark.sparkContext
    before = {n: len(sc.statusTracker().getJobIdsForGroup(n)) for n in ("build",)}
    sc.setJobGroup("build", "build")
    warm = catalog.q_market_share(spark, SF_SMALL)
    read = len(sc.statusTracker().getJobIdsForGroup("build"))
    assert warm.columns and before["build"] == 0
    catalog.queries()["question_year_on_year"](spark, SF_SMALL)
    again = len(sc.statusTracker().getJobIdsForGroup("build")) - read
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert again <= read            # schema reads only, as many as the mart below it needs


def test_staging_write_rebalances_on_partition_columns(spark, tmp_path):
    """A hot period is split by AQE: the write is preceded by a rebalance on the partition columns."""
    from triplake.sources.sinks import _writer
    df = spark.createDataFrame([("2024", "01", 1)], "anio string, mes string, x bigint")
    w = _writer(df, ["anio", "mes"])
    plan = plan_text(w._df, "extended")
    assert "RebalancePartitions" in plan and "anio" in plan
