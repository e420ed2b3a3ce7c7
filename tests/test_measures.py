"""Report measures, views and questions on hand-made marts."""


from triplake.operators import measures as M

SHARE = "anio string, mes string, tipo_servicio string, total_viajes bigint, total_viajes_mes bigint, cuota_mercado_pct double"


def _share(spark, rows):
    return spark.createDataFrame(rows, SHARE)


def test_latest_year_share_is_unweighted_mean(spark):
    s = _share(spark, [("2025", "01", "fhvhv", 80, 100, 80.0), ("2025", "02", "fhvhv", 10, 1000, 1.0),
                       ("2025", "01", "yellow", 20, 100, 20.0), ("2024", "12", "fhvhv", 5, 5, 100.0)])
    r = M.latest_year_share(s, "fhvhv").first()
    assert r.ultimo_anio == "2025" and abs(r.cuota - 0.405) < 1e-12
    assert M.latest_year_share(s, "green").count() == 0


def test_peak_month_and_total(spark):
    s = _share(spark, [("2019", "10", "fhvhv", 5, 10, 50.0), ("2019", "10", "yellow", 5, 10, 50.0),
                       ("2020", "01", "yellow", 10, 10, 100.0), ("2018", "03", "fhv", 3, 3, 100.0)])
    p = M.peak_month(s).first()
    assert p.viajes_mes_pico == 10 and p.periodo_pico == "2020-01"          # tie: the latest month
    assert M.total_trips(s).first().total_viajes == 23


def test_year_on_year_uses_dense_calendar(spark):
    rows = [("2019", f"{m:02d}", "yellow", 100 + m, 0, 0.0) for m in range(1, 13) if m != 6]
    rows += [("2020", "01", "yellow", 50, 0, 0.0), ("2020", "06", "yellow", 7, 0, 0.0)]
    out = {(r.anio, r.mes): r for r in M.year_on_year(_share(spark, rows)).collect()}
    assert out[("2019", "06")].total_viajes == 0                          # the gap month exists, counted 0
    assert out[("2020", "01")].viajes_anio_anterior == 101
    assert abs(out[("2020", "01")].variacion_pct - 100.0 * (50 - 101) / 101) < 1e-9
    assert out[("2020", "06")].viajes_anio_anterior == 0 and out[("2020", "06")].variacion_pct is None


def test_apps_overtake_yellow(spark):
    s = _share(spark, [("2017", "01", "yellow", 10, 0, 0.0), ("2017", "01", "fhvhv", 9, 0, 0.0),
                       ("2017", "02", "yellow", 10, 0, 0.0), ("2017", "02", "fhvhv", 11, 0, 0.0),
                       ("2018", "01", "fhvhv", 1, 0, 0.0)])
    assert M.apps_overtake_yellow(s).first()[0] == "2017-02"


def test_share_over_time_pivot_has_every_service(spark):
    s = _share(spark, [("2019", "06", "fhvhv", 1, 2, 50.0), ("2019", "06", "green", 1, 2, 50.0)])
    r = M.share_over_time(s).first()
    assert (r.yellow, r.green, r.fhv, r.fhvhv) == (None, 50.0, None, 50.0)


def test_peak_hour_and_days(spark):
    t = spark.createDataFrame([("2024", "fhvhv", 5, "Friday", 18, 10), ("2024", "fhvhv", 6, "Saturday", 18, 9),
                               ("2024", "yellow", 5, "Friday", 8, 12), ("2024", "fhvhv", 1, "Monday", 8, 1)],
                              "anio string, tipo_servicio string, dia_semana_num bigint, dia_semana_nombre string, "
                              "hora_dia bigint, total_viajes bigint")
    h = M.peak_hour(t).first()
    assert (h.hora_dia, h.viajes, h.franja) == (18, 19, "18:00 - 19:00 hrs")
    assert [r.dia_semana_nombre for r in M.peak_days(t).collect()] == ["Friday", "Saturday"]
    b = {(r.tipo_servicio, r.tipo_dia, r.franja): r.viajes for r in M.weekday_weekend_night(t).collect()}
    assert b[("fhvhv", "fin_de_semana", "dia")] == 9 and b[("yellow", "laborable", "dia")] == 12


def test_top_airport_corridor(spark):
    d = spark.createDataFrame([("Manhattan", "JFK Airport", 5), ("Queens", "JFK Airport", 7),
                               ("Manhattan", "Midtown", 100)], "pu_borough string, do_zone string, total_viajes bigint")
    z = spark.createDataFrame([("132", "Queens", "JFK Airport", "Airports"), ("161", "Manhattan", "Midtown", "Yellow Zone")],
                              "locationid string, borough string, zone string, service_zone string")
    r = M.top_airport_corridor(d, z).first()
    assert (r.pu_borough, r.do_zone, r.viajes) == ("Queens", "JFK Airport", 7)


def test_fare_view_wide_matches_long(spark):
    k = spark.createDataFrame([("2020", "01", "yellow", 10.0, 2.5), ("2020", "02", "yellow", 12.0, 3.5),
                               ("2020", "01", "fhvhv", 20.0, 4.0)],
                              "anio string, mes string, tipo_servicio string, tarifa_base_promedio double, "
                              "tarifa_promedio_por_milla double")
    w = M.fare_by_service_year(k, wide=True).first()
    assert w.yellow_tarifa_por_viaje == 11.0 and w.fhvhv_tarifa_por_milla == 4.0 and w.green_tarifa_por_viaje is None
