"""Report measures, views and business questions over the (small) marts.

Measures follow the report definitions: shares and tip percentages are *unweighted* means of
monthly values, divided by 100.  Top-k results are the measures themselves.  Single values
needed by another frame (the latest year, a grand total) are scalar subqueries
(``DataFrame.scalar()``): no join, no window over everything, no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplake.functions.numeric import mean_exact, ratio

SERVICES = ["yellow", "green", "fhv", "fhvhv"]
# Zones that count as airports in the lookup's service_zone column.
AIRPORT_SERVICE_ZONES = ("Airports", "EWR")
# Night hours for the night-demand question, and weekend day numbers (ISO, Monday = 1).
NIGHT_HOURS = (22, 23, 0, 1, 2, 3, 4, 5)
WEEKEND_DAYS = (6, 7)


def periodo(anio: str = "anio", mes: str = "mes") -> Column:
    return F.concat_ws("-", F.col(anio), F.col(mes))


# ------------------------------------------------------------------ M1-M8: single values
def total_trips(share: DataFrame) -> DataFrame:
    """M1."""
    return share.agg(F.sum("total_viajes").cast("bigint").alias("total_viajes"))


def latest_year_share(share: DataFrame, service: str, present: bool = False) -> DataFrame:
    """M2 (fhvhv) / M3 (yellow): mean monthly share of the service in the latest year present, / 100.

    ``present`` takes the latest year in which the service itself has trips.
    """
    own = F.col("tipo_servicio") == service
    latest = (share.where(own) if present else share).select(F.max("anio")).scalar()
    s = share.where((F.col("anio") == latest) & own)
    return s.groupBy(F.col("anio").alias("ultimo_anio")).agg((mean_exact("cuota_mercado_pct") / F.lit(100.0)).alias("cuota"))\
            .select(F.lit(service).alias("tipo_servicio"), "ultimo_anio", "cuota")


def peak_month(share: DataFrame) -> DataFrame:
    """M4: largest monthly volume and the month it happened (latest month on ties)."""
    m = share.select("anio", "mes", "total_viajes_mes").distinct()
    return m.agg(F.max("total_viajes_mes").alias("viajes_mes_pico"),
                 F.max_by(periodo(), F.struct("total_viajes_mes", "anio", "mes")).alias("periodo_pico"))


def financial_summary(kpis: DataFrame) -> DataFrame:
    """M5-M8: gross revenue, mean base fare, mean tip %, mean app driver pay."""
    app = F.col("tipo_servicio") == "fhvhv"
    return kpis.agg(F.sum(F.col("ingreso_bruto_total").cast("decimal(18,2)")).cast("double").alias("facturacion_bruta"),
                    mean_exact("tarifa_base_promedio").alias("tarifa_base_media"),
                    (mean_exact("porcentaje_propina") / F.lit(100.0)).alias("propina_promedio"),
                    mean_exact(F.when(app, F.col("pago_conductor_promedio_viaje"))).alias("pago_conductor_promedio"))


# ------------------------------------------------------------------ M9-M12: top-k
def top_pickup_borough(demand: DataFrame) -> DataFrame:
    """M9: pickup borough with most trips and its share of all trips."""
    b = demand.groupBy("pu_borough").agg(F.sum("total_viajes").alias("viajes"))
    total = b.select(F.sum("viajes")).scalar()
    top = b.orderBy(F.col("viajes").desc(), F.col("pu_borough")).limit(1)
    return top.select("pu_borough", "viajes", ratio(F.col("viajes"), total).alias("cuota"))


def top_airport_corridor(demand: DataFrame, zones: DataFrame, airport_service_zones=AIRPORT_SERVICE_ZONES) -> DataFrame:
    """(pickup borough -> airport zone) pair with most trips."""
    airports = zones.where(F.col("service_zone").isin(*airport_service_zones)).select(F.col("zone").alias("do_zone")).distinct()
    c = (demand.join(airports, "do_zone", "left_semi")
               .groupBy("pu_borough", "do_zone").agg(F.sum("total_viajes").alias("viajes")))
    return c.orderBy(F.col("viajes").desc(), "pu_borough", "do_zone").limit(1)


def peak_hour(temporal: DataFrame) -> DataFrame:
    """The hour of day with most trips, labelled 'HH:00 - HH:00 hrs'."""
    h = temporal.groupBy("hora_dia").agg(F.sum("total_viajes").alias("viajes"))
    top = h.orderBy(F.col("viajes").desc(), "hora_dia").limit(1)
    label = F.format_string("%02d:00 - %02d:00 hrs", F.col("hora_dia").cast("int"), ((F.col("hora_dia") + 1) % 24).cast("int"))
    return top.select("hora_dia", "viajes", label.alias("franja"))


def peak_days(temporal: DataFrame, k: int = 2) -> DataFrame:
    """The k weekdays with most trips."""
    d = temporal.groupBy("dia_semana_num", "dia_semana_nombre").agg(F.sum("total_viajes").alias("viajes"))
    return d.orderBy(F.col("viajes").desc(), "dia_semana_num").limit(k)


# ------------------------------------------------------------------ V1-V4: report views
def share_over_time(share: DataFrame) -> DataFrame:
    """V1: one row per month, one share column per service (pivot with the fixed service list)."""
    return share.groupBy("anio", "mes").pivot("tipo_servicio", SERVICES).agg(F.first("cuota_mercado_pct"))


def fare_by_service_year(kpis: DataFrame, wide: bool = False) -> DataFrame:
    """V2: mean monthly fare per trip and per mile by service and year; ``wide`` pivots the services
    into columns (``<service>_tarifa_por_viaje``, ``<service>_tarifa_por_milla``) with the fixed list."""
    if wide:
        return kpis.groupBy("anio").pivot("tipo_servicio", SERVICES).agg(
            mean_exact("tarifa_base_promedio").alias("tarifa_por_viaje"),
            mean_exact("tarifa_promedio_por_milla").alias("tarifa_por_milla"))
    return kpis.groupBy("anio", "tipo_servicio").agg(mean_exact("tarifa_base_promedio").alias("tarifa_por_viaje"),
                                                    mean_exact("tarifa_promedio_por_milla").alias("tarifa_por_milla"))


def borough_matrix(demand: DataFrame, wide: bool = False, boroughs: list[str] | None = None) -> DataFrame:
    """V3: pickup borough x dropoff borough trips; long form, or wide with the given borough list."""
    long = demand.groupBy("pu_borough", "do_borough").agg(F.sum("total_viajes").alias("viajes"))
    if not wide:
        return long
    return long.groupBy("pu_borough").pivot("do_borough", boroughs).agg(F.first("viajes"))


def hourly_curve(temporal: DataFrame, days=None, service: str | None = None) -> DataFrame:
    """V4: trips per hour for the selected weekdays and service."""
    t = temporal
    if days is not None:
        t = t.where(F.col("dia_semana_num").isin(*days))
    if service is not None:
        t = t.where(F.col("tipo_servicio") == service)
    return t.groupBy("tipo_servicio", "hora_dia").agg(F.sum("total_viajes").alias("viajes"))


# ------------------------------------------------------------------ B1-B4: questions
def apps_overtake_yellow(share: DataFrame) -> DataFrame:
    """B1: first month in which app trips exceed yellow trips (a missing service counts 0)."""
    p = share.groupBy("anio", "mes").pivot("tipo_servicio", ["yellow", "fhvhv"]).agg(F.sum("total_viajes"))
    over = p.where(F.coalesce("fhvhv", F.lit(0)) > F.coalesce("yellow", F.lit(0)))
    return over.agg(F.min(periodo()).alias("primer_mes_apps_superan_yellow"))


def year_on_year(share: DataFrame) -> DataFrame:
    """B2: trips vs the same month a year before, per service, over a dense month calendar.

    Months with no rows count 0 so ``lag(12)`` really is twelve months back.  One window
    partition per service: a few hundred months each.
    """
    d = share.select("tipo_servicio", F.to_date(F.concat_ws("-", "anio", "mes", F.lit("01"))).alias("d"), "total_viajes")
    bounds = d.groupBy("tipo_servicio").agg(F.min("d").alias("d0"), F.max("d").alias("d1"))
    cal = bounds.select("tipo_servicio", F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 MONTH"))).alias("d"))
    dense = (cal.join(d, ["tipo_servicio", "d"], "left")
                .withColumn("total_viajes", F.coalesce("total_viajes", F.lit(0))))
    w = Window.partitionBy("tipo_servicio").orderBy("d")
    prev = F.lag("total_viajes", 12).over(w)
    return dense.select("tipo_servicio", F.date_format("d", "yyyy").alias("anio"), F.date_format("d", "MM").alias("mes"),
                        F.col("total_viajes").cast("bigint").alias("total_viajes"),
                        prev.cast("bigint").alias("viajes_anio_anterior"),
                        (F.lit(100.0) * ratio(F.col("total_viajes") - prev, prev)).alias("variacion_pct"))


def weekday_weekend_night(temporal: DataFrame) -> DataFrame:
    """Trips by service and year split into weekday/weekend and night/day."""
    tipo = F.when(F.col("dia_semana_num").isin(*WEEKEND_DAYS), "fin_de_semana").otherwise("laborable")
    franja = F.when(F.col("hora_dia").isin(*NIGHT_HOURS), "noche").otherwise("dia")
    return temporal.groupBy("anio", "tipo_servicio", tipo.alias("tipo_dia"), franja.alias("franja")) \
                   .agg(F.sum("total_viajes").cast("bigint").alias("viajes"))


def revenue_per_mile_minute(taxi: DataFrame, fhvhv: DataFrame) -> DataFrame:
    """Revenue per mile and per minute (ratios of sums) by service and year, on the KPI scope."""
    from triplake.operators.marts import app_kpi_scope, gross_amount, taxi_kpi_scope, trip_seconds
    t = taxi_kpi_scope(taxi).select("anio", F.col("tipo_taxi").alias("tipo_servicio"),
                                    F.col("total_amount").alias("ingreso"), F.col("trip_distance").alias("millas"),
                                    trip_seconds().alias("segundos"))
    h = app_kpi_scope(fhvhv).select("anio", F.lit("fhvhv").alias("tipo_servicio"), gross_amount().alias("ingreso"),
                                    F.col("trip_miles").alias("millas"), F.col("trip_time").alias("segundos"))
    u = t.unionByName(h)
    g = u.groupBy("anio", "tipo_servicio").agg(F.sum("ingreso").alias("s_ingreso"), F.sum("millas").alias("s_millas"),
                                               F.sum("segundos").alias("s_segundos"))
    return g.select("anio", "tipo_servicio", ratio("s_ingreso", "s_millas").alias("ingreso_por_milla"),
                    ratio(F.col("s_ingreso").cast("double") * F.lit(60.0), "s_segundos").alias("ingreso_por_minuto"))


def hourly_curve_by_borough(taxi: DataFrame, fhvhv: DataFrame, zones: DataFrame, borough: str | None = None,
                            days=None, service: str | None = None) -> DataFrame:
    """V4 with the borough filter: trips of the F11 scope counted by zone id and hour, then labelled.

    The temporal mart has no borough; the lookup joins the counts, not the trips.
    """
    from triplake.operators.marts import temporal_trips
    trips = temporal_trips(taxi.withColumn("_pu", F.col("pulocationid")), fhvhv.withColumn("_pu", F.col("pulocationid")))
    if days is not None:
        trips = trips.where(F.col("dia_semana_num").isin(*days))
    if service is not None:
        trips = trips.where(F.col("tipo_servicio") == service)
    by_id = trips.groupBy("_pu", "tipo_servicio", "hora_dia").agg(F.count(F.lit(1)).alias("n"))
    z = zones.select(F.col("locationid").try_cast("bigint").alias("_pu"), F.col("borough").alias("pu_borough"))
    t = by_id.join(z, "_pu", "left").withColumn("pu_borough", F.coalesce("pu_borough", F.lit("Unknown")))
    if borough is not None:
        t = t.where(F.col("pu_borough") == borough)
    return t.groupBy("pu_borough", "tipo_servicio", "hora_dia").agg(F.sum("n").cast("bigint").alias("viajes"))
