"""The four aggregate tables (marts) over staging trips.

Inputs are staging-shaped DataFrames: ``taxi`` (yellow + green, with ``tipo_taxi``),
``fhvhv``, ``fhv``, each with string partition columns ``anio``/``mes``; ``zones`` is the
lookup (``locationid`` text, ``borough``, ``zone``).

Every aggregate is a ``groupBy`` with partial (map-side) aggregation, so one hot key costs
one row per map task in the shuffle.  Averages are computed as SUM/COUNT so the same pairs
can be kept as monthly state (see ``plans.incremental``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplake.functions.dates import iso_weekday, weekday_name
from triplake.functions.numeric import exact, mean, nz_sum, ratio, round2
from triplake.schema import DEMAND_TAXI_MIN_ANIO, FHVHV_AMOUNT_PARTS

MARTS = ("mart_cuota_mercado_mensual", "mart_kpis_financieros",
         "mart_demanda_territorial", "mart_patrones_temporales")
ORDER = {
    "mart_cuota_mercado_mensual": ["anio", "mes", "tipo_servicio"],
    "mart_kpis_financieros": ["anio", "mes", "tipo_servicio"],
    "mart_demanda_territorial": ["anio", "tipo_servicio", "pu_borough", "pu_zone", "do_borough", "do_zone"],
    "mart_patrones_temporales": ["anio", "tipo_servicio", "dia_semana_num", "hora_dia"],
}


def gross_amount(parts=FHVHV_AMOUNT_PARTS) -> Column:
    """App gross amount per trip; NULL if any component is NULL (plain addition)."""
    total = None
    for c in parts:
        total = F.col(c) if total is None else total + F.col(c)
    return total


def trip_seconds(pickup="pickup_datetime", dropoff="dropoff_datetime") -> Column:
    return F.timestamp_diff("SECOND", F.col(pickup), F.col(dropoff))


def _minutes_mean(seconds: Column) -> Column:
    """AVG(seconds / 60.0) computed as SUM(seconds) / COUNT / 60 (exact integer sum)."""
    return F.sum(seconds).cast("double") / F.nullif(F.count(seconds), F.lit(0)) / F.lit(60.0)


# --------------------------------------------------------------------------- market share
def monthly_counts(taxi: DataFrame, fhvhv: DataFrame, fhv: DataFrame) -> DataFrame:
    """(anio, mes, tipo_servicio, total_viajes) for every service."""
    n = F.count(F.lit(1)).alias("total_viajes")
    t = taxi.groupBy("anio", "mes", F.col("tipo_taxi").alias("tipo_servicio")).agg(n)
    h = fhvhv.groupBy("anio", "mes").agg(n).select("anio", "mes", F.lit("fhvhv").alias("tipo_servicio"), "total_viajes")
    f = fhv.groupBy("anio", "mes").agg(n).select("anio", "mes", F.lit("fhv").alias("tipo_servicio"), "total_viajes")
    return t.unionByName(h).unionByName(f)


def share_of_month(counts: DataFrame) -> DataFrame:
    """Adds the month total (window over anio, mes) and the share in percent, two decimals."""
    w = Window.partitionBy("anio", "mes")
    return (counts
            .withColumn("total_viajes_mes", F.sum("total_viajes").over(w).cast("bigint"))
            .withColumn("cuota_mercado_pct", round2(ratio("total_viajes", "total_viajes_mes", 100.0))))


def market_share(taxi: DataFrame, fhvhv: DataFrame, fhv: DataFrame) -> DataFrame:
    return share_of_month(monthly_counts(taxi, fhvhv, fhv))


# --------------------------------------------------------------------------- financial KPIs
def taxi_kpi_scope(taxi: DataFrame) -> DataFrame:
    """positive distance, fare and total, and no inverted dates."""
    return taxi.where((F.col("trip_distance") > 0) & (F.col("fare_amount") > 0) & (F.col("total_amount") > 0)
                      & (F.col("dropoff_datetime") >= F.col("pickup_datetime")))


def app_kpi_scope(fhvhv: DataFrame) -> DataFrame:
    """F8: positive miles, fare and trip time."""
    return fhvhv.where((F.col("trip_miles") > 0) & (F.col("base_passenger_fare") > 0) & (F.col("trip_time") > 0))


KPI_COLUMNS = ["anio", "mes", "tipo_servicio", "total_viajes", "ingreso_bruto_total", "tarifa_base_promedio",
               "propina_total", "propina_promedio", "porcentaje_propina", "peajes_total",
               "recargo_congestion_total", "distancia_promedio_millas", "duracion_promedio_min",
               "tarifa_promedio_por_milla", "pago_conductor_total", "pago_conductor_promedio_viaje"]


def taxi_kpis(taxi: DataFrame) -> DataFrame:
    null_d = F.lit(None).cast("double")
    return (taxi_kpi_scope(taxi)
            .groupBy("anio", "mes", F.col("tipo_taxi").alias("tipo_servicio"))
            .agg(F.count(F.lit(1)).alias("total_viajes"),
                 round2(nz_sum("total_amount")).alias("ingreso_bruto_total"),
                 round2(mean("fare_amount")).alias("tarifa_base_promedio"),
                 round2(nz_sum("tip_amount")).alias("propina_total"),
                 round2(mean("tip_amount")).alias("propina_promedio"),
                 round2(ratio(F.sum(exact("tip_amount")), F.sum(exact("fare_amount")), 100.0)).alias("porcentaje_propina"),
                 round2(nz_sum("tolls_amount")).alias("peajes_total"),
                 round2(nz_sum("congestion_surcharge")).alias("recargo_congestion_total"),
                 round2(mean("trip_distance")).alias("distancia_promedio_millas"),
                 round2(_minutes_mean(trip_seconds())).alias("duracion_promedio_min"),
                 round2(ratio(F.sum(exact("fare_amount")), F.sum(exact("trip_distance")))).alias("tarifa_promedio_por_milla"),
                 null_d.alias("pago_conductor_total"),
                 null_d.alias("pago_conductor_promedio_viaje"))
            .select(*KPI_COLUMNS))


def app_kpis(fhvhv: DataFrame) -> DataFrame:
    return (app_kpi_scope(fhvhv)
            .groupBy("anio", "mes")
            .agg(F.count(F.lit(1)).alias("total_viajes"),
                 round2(nz_sum(gross_amount())).alias("ingreso_bruto_total"),
                 round2(mean("base_passenger_fare")).alias("tarifa_base_promedio"),
                 round2(nz_sum("tips")).alias("propina_total"),
                 round2(mean("tips")).alias("propina_promedio"),
                 round2(ratio(F.sum(exact("tips")), F.sum(exact("base_passenger_fare")), 100.0)).alias("porcentaje_propina"),
                 round2(nz_sum("tolls")).alias("peajes_total"),
                 round2(nz_sum("congestion_surcharge")).alias("recargo_congestion_total"),
                 round2(mean("trip_miles")).alias("distancia_promedio_millas"),
                 round2(_minutes_mean(F.col("trip_time"))).alias("duracion_promedio_min"),
                 round2(ratio(F.sum(exact("base_passenger_fare")), F.sum(exact("trip_miles")))).alias("tarifa_promedio_por_milla"),
                 round2(nz_sum("driver_pay")).alias("pago_conductor_total"),
                 round2(mean("driver_pay")).alias("pago_conductor_promedio_viaje"))
            .withColumn("tipo_servicio", F.lit("fhvhv"))
            .select(*KPI_COLUMNS))


def financial_kpis(taxi: DataFrame, fhvhv: DataFrame) -> DataFrame:
    return taxi_kpis(taxi).unionByName(app_kpis(fhvhv))


# --------------------------------------------------------------------------- territorial demand
def demand_trips(taxi: DataFrame, fhvhv: DataFrame, min_taxi_anio: str = DEMAND_TAXI_MIN_ANIO,
                 extra=()) -> DataFrame:
    """Row-level union: anio, [extra...], tipo_servicio, pulocationid, dolocationid, millas, monto."""
    both_ids = F.col("pulocationid").isNotNull() & F.col("dolocationid").isNotNull()
    t = (taxi.where((F.col("anio") >= F.lit(min_taxi_anio)) & both_ids)
             .select("anio", *extra, F.col("tipo_taxi").alias("tipo_servicio"), "pulocationid", "dolocationid",
                     F.col("trip_distance").cast("double").alias("millas"),
                     F.col("total_amount").alias("monto")))
    h = (fhvhv.where(both_ids)
              .select("anio", *extra, F.lit("fhvhv").alias("tipo_servicio"), "pulocationid", "dolocationid",
                      F.col("trip_miles").cast("double").alias("millas"), gross_amount().alias("monto")))
    return t.unionByName(h)


def demand_by_ids(trips: DataFrame, extra=(), exact: str | None = None) -> DataFrame:
    """Pre-aggregation before the zone join: at most ids^2 rows per (year, service).  Carries sums and counts.

    ``exact`` names a decimal type to sum in (used by the monthly state, so merges are exact).
    """
    def s(c):
        return F.sum(F.col(c).try_cast(exact) if exact else F.col(c))
    return (trips.groupBy("anio", *extra, "tipo_servicio", "pulocationid", "dolocationid")
                 .agg(F.count(F.lit(1)).alias("n"),
                      s("millas").alias("s_millas"),
                      F.count(F.col("millas").try_cast(exact) if exact else F.col("millas")).alias("c_millas"),
                      s("monto").alias("s_monto")))


def zone_labels(zones: DataFrame, prefix: str) -> DataFrame:
    return zones.select(F.col("locationid").try_cast("bigint").alias(f"{prefix}_id"),
                        F.col("borough").alias(f"{prefix}_borough_raw"), F.col("zone").alias(f"{prefix}_zone_raw"))


def label_demand(by_ids: DataFrame, zones: DataFrame, extra=()) -> DataFrame:
    """Two left joins to the lookup (broadcast while it is below Spark's threshold), then re-group by label.

    Several ids may share a label and unmatched ids collapse to 'Unknown', so the
    re-aggregation adds the carried sums and counts; averages are finalised last.
    Duplicated lookup ids multiply rows exactly as the row-level join would.
    """
    pu, do = zone_labels(zones, "pu"), zone_labels(zones, "do")
    j = (by_ids.join(pu, by_ids.pulocationid == pu.pu_id, "left")
               .join(do, by_ids.dolocationid == do.do_id, "left"))
    unknown = F.lit("Unknown")
    return (j.groupBy("anio", *extra, "tipo_servicio",
                      F.coalesce("pu_borough_raw", unknown).alias("pu_borough"),
                      F.coalesce("pu_zone_raw", unknown).alias("pu_zone"),
                      F.coalesce("do_borough_raw", unknown).alias("do_borough"),
                      F.coalesce("do_zone_raw", unknown).alias("do_zone"))
             .agg(F.sum("n").cast("bigint").alias("total_viajes"),
                  F.sum("s_millas").alias("s_millas"), F.sum("c_millas").cast("bigint").alias("c_millas"),
                  F.sum("s_monto").alias("s_monto")))


def finish_demand(labelled: DataFrame) -> DataFrame:
    return labelled.select("anio", "tipo_servicio", "pu_borough", "pu_zone", "do_borough", "do_zone",
                           "total_viajes",
                           round2(ratio("s_millas", "c_millas")).alias("distancia_promedio_millas"),
                           round2(F.col("s_monto").cast("double")).alias("monto_total"))


def territorial_demand(taxi: DataFrame, fhvhv: DataFrame, zones: DataFrame,
                       min_taxi_anio: str = DEMAND_TAXI_MIN_ANIO) -> DataFrame:
    return finish_demand(label_demand(demand_by_ids(demand_trips(taxi, fhvhv, min_taxi_anio)), zones))


# --------------------------------------------------------------------------- temporal patterns
def temporal_trips(taxi: DataFrame, fhvhv: DataFrame) -> DataFrame:
    def shape(df, service, fare, dist):
        return (df.where(F.col("pickup_datetime").isNotNull() & (F.col(dist) > 0) & (F.col(fare) > 0))
                  .select("anio", "mes", *[c for c in ("_pu",) if c in df.columns], service.alias("tipo_servicio"),
                          iso_weekday("pickup_datetime").alias("dia_semana_num"),
                          weekday_name("pickup_datetime").alias("dia_semana_nombre"),
                          F.hour("pickup_datetime").cast("bigint").alias("hora_dia"),
                          F.col(fare).alias("tarifa"), F.col(dist).cast("double").alias("distancia")))
    return (shape(taxi, F.col("tipo_taxi"), "fare_amount", "trip_distance")
            .unionByName(shape(fhvhv, F.lit("fhvhv"), "base_passenger_fare", "trip_miles")))


TEMPORAL_KEYS = ["anio", "tipo_servicio", "dia_semana_num", "dia_semana_nombre", "hora_dia"]


def temporal_state(trips: DataFrame, keys=TEMPORAL_KEYS) -> DataFrame:
    return trips.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_viajes"),
                                    F.sum("tarifa").alias("s_tarifa"), F.count("tarifa").alias("c_tarifa"),
                                    F.sum("distancia").alias("s_distancia"), F.count("distancia").alias("c_distancia"))


def finish_temporal(state: DataFrame) -> DataFrame:
    return state.select(*TEMPORAL_KEYS, F.col("total_viajes").cast("bigint").alias("total_viajes"),
                        round2(ratio("s_tarifa", "c_tarifa")).alias("tarifa_promedio"),
                        round2(ratio("s_distancia", "c_distancia")).alias("distancia_promedio_millas"))


def temporal_patterns(taxi: DataFrame, fhvhv: DataFrame) -> DataFrame:
    return finish_temporal(temporal_state(temporal_trips(taxi, fhvhv)))


# --------------------------------------------------------------------------- presentation (O1, O2)
def presented(df: DataFrame, mart: str) -> DataFrame:
    """Sort a (small) mart for display; table row order is not a contract, so writes skip this."""
    return df.orderBy(*ORDER[mart])


def build_all(taxi: DataFrame, fhvhv: DataFrame, fhv: DataFrame, zones: DataFrame) -> dict[str, DataFrame]:
    return {"mart_cuota_mercado_mensual": market_share(taxi, fhvhv, fhv),
            "mart_kpis_financieros": financial_kpis(taxi, fhvhv),
            "mart_demanda_territorial": territorial_demand(taxi, fhvhv, zones),
            "mart_patrones_temporales": temporal_patterns(taxi, fhvhv)}
