"""DuckDB oracle SQL for every registered query (tables pre-registered as views by the checker).

The trip views are the DuckDB spelling of ``triplake.sources.adapter``.  Marts are written the
reference way (row-level joins, then GROUP BY) so they also check our pre-aggregation
rewrites.  Rounding is ``floor(x*100+0.5)/100`` on doubles and averages are SUM/COUNT, the
same arithmetic as ``triplake.functions.numeric``.
"""

from __future__ import annotations

import re

TRIPS_TAXI = """
trips_taxi AS (
  SELECT l.l_orderkey AS trip_key, CAST(l.l_linenumber AS BIGINT) AS trip_line, l.l_suppkey % 7 AS vendorid,
    CASE WHEN l.l_linestatus = 'F' THEN 'yellow' ELSE 'green' END AS tipo_taxi,
    CASE l.l_suppkey % 7 WHEN 1 THEN 'CMT' WHEN 2 THEN 'vts' WHEN 3 THEN 'XYZ' ELSE CAST(l.l_suppkey % 7 AS VARCHAR) END AS vendor_raw,
    CASE WHEN l.l_returnflag = 'A' THEN 'CAS' WHEN l.l_returnflag = 'R' THEN 'Credit'
      WHEN l.l_linenumber = 1 THEN 'NO CHARGE' WHEN l.l_linenumber = 2 THEN 'Dispute'
      WHEN l.l_linenumber = 3 THEN 'UNK' WHEN l.l_linenumber = 4 THEN '0' ELSE '1.0' END AS payment_type_raw,
    o.o_orderdate + INTERVAL 16 YEAR AS pickup_datetime,
    l.l_shipdate + INTERVAL 16 YEAR AS dropoff_datetime,
    CASE WHEN l.l_quantity <> 50 THEN l.l_quantity - 1 END AS trip_distance,
    CAST(CASE WHEN (l.l_returnflag = 'R' AND l.l_linenumber = 7) OR (l.l_returnflag = 'A' AND l.l_linenumber = 6)
      THEN -1 ELSE 1 END * l.l_extendedprice AS DECIMAL(18,2)) AS fare_amount,
    CAST(ROUND(l.l_extendedprice * l.l_discount) AS DECIMAL(18,2)) AS tip_amount,
    CAST(ROUND(l.l_extendedprice * l.l_tax) AS DECIMAL(18,2)) AS tolls_amount,
    CAST(CASE WHEN l.l_linenumber % 2 = 0 THEN 2.50 ELSE NULL END AS DECIMAL(18,2)) AS congestion_surcharge,
    CAST(ROUND(l.l_extendedprice * (1 + l.l_discount + l.l_tax)) AS DECIMAL(18,2)) AS total_amount,
    CAST(CASE WHEN s.s_nationkey = 23 THEN 265 WHEN s.s_nationkey = 22 AND l.l_linenumber = 3 THEN NULL
      ELSE s.s_nationkey END AS BIGINT) AS pulocationid,
    CAST(CASE WHEN c.c_nationkey = 24 THEN 264 ELSE c.c_nationkey END AS BIGINT) AS dolocationid,
    CAST(year(o.o_orderdate + INTERVAL 16 YEAR) AS VARCHAR) AS anio,
    lpad(CAST(month(o.o_orderdate + INTERVAL 16 YEAR) AS VARCHAR), 2, '0') AS mes
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN customer c ON o.o_custkey = c.c_custkey
)"""

TRIPS_FHVHV = """
trips_fhvhv AS (
  SELECT event_id,
    CASE user_id % 3 WHEN 0 THEN 'HV0003' WHEN 1 THEN 'HV0004' ELSE 'HV0005' END AS hvfhs_license_num,
    event_type AS dispatching_base_num,
    ts AS pickup_datetime, ts + to_seconds(user_id % 40 * 60 - 180) AS dropoff_datetime,
    CAST(user_id % 40 * 60 - 180 AS BIGINT) AS trip_time,
    CAST(CAST(ROUND(value * 100) AS BIGINT) % 97 AS DOUBLE) AS trip_miles,
    CAST(value AS DECIMAL(18,2)) AS base_passenger_fare,
    CAST(0 AS DECIMAL(18,2)) AS tolls, CAST(0 AS DECIMAL(18,2)) AS bcf, CAST(0 AS DECIMAL(18,2)) AS sales_tax,
    CAST(0 AS DECIMAL(18,2)) AS congestion_surcharge,
    CAST(CASE WHEN user_id % 5 <> 0 THEN 1.25 END AS DECIMAL(18,2)) AS airport_fee,
    CAST(user_id % 4 AS DECIMAL(18,2)) AS tips,
    CAST(CASE WHEN user_id % 3 = 1 THEN 0 ELSE value END AS DECIMAL(18,2)) AS driver_pay,
    user_id % 26 AS pulocationid, event_id % 26 AS dolocationid,
    CAST(year(ts) AS VARCHAR) AS anio, lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS mes
  FROM events
)"""

TRIPS_FHV = """
trips_fhv AS (
  SELECT event_id, event_type AS dispatching_base_num, ts AS pickup_datetime,
    CASE user_id % 4 WHEN 0 THEN CAST('1989-01-01 00:00:00' AS TIMESTAMP) WHEN 1 THEN NULL
      ELSE ts + to_seconds(user_id % 40 * 60 - 180) END AS dropoff_datetime,
    CASE WHEN user_id % 6 <> 0 THEN user_id % 26 END AS pulocationid, event_id % 26 AS dolocationid,
    CAST(year(ts) AS VARCHAR) AS anio, lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS mes
  FROM events
)"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS locationid, r_name AS borough, n_name AS zone,
    CASE WHEN n_nationkey % 10 = 0 THEN 'Airports' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def with_views(body: str, *views: str) -> str:
    """Prefix the needed trip views.  ``body`` may start with more CTEs: ``name AS (...) SELECT ...``."""
    if re.match(r"\s*\w+ AS \(", body):
        return "WITH " + ",".join(views) + ",\n" + body
    return "WITH " + ",".join(views) + "\n" + body


def r2(expr: str) -> str:
    """Round to 2 decimals, halves away from zero, on the double value (same arithmetic as the library)."""
    x = f"CAST({expr} AS DOUBLE)"
    return (f"(CASE WHEN {x} < 0 THEN -CAST(floor(-{x} * 100 + 0.5) AS BIGINT) "
            f"ELSE CAST(floor({x} * 100 + 0.5) AS BIGINT) END) / 100.0::DOUBLE")


def avg_(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DOUBLE) / NULLIF(COUNT({expr}), 0)"


def ratio_(num: str, den: str, scale: str = "") -> str:
    pre = f"{scale} * " if scale else ""
    return f"{pre}CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


GROSS = "(base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge + airport_fee + tips)"

MARKET_SHARE = with_views(f"""
counts AS (
  SELECT anio, mes, tipo_taxi AS tipo_servicio, COUNT(*) AS total_viajes FROM trips_taxi GROUP BY anio, mes, tipo_taxi
  UNION ALL SELECT anio, mes, 'fhvhv', COUNT(*) FROM trips_fhvhv GROUP BY anio, mes
  UNION ALL SELECT anio, mes, 'fhv', COUNT(*) FROM trips_fhv GROUP BY anio, mes
), totals AS (
  SELECT *, CAST(SUM(total_viajes) OVER (PARTITION BY anio, mes) AS BIGINT) AS total_viajes_mes FROM counts
)
SELECT anio, mes, tipo_servicio, total_viajes, total_viajes_mes,
  {r2(ratio_('total_viajes', 'total_viajes_mes', '100.0::DOUBLE'))} AS cuota_mercado_pct
FROM totals""", TRIPS_TAXI, TRIPS_FHVHV, TRIPS_FHV)


def _kpi_taxi(where_extra: str = "") -> str:
    return f"""
SELECT anio, mes, tipo_taxi AS tipo_servicio, COUNT(*) AS total_viajes,
  {r2('SUM(total_amount)')} AS ingreso_bruto_total,
  {r2(avg_('fare_amount'))} AS tarifa_base_promedio,
  {r2('SUM(tip_amount)')} AS propina_total,
  {r2(avg_('tip_amount'))} AS propina_promedio,
  {r2(ratio_('SUM(tip_amount)', 'SUM(fare_amount)', '100.0::DOUBLE'))} AS porcentaje_propina,
  {r2('SUM(tolls_amount)')} AS peajes_total,
  {r2('SUM(congestion_surcharge)')} AS recargo_congestion_total,
  {r2(avg_('trip_distance'))} AS distancia_promedio_millas,
  {r2(avg_("date_diff('second', pickup_datetime, dropoff_datetime)") + ' / 60.0::DOUBLE')} AS duracion_promedio_min,
  {r2(ratio_('SUM(fare_amount)', 'SUM(trip_distance)'))} AS tarifa_promedio_por_milla,
  CAST(NULL AS DOUBLE) AS pago_conductor_total, CAST(NULL AS DOUBLE) AS pago_conductor_promedio_viaje
FROM trips_taxi
WHERE trip_distance > 0 AND fare_amount > 0 AND total_amount > 0 AND dropoff_datetime >= pickup_datetime {where_extra}
GROUP BY anio, mes, tipo_taxi"""


def _kpi_app(where_extra: str = "") -> str:
    return f"""
SELECT anio, mes, 'fhvhv' AS tipo_servicio, COUNT(*) AS total_viajes,
  {r2(f'SUM({GROSS})')} AS ingreso_bruto_total,
  {r2(avg_('base_passenger_fare'))} AS tarifa_base_promedio,
  {r2('SUM(tips)')} AS propina_total,
  {r2(avg_('tips'))} AS propina_promedio,
  {r2(ratio_('SUM(tips)', 'SUM(base_passenger_fare)', '100.0::DOUBLE'))} AS porcentaje_propina,
  {r2('SUM(tolls)')} AS peajes_total,
  {r2('SUM(congestion_surcharge)')} AS recargo_congestion_total,
  {r2(avg_('trip_miles'))} AS distancia_promedio_millas,
  {r2(avg_('trip_time') + ' / 60.0::DOUBLE')} AS duracion_promedio_min,
  {r2(ratio_('SUM(base_passenger_fare)', 'SUM(trip_miles)'))} AS tarifa_promedio_por_milla,
  {r2('SUM(driver_pay)')} AS pago_conductor_total,
  {r2(avg_('driver_pay'))} AS pago_conductor_promedio_viaje
FROM trips_fhvhv
WHERE trip_miles > 0 AND base_passenger_fare > 0 AND trip_time > 0 {where_extra}
GROUP BY anio, mes"""


FINANCIAL_KPIS = with_views(_kpi_taxi() + "\nUNION ALL\n" + _kpi_app(), TRIPS_TAXI, TRIPS_FHVHV)
APP_KPIS = with_views(_kpi_app(), TRIPS_FHVHV)

TERRITORIAL = with_views(f"""
v AS (
  SELECT anio, tipo_taxi AS tipo_servicio, pulocationid, dolocationid, trip_distance AS millas, total_amount AS monto
  FROM trips_taxi WHERE anio >= '2016' AND pulocationid IS NOT NULL AND dolocationid IS NOT NULL
  UNION ALL
  SELECT anio, 'fhvhv', pulocationid, dolocationid, trip_miles, {GROSS}
  FROM trips_fhvhv WHERE pulocationid IS NOT NULL AND dolocationid IS NOT NULL
)
SELECT v.anio, v.tipo_servicio,
  COALESCE(pu.borough, 'Unknown') AS pu_borough, COALESCE(pu.zone, 'Unknown') AS pu_zone,
  COALESCE(dz.borough, 'Unknown') AS do_borough, COALESCE(dz.zone, 'Unknown') AS do_zone,
  COUNT(*) AS total_viajes,
  {r2(avg_('v.millas'))} AS distancia_promedio_millas,
  {r2('SUM(v.monto)')} AS monto_total
FROM v
LEFT JOIN zones pu ON v.pulocationid = TRY_CAST(pu.locationid AS BIGINT)
LEFT JOIN zones dz ON v.dolocationid = TRY_CAST(dz.locationid AS BIGINT)
GROUP BY 1, 2, 3, 4, 5, 6""", TRIPS_TAXI, TRIPS_FHVHV, ZONES)

TEMPORAL = with_views(f"""
u AS (
  SELECT anio, tipo_taxi AS tipo_servicio, pickup_datetime, fare_amount AS tarifa, trip_distance AS distancia
  FROM trips_taxi WHERE pickup_datetime IS NOT NULL AND trip_distance > 0 AND fare_amount > 0
  UNION ALL
  SELECT anio, 'fhvhv', pickup_datetime, base_passenger_fare, trip_miles
  FROM trips_fhvhv WHERE pickup_datetime IS NOT NULL AND trip_miles > 0 AND base_passenger_fare > 0
)
SELECT anio, tipo_servicio, CAST(isodow(pickup_datetime) AS BIGINT) AS dia_semana_num,
  dayname(pickup_datetime) AS dia_semana_nombre, CAST(hour(pickup_datetime) AS BIGINT) AS hora_dia,
  COUNT(*) AS total_viajes, {r2(avg_('tarifa'))} AS tarifa_promedio, {r2(avg_('distancia'))} AS distancia_promedio_millas
FROM u GROUP BY 1, 2, 3, 4, 5""", TRIPS_TAXI, TRIPS_FHVHV)

ORACLE: dict[str, str] = {
    "market_share_monthly": MARKET_SHARE,
    "financial_kpis_monthly": FINANCIAL_KPIS,
    "app_kpis_monthly": APP_KPIS,
    "territorial_demand": TERRITORIAL,
    "temporal_patterns": TEMPORAL,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# ------------------------------------------------------------------ normalisation, rules, dedup
def SL(x: str) -> str:
    """safe bigint: text -> double -> truncate toward zero -> bigint; NULL when malformed or out of range."""
    return f"TRY_CAST(trunc(TRY_CAST(CAST({x} AS VARCHAR) AS DOUBLE)) AS BIGINT)"


def SD(x: str) -> str:
    return f"TRY_CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def PAY(x: str) -> str:
    u = f"upper(CAST({x} AS VARCHAR))"
    return (f"COALESCE(CASE WHEN {u} IN ('CAS','CASH') THEN 2 WHEN {u} IN ('CRD','CREDIT') THEN 1 "
            f"WHEN {u} IN ('NOC','NO CHARGE') THEN 3 WHEN {u} IN ('DIS','DISPUTE') THEN 4 END, {SL(x)})")


def VEND(x: str) -> str:
    u = f"upper(CAST({x} AS VARCHAR))"
    return f"COALESCE(CASE WHEN {u} = 'CMT' THEN 1 WHEN {u} = 'VTS' THEN 2 END, {SL(x)})"


def YW(lo: int, hi: int, c: str = "pickup_datetime") -> str:
    return f"COALESCE(year({c}) BETWEEN {lo} AND {hi}, false)"


def NN(c: str) -> str:
    return f"({c} IS NULL OR {c} >= 0)"


CHRONO = "COALESCE(dropoff_datetime >= pickup_datetime, false)"
CHRONO_NULLABLE = "COALESCE(dropoff_datetime IS NULL OR dropoff_datetime >= pickup_datetime, false)"
PLACEHOLDER_OK = "COALESCE(NOT (trip_distance = 0 AND pulocationid IN (264, 265)), false)"
WINDOW = {"yellow": (2009, 2026), "green": (2014, 2026), "fhv": (2015, 2026), "fhvhv": (2019, 2026)}

# normalised taxi rows (payment and vendor codes, money as double), fhv with the sentinel removed
TAXI_NORM = f"""
taxi_norm AS (
  SELECT trip_key, trip_line, tipo_taxi, anio, mes, {VEND('vendorid')} AS vendorid, pickup_datetime, dropoff_datetime,
    {PAY('payment_type_raw')} AS payment_type, {SD('fare_amount')} AS fare_amount, {SD('trip_distance')} AS trip_distance,
    {SD('tip_amount')} AS tip_amount, {SD('tolls_amount')} AS tolls_amount, {SD('total_amount')} AS total_amount,
    {SD('congestion_surcharge')} AS congestion_surcharge, pulocationid, dolocationid, CAST(NULL AS BIGINT) AS ratecodeid
  FROM trips_taxi
)"""
FHV_NORM = """
fhv_norm AS (
  SELECT event_id, anio, mes, dispatching_base_num, pickup_datetime,
    NULLIF(dropoff_datetime, TIMESTAMP '1989-01-01 00:00:00') AS dropoff_datetime, pulocationid, dolocationid
  FROM trips_fhv
)"""


def _reason(fmt: str) -> str:
    lo, hi = WINDOW[fmt]
    chain = [("dropoff_before_pickup", CHRONO_NULLABLE if fmt == "fhv" else CHRONO),
             ("pickup_year_out_of_range", YW(lo, hi))]
    if fmt in ("yellow", "green"):
        chain += [("negative_fare", f"COALESCE({NN('fare_amount')}, false)"),
                  ("negative_distance", f"COALESCE({NN('trip_distance')}, false)")]
    if fmt == "green":
        chain += [("placeholder_unknown_zone", PLACEHOLDER_OK)]
    if fmt == "fhvhv":
        chain += [("negative_trip_miles", f"COALESCE({NN('trip_miles')}, false)"),
                  ("negative_trip_time", f"COALESCE({NN('trip_time')}, false)"),
                  ("negative_base_fare", f"COALESCE({NN('base_passenger_fare')}, false)")]
    return "CASE " + " ".join(f"WHEN NOT {p} THEN '{n}'" for n, p in chain) + " END"


CAST_TEXT = """CASE l_linenumber WHEN 1 THEN CAST(l_partkey AS VARCHAR) WHEN 2 THEN CAST(l_partkey AS VARCHAR) || '.0'
  WHEN 3 THEN CAST(l_partkey AS VARCHAR) || '.7' WHEN 4 THEN '-' || CAST(l_partkey AS VARCHAR) || '.5'
  WHEN 5 THEN 'UNK' WHEN 6 THEN '' WHEN 7 THEN CAST(l_partkey AS VARCHAR) || 'e30' END"""

LEGACY = f"""
legacy AS (
  SELECT vendor_raw AS vendor_name, CAST(pickup_datetime AS VARCHAR) AS trip_pickup_datetime,
    CAST(dropoff_datetime AS VARCHAR) AS trip_dropoff_datetime, trip_line AS passenger_count, trip_distance,
    payment_type_raw AS payment_type, fare_amount AS fare_amt, tip_amount AS tip_amt, tolls_amount AS tolls_amt,
    total_amount AS total_amt, congestion_surcharge AS surcharge, CAST(pulocationid AS DOUBLE) AS pulocationid,
    dolocationid, 'N' AS store_and_forward, trip_key, trip_line
  FROM trips_taxi
)"""

CANONICAL = with_views(LEGACY.strip() + f"""
SELECT {VEND('vendor_name')} AS vendorid,
  TRY_CAST(trip_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
  TRY_CAST(trip_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
  {SL('passenger_count')} AS passenger_count, {SD('trip_distance')} AS trip_distance,
  CAST(NULL AS DOUBLE) AS pickup_longitude, CAST(NULL AS DOUBLE) AS pickup_latitude,
  CAST(NULL AS BIGINT) AS ratecodeid, CAST(store_and_forward AS VARCHAR) AS store_and_fwd_flag,
  CAST(NULL AS DOUBLE) AS dropoff_longitude, CAST(NULL AS DOUBLE) AS dropoff_latitude,
  {PAY('payment_type')} AS payment_type, {SD('fare_amt')} AS fare_amount, {SD('surcharge')} AS extra,
  CAST(NULL AS DOUBLE) AS mta_tax, {SD('tip_amt')} AS tip_amount, {SD('tolls_amt')} AS tolls_amount,
  {SD('total_amt')} AS total_amount, {SL('pulocationid')} AS pulocationid, {SL('dolocationid')} AS dolocationid,
  CAST(NULL AS BIGINT) AS trip_type, CAST(NULL AS DOUBLE) AS improvement_surcharge,
  CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee, CAST(NULL AS DOUBLE) AS ehail_fee,
  trip_key, trip_line
FROM legacy""", TRIPS_TAXI)

DEDUP_TAXI_KEY = {"yellow": "vendorid, pickup_datetime, dropoff_datetime, fare_amount",
                  "green": "vendorid, pickup_datetime, dropoff_datetime, pulocationid, dolocationid, fare_amount"}


def _dedup_taxi(tipo: str) -> str:
    return with_views(f"""
SELECT trip_key, trip_line, anio, mes, vendorid, pickup_datetime, dropoff_datetime, pulocationid, dolocationid,
  CAST(fare_amount AS DOUBLE) AS fare_amount
FROM trips_taxi WHERE tipo_taxi = '{tipo}'
QUALIFY row_number() OVER (PARTITION BY {DEDUP_TAXI_KEY[tipo]}, anio, mes ORDER BY trip_key, trip_line) = 1""",
                      TRIPS_TAXI)


def _taxi_flags_select() -> str:
    vend = " ".join(f"WHEN vendorid = {k} THEN '{v}'" for k, v in
                    [(1, "CMT"), (2, "VeriFone"), (3, "Unofficial 3"), (4, "Unofficial 4"), (5, "Unofficial 5"),
                     (6, "Unofficial 6"), (7, "Unofficial 7")])
    parts = ["fare_amount", "NULL", "NULL", "tip_amount", "tolls_amount", "NULL", "congestion_surcharge", "NULL"]
    total = " + ".join(f"COALESCE(CAST({p} AS DOUBLE), 0.0::DOUBLE)" for p in parts)
    return f"""
SELECT trip_key, trip_line, tipo_taxi AS formato, COALESCE(fare_amount < 0, false) AS is_reversal,
  CASE WHEN payment_type = 0 THEN 'Flex Fare' END AS payment_label,
  {total} AS calculated_total,
  CASE {vend} WHEN vendorid IS NOT NULL THEN 'Other' END AS vendor_label,
  COALESCE(pulocationid, 264) AS pulocationid_filled, COALESCE(dolocationid, 264) AS dolocationid_filled
FROM taxi_norm"""


def _clean_taxi(tipo: str) -> str:
    lo, hi = WINDOW[tipo]
    rules = [CHRONO, YW(lo, hi), f"COALESCE({NN('fare_amount')}, false)", f"COALESCE({NN('trip_distance')}, false)"]
    if tipo == "green":
        rules.append(PLACEHOLDER_OK)
    return f"""
SELECT trip_key, trip_line, tipo_taxi, anio, mes, vendorid, pickup_datetime, dropoff_datetime, payment_type,
  fare_amount, trip_distance, pulocationid, dolocationid
FROM taxi_norm WHERE tipo_taxi = '{tipo}' AND {' AND '.join(rules)}
QUALIFY row_number() OVER (PARTITION BY {DEDUP_TAXI_KEY[tipo]}, anio, mes ORDER BY trip_key, trip_line) = 1"""


ORACLE.update({
    "clean_chronology": with_views(f"""
SELECT trip_key, trip_line, tipo_taxi, pickup_datetime, dropoff_datetime FROM trips_taxi WHERE dropoff_datetime >= pickup_datetime""",
                                   TRIPS_TAXI),
    "clean_chronology_nullable": with_views(FHV_NORM.strip() + """
SELECT event_id, pickup_datetime, dropoff_datetime FROM fhv_norm
WHERE dropoff_datetime IS NULL OR dropoff_datetime >= pickup_datetime""", TRIPS_FHV),
    "clean_year_window": with_views(f"""
SELECT tipo_taxi AS formato, CAST(trip_key AS VARCHAR) || ':' || CAST(trip_line AS VARCHAR) AS trip_id, anio
FROM trips_taxi WHERE (tipo_taxi = 'yellow' AND {YW(2009, 2026)}) OR (tipo_taxi = 'green' AND {YW(2014, 2026)})
UNION ALL SELECT 'fhvhv', CAST(event_id AS VARCHAR), anio FROM trips_fhvhv WHERE {YW(2019, 2026)}
UNION ALL SELECT 'fhv', CAST(event_id AS VARCHAR), anio FROM trips_fhv WHERE {YW(2015, 2026)}""",
                                    TRIPS_TAXI, TRIPS_FHVHV, TRIPS_FHV),
    "clean_nonnegative": with_views(f"""
SELECT trip_key, trip_line, CAST(fare_amount AS DOUBLE) AS fare_amount, trip_distance FROM trips_taxi
WHERE {NN('fare_amount')} AND {NN('trip_distance')}""", TRIPS_TAXI),
    "clean_app_nonnegative": with_views(f"""
SELECT event_id, trip_miles, trip_time FROM trips_fhvhv
WHERE {NN('trip_miles')} AND {NN('trip_time')} AND {NN('base_passenger_fare')}""", TRIPS_FHVHV),
    "clean_placeholder_3vl": with_views("""
SELECT trip_key, trip_line, trip_distance, pulocationid FROM trips_taxi
WHERE tipo_taxi = 'green' AND NOT (trip_distance = 0 AND pulocationid IN (264, 265))""", TRIPS_TAXI),
    "safe_cast_matrix": f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {CAST_TEXT} AS raw_text,
  {SL(CAST_TEXT)} AS as_bigint, {SD(CAST_TEXT)} AS as_double
FROM lineitem""",
    "normalize_payment": with_views(f"""
SELECT trip_key, trip_line, payment_type_raw, {PAY('payment_type_raw')} AS payment_type FROM trips_taxi""", TRIPS_TAXI),
    "normalize_vendor": with_views(f"""
SELECT trip_key, trip_line, vendor_raw, {VEND('vendor_raw')} AS vendorid FROM trips_taxi""", TRIPS_TAXI),
    "canonical_schema": CANONICAL,
    "dedup_yellow": _dedup_taxi("yellow"),
    "dedup_green": _dedup_taxi("green"),
    "dedup_fhv": with_views(FHV_NORM.strip() + """
SELECT event_id, anio, mes, dispatching_base_num, pickup_datetime, dropoff_datetime, pulocationid, dolocationid
FROM fhv_norm
QUALIFY row_number() OVER (PARTITION BY dispatching_base_num, pickup_datetime, dropoff_datetime, pulocationid,
  dolocationid, anio, mes ORDER BY event_id) = 1""", TRIPS_FHV),
    "dedup_fhvhv": with_views("""
SELECT event_id, anio, mes, hvfhs_license_num, dispatching_base_num, pickup_datetime, dropoff_datetime,
  pulocationid, dolocationid
FROM trips_fhvhv
QUALIFY row_number() OVER (PARTITION BY hvfhs_license_num, dispatching_base_num, pickup_datetime, dropoff_datetime,
  pulocationid, dolocationid, anio, mes ORDER BY event_id) = 1""", TRIPS_FHVHV),
    "quarantine_reasons": with_views(TAXI_NORM.strip() + ",\n" + FHV_NORM.strip() + f"""
, r AS (
  SELECT tipo_taxi AS formato, CASE tipo_taxi WHEN 'yellow' THEN {_reason('yellow')} ELSE {_reason('green')} END AS reject_reason
  FROM taxi_norm
  UNION ALL SELECT 'fhvhv', {_reason('fhvhv')} FROM trips_fhvhv
  UNION ALL SELECT 'fhv', {_reason('fhv')} FROM fhv_norm
)
SELECT formato, reject_reason, COUNT(*) AS filas FROM r WHERE reject_reason IS NOT NULL GROUP BY 1, 2""",
                                     TRIPS_TAXI, TRIPS_FHVHV, TRIPS_FHV),
    "rule_flags": with_views(TAXI_NORM.strip() + _taxi_flags_select(), TRIPS_TAXI),
    "rule_flags_app": with_views("""
SELECT event_id, hvfhs_license_num, hvfhs_license_num IN ('HV0004') AS zero_pay_allowed,
  COALESCE(driver_pay = 0 AND hvfhs_license_num NOT IN ('HV0004'), false) AS driver_pay_suspect,
  COALESCE(pulocationid, 264) AS pulocationid_filled, COALESCE(dolocationid, 264) AS dolocationid_filled
FROM trips_fhvhv""", TRIPS_FHVHV),
    "clean_taxi_staging": with_views(TAXI_NORM.strip() + _clean_taxi("yellow") + "\nUNION ALL" + _clean_taxi("green"),
                                     TRIPS_TAXI),
})


# ------------------------------------------------------------------ whole jobs (written, then read back)
def _staged_taxi(tipo: str) -> str:
    lo, hi = WINDOW[tipo]
    rules = [CHRONO, YW(lo, hi), f"COALESCE({NN('fare_amount')}, false)", f"COALESCE({NN('trip_distance')}, false)"]
    if tipo == "green":
        rules.append(PLACEHOLDER_OK)
    return f"""
SELECT tipo_taxi, anio, mes, vendorid, pickup_datetime, dropoff_datetime, payment_type, fare_amount, trip_distance,
  pulocationid, dolocationid
FROM taxi_norm WHERE tipo_taxi = '{tipo}' AND {' AND '.join(rules)}
QUALIFY row_number() OVER (PARTITION BY {DEDUP_TAXI_KEY[tipo]}, anio, mes ORDER BY trip_key, trip_line) = 1"""


ORACLE.update({
    "drifted_scan": with_views(f"""
SELECT trip_key, trip_line, anio AS source_anio, mes AS source_mes, {VEND('vendorid')} AS vendorid,
  pickup_datetime, dropoff_datetime, trip_line AS passenger_count, {PAY('payment_type_raw')} AS payment_type,
  CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge, pulocationid, dolocationid
FROM trips_taxi WHERE tipo_taxi = 'yellow'""", TRIPS_TAXI),
    "csv_zone_lookup": with_views("SELECT locationid, borough, zone, service_zone FROM zones", ZONES),
    "staging_roundtrip": with_views(TAXI_NORM.strip() + _staged_taxi("yellow") + "\nUNION ALL" + _staged_taxi("green"),
                                    TRIPS_TAXI),
    "staging_by_pickup": with_views(TAXI_NORM.strip() + f""", files AS (
  SELECT *, strftime(dropoff_datetime, '%Y-%m') AS origen FROM taxi_norm WHERE tipo_taxi = 'yellow'
)
SELECT tipo_taxi, anio, mes, vendorid, pickup_datetime, dropoff_datetime, payment_type, fare_amount, trip_distance,
  pulocationid, dolocationid
FROM files
WHERE {CHRONO} AND {YW(*WINDOW['yellow'])} AND COALESCE({NN('fare_amount')}, false) AND COALESCE({NN('trip_distance')}, false)
  AND (trip_line % 2 = 1 OR origen <> (SELECT MAX(origen) FROM files))
QUALIFY row_number() OVER (PARTITION BY {DEDUP_TAXI_KEY['yellow']}, origen ORDER BY trip_key, trip_line) = 1""",
                                    TRIPS_TAXI),
    "clean_one_period": with_views(TAXI_NORM.strip() + f""", staged AS ({_staged_taxi("yellow")}
UNION ALL {_staged_taxi("green")}
)
SELECT * FROM staged WHERE anio = '2013' AND mes = '03'""", TRIPS_TAXI),
    "mart_row_counts": " UNION ALL ".join(
        f"SELECT '{m}' AS mart, COUNT(*) AS escritas, COUNT(*) AS leidas FROM ({q})" for m, q in (
            ("mart_cuota_mercado_mensual", MARKET_SHARE), ("mart_kpis_financieros", FINANCIAL_KPIS),
            ("mart_demanda_territorial", TERRITORIAL), ("mart_patrones_temporales", TEMPORAL))),
    "mart_rebuild": MARKET_SHARE,
    "mart_rebuild_kpis": FINANCIAL_KPIS,
    "mart_incremental": TEMPORAL,
    "mart_incremental_share": MARKET_SHARE,
    "mart_incremental_kpis": FINANCIAL_KPIS,
    "mart_incremental_demand": TERRITORIAL,
    "stream_quarantine": with_views(FHV_NORM.strip() + f""", r AS (
  SELECT anio, mes, {_reason('fhv')} AS reject_reason FROM fhv_norm
)
SELECT anio, mes, reject_reason, COUNT(*) AS filas FROM r WHERE reject_reason IS NOT NULL GROUP BY 1, 2, 3""", TRIPS_FHV),
    "stream_merge": with_views(TAXI_NORM.strip() + "," + FHV_NORM + f""", published AS (
  SELECT 'yellow' AS formato, CAST(vendorid AS VARCHAR) AS clave, anio, mes, pickup_datetime, dropoff_datetime,
    {_reason('yellow')} AS reject_reason, fare_amount, CAST(NULL AS BIGINT) AS pulocationid,
    CAST(NULL AS BIGINT) AS dolocationid
  FROM taxi_norm WHERE tipo_taxi = 'yellow' AND (trip_line % 2 = 1
    OR anio || mes <> (SELECT MAX(anio || mes) FROM trips_taxi WHERE tipo_taxi = 'yellow'))
  UNION ALL
  SELECT 'fhv', dispatching_base_num, anio, mes, pickup_datetime, dropoff_datetime, {_reason('fhv')},
    CAST(NULL AS DOUBLE), pulocationid, dolocationid
  FROM fhv_norm WHERE event_id % 4 <> 3 OR anio || mes <> (SELECT MAX(anio || mes) FROM trips_fhv)
)
SELECT DISTINCT * FROM published WHERE reject_reason IS NULL
UNION ALL SELECT * FROM published WHERE reject_reason IS NOT NULL""", TRIPS_TAXI, TRIPS_FHV),
    "rerun_empty_period": with_views(TAXI_NORM.strip() + f""", staged AS ({_staged_taxi("yellow")}
)
SELECT * FROM staged
WHERE anio || mes <> (SELECT MAX(anio || mes) FROM trips_taxi WHERE tipo_taxi = 'yellow')""", TRIPS_TAXI),
    "rerun_unreadable_period": with_views(TAXI_NORM.strip() + _staged_taxi("yellow"), TRIPS_TAXI),
    "period_listings": with_views(TAXI_NORM.strip() + f""", staged AS ({_staged_taxi("yellow")}
)
SELECT DISTINCT 'raw ' || tipo_taxi AS listado, anio, mes FROM trips_taxi
UNION ALL SELECT DISTINCT 'raw fhv', anio, mes FROM trips_fhv
UNION ALL SELECT DISTINCT 'raw fhvhv', anio, mes FROM trips_fhvhv
UNION ALL SELECT DISTINCT 'staged yellow', anio, mes FROM staged
UNION ALL SELECT DISTINCT 'staged fhvhv', anio, mes FROM trips_fhvhv WHERE {_reason('fhvhv')} IS NULL""",
                                  TRIPS_TAXI, TRIPS_FHV, TRIPS_FHVHV),
    "drifted_scan_formats": with_views(FHV_NORM.strip() + """
SELECT tipo_taxi AS formato, anio AS source_anio, mes AS source_mes, pickup_datetime, dropoff_datetime, pulocationid,
  dolocationid, CAST(NULL AS DOUBLE) AS airport_fee, CAST(NULL AS VARCHAR) AS wav_match_flag FROM trips_taxi
UNION ALL SELECT 'fhv', anio, mes, pickup_datetime, dropoff_datetime, pulocationid, dolocationid, NULL, NULL FROM fhv_norm
UNION ALL SELECT 'fhvhv', anio, mes, pickup_datetime, dropoff_datetime, pulocationid, dolocationid,
  CASE WHEN event_id % 3 = 0 THEN trunc(CAST(airport_fee AS DOUBLE)) ELSE CAST(airport_fee AS DOUBLE) END,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 2 AS VARCHAR) WHEN event_id % 2 = 0 THEN 'Y' ELSE 'N' END
FROM trips_fhvhv""", TRIPS_TAXI, TRIPS_FHV, TRIPS_FHVHV),
    "stream_arrival": with_views(FHV_NORM.strip() + f"""
SELECT anio, mes, dispatching_base_num, pickup_datetime, dropoff_datetime, pulocationid, dolocationid,
  CAST(NULL AS BIGINT) AS sr_flag, CAST(NULL AS VARCHAR) AS affiliated_base_number
FROM fhv_norm WHERE {CHRONO_NULLABLE} AND {YW(2015, 2026)}
QUALIFY row_number() OVER (PARTITION BY dispatching_base_num, pickup_datetime, dropoff_datetime, pulocationid,
  dolocationid, anio, mes ORDER BY event_id) = 1""", TRIPS_FHV),
})


# ------------------------------------------------------------------ profiles, measures, views, questions, gaps
def CI(cond: str) -> str:
    return f"CAST(count_if({cond}) AS BIGINT)"


def _ranges(*cols: str) -> str:
    """Minimum, negative and zero counts of money columns."""
    return ", ".join(f"CAST(MIN({c}) AS DOUBLE) AS min_{c}, {CI(c + ' < 0')} AS negativos_{c}, {CI(c + ' = 0')} AS ceros_{c}"
                     for c in cols)


def RATE(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


def MEAN2(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


ALL_NORM = """
all_norm AS (
  SELECT tipo_taxi AS formato, anio, mes, pickup_datetime, dropoff_datetime, pulocationid, dolocationid FROM taxi_norm
  UNION ALL SELECT 'fhvhv', anio, mes, pickup_datetime, dropoff_datetime, pulocationid, dolocationid FROM trips_fhvhv
  UNION ALL SELECT 'fhv', anio, mes, pickup_datetime, dropoff_datetime, pulocationid, dolocationid FROM fhv_norm
)"""


def with_norm(body: str) -> str:
    return with_views(TAXI_NORM.strip() + ",\n" + FHV_NORM.strip() + ",\n" + ALL_NORM.strip() + ",\n" + body.strip(),
                      TRIPS_TAXI, TRIPS_FHVHV, TRIPS_FHV)


def _dup(fmt: str, src: str, keys: str) -> str:
    return f"""
SELECT '{fmt}' AS formato, anio, mes, CAST(SUM(n) AS BIGINT) AS filas, {CI('n > 1')} AS grupos_duplicados,
  MAX(n) AS max_repeticion, CAST(SUM(n - 1) AS BIGINT) AS filas_sobrantes, {RATE('SUM(n - 1)', 'SUM(n)')} AS tasa_duplicados
FROM (SELECT anio, mes, COUNT(*) AS n FROM {src} GROUP BY {keys}, anio, mes) k GROUP BY anio, mes"""


_GAP_PARTS = ["fare_amount", "NULL", "NULL", "tip_amount", "tolls_amount", "NULL", "congestion_surcharge", "NULL"]
_GAP = (f"CAST(total_amount AS DECIMAL(18,2)) - ("
        + " + ".join(f"COALESCE(CAST({p} AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)))" for p in _GAP_PARTS) + ")")

_LO = "CASE formato WHEN 'yellow' THEN 2009 WHEN 'green' THEN 2014 WHEN 'fhv' THEN 2015 WHEN 'fhvhv' THEN 2019 END"
_HI = "2026"

ORACLE.update({
    "profile_volume": with_norm("""
x AS (SELECT 1)
SELECT formato, COUNT(DISTINCT anio || '-' || mes) AS periodos, COUNT(*) AS filas,
  MIN(anio || '-' || mes) AS primer_periodo, MAX(anio || '-' || mes) AS ultimo_periodo
FROM all_norm GROUP BY formato"""),
    "profile_inverted_dates": with_norm(f"""
x AS (SELECT 1)
SELECT tipo_taxi AS formato, vendorid, anio, mes, COUNT(*) AS filas, {CI('dropoff_datetime < pickup_datetime')} AS invertidos,
  {RATE(CI('dropoff_datetime < pickup_datetime'), 'COUNT(*)')} AS tasa_invertidos
FROM taxi_norm GROUP BY 1, 2, 3, 4"""),
    "profile_sentinel": with_views(f"""
SELECT CAST(year(pickup_datetime) AS BIGINT) AS anio_pickup, COUNT(*) AS filas,
  {CI("dropoff_datetime = TIMESTAMP '1989-01-01 00:00:00'")} AS centinelas
FROM trips_fhv GROUP BY 1""", TRIPS_FHV),
    "profile_year_overflow": with_norm(f"""
g AS (SELECT formato, anio, CAST(year(dropoff_datetime) AS BIGINT) AS anio_real, COUNT(*) AS filas FROM all_norm GROUP BY 1, 2, 3)
SELECT formato, anio, anio_real, filas, anio_real = CAST(anio AS BIGINT) + 1 AS desborde,
  NOT COALESCE(anio_real BETWEEN {_LO} AND {_HI}, false) AS fuera_de_rango
FROM g WHERE anio_real IS NULL OR anio_real <> CAST(anio AS BIGINT)"""),
    "profile_year_overflow_pickup": with_norm(f"""
g AS (SELECT formato, anio, CAST(year(pickup_datetime) AS BIGINT) AS anio_real, COUNT(*) AS filas FROM all_norm GROUP BY 1, 2, 3)
SELECT formato, anio, anio_real, filas, anio_real = CAST(anio AS BIGINT) + 1 AS desborde,
  NOT COALESCE(anio_real BETWEEN {_LO} AND {_HI}, false) AS fuera_de_rango
FROM g WHERE anio_real IS NULL OR anio_real <> CAST(anio AS BIGINT)"""),
    "profile_duplicates": with_norm("x AS (SELECT 1)\n" + "\nUNION ALL".join([
        _dup("yellow", "(SELECT * FROM taxi_norm WHERE tipo_taxi = 'yellow')", DEDUP_TAXI_KEY["yellow"]),
        _dup("green", "(SELECT * FROM taxi_norm WHERE tipo_taxi = 'green')", DEDUP_TAXI_KEY["green"]),
        _dup("fhvhv", "trips_fhvhv", "hvfhs_license_num, dispatching_base_num, pickup_datetime, dropoff_datetime, "
                                     "pulocationid, dolocationid"),
        _dup("fhv", "fhv_norm", "dispatching_base_num, pickup_datetime, dropoff_datetime, pulocationid, dolocationid")])),
    "profile_amounts": with_norm(f"""
x AS (SELECT 1)
SELECT tipo_taxi AS formato, anio, MIN(fare_amount) AS min_fare_amount, {CI('fare_amount < 0')} AS negativos_fare_amount,
  {CI('fare_amount = 0')} AS ceros_fare_amount, MIN(total_amount) AS min_total_amount,
  {CI('total_amount < 0')} AS negativos_total_amount, {CI('total_amount = 0')} AS ceros_total_amount
FROM taxi_norm GROUP BY 1, 2"""),
    "profile_amount_parts": with_norm("x AS (SELECT 1)\nSELECT tipo_taxi AS formato, anio, " + _ranges(
        "tip_amount", "tolls_amount", "congestion_surcharge") + " FROM taxi_norm GROUP BY 1, 2"),
    "profile_app_amounts": with_views("SELECT 'fhvhv' AS formato, anio, " + _ranges(
        "base_passenger_fare", "tips", "airport_fee", "driver_pay") + " FROM trips_fhvhv GROUP BY 1, 2", TRIPS_FHVHV),
    "profile_negative_cash": with_norm("""
x AS (SELECT 1)
SELECT vendorid, anio, COUNT(*) AS reversos_efectivo FROM taxi_norm WHERE payment_type = 2 AND fare_amount < 0 GROUP BY 1, 2"""),
    "profile_negative_distance": with_norm(f"""
u AS (SELECT tipo_taxi AS formato, anio, trip_distance AS d FROM taxi_norm
      UNION ALL SELECT 'fhvhv', anio, trip_miles FROM trips_fhvhv)
SELECT formato, anio, {CI('d < 0')} AS distancias_negativas, COUNT(*) AS filas FROM u GROUP BY 1, 2"""),
    "profile_zero_driver_pay": with_views(f"""
SELECT hvfhs_license_num, COUNT(*) AS filas, {CI('driver_pay = 0')} AS pago_cero,
  CASE hvfhs_license_num WHEN 'HV0003' THEN 'Uber' WHEN 'HV0004' THEN 'Via' WHEN 'HV0005' THEN 'Lyft' ELSE 'Other' END AS plataforma,
  {RATE(CI('driver_pay = 0'), 'COUNT(*)')} AS tasa_pago_cero
FROM trips_fhvhv GROUP BY 1""", TRIPS_FHVHV),
    "profile_vendor_census": with_norm(f"""
x AS (SELECT 1)
SELECT tipo_taxi AS formato, vendorid, COUNT(*) AS filas, MIN(pickup_datetime) AS primer_viaje,
  MAX(pickup_datetime) AS ultimo_viaje, {CI('ratecodeid IS NULL')} AS nulos_ratecode,
  {CI('pulocationid IS NULL')} AS nulos_zona_origen, {RATE(CI('ratecodeid IS NULL'), 'COUNT(*)')} AS tasa_nulos_ratecode,
  {RATE(CI('pulocationid IS NULL'), 'COUNT(*)')} AS tasa_nulos_zona_origen
FROM taxi_norm GROUP BY 1, 2"""),
    "profile_flex_contingency": with_norm("""
x AS (SELECT 1)
SELECT ratecodeid IS NULL AS ratecode_nulo, COALESCE(payment_type = 0, false) AS pago_flex, COUNT(*) AS filas
FROM taxi_norm GROUP BY 1, 2"""),
    "profile_accounting_gap": with_norm(f"""
r AS (SELECT {_GAP} AS diferencia FROM taxi_norm),
c AS (SELECT diferencia, COUNT(*) AS viajes FROM r WHERE diferencia IS NOT NULL GROUP BY 1),
t AS (SELECT COUNT(*) AS total FROM r WHERE diferencia IS NOT NULL)
SELECT CAST(diferencia AS DOUBLE) AS diferencia, viajes, {RATE('viajes', 'total')} AS proporcion
FROM c, t ORDER BY viajes DESC, c.diferencia ASC LIMIT 10"""),
    "profile_unknown_zones": with_norm(f"""
x AS (SELECT 1)
SELECT formato, anio, COUNT(*) AS filas, {CI('pulocationid IS NULL OR pulocationid IN (264, 265)')} AS pu_desconocido,
  {CI('dolocationid IS NULL OR dolocationid IN (264, 265)')} AS do_desconocido,
  {RATE(CI('pulocationid IS NULL OR pulocationid IN (264, 265)'), 'COUNT(*)')} AS tasa_pu_desconocido,
  {RATE(CI('dolocationid IS NULL OR dolocationid IN (264, 265)'), 'COUNT(*)')} AS tasa_do_desconocido
FROM all_norm GROUP BY 1, 2"""),
})


def over(mart_sql: str, body: str, name: str, *extra_views: str) -> str:
    """Query over a mart computed by its oracle SQL (as CTE ``name``)."""
    pre = ("WITH " + ",".join(extra_views) + ",\n") if extra_views else "WITH "
    return f"{pre}{name} AS (\n{mart_sql}\n)\n{body}"


def _share_of_latest(service: str, years: str = "") -> str:
    return over(MARKET_SHARE, f"""
, l AS (SELECT MAX(anio) AS ultimo_anio FROM s {years})
SELECT '{service}' AS tipo_servicio, l.ultimo_anio, {MEAN2('cuota_mercado_pct')} / 100.0 AS cuota
FROM s, l WHERE s.anio = l.ultimo_anio AND s.tipo_servicio = '{service}' GROUP BY l.ultimo_anio""", "s")


ORACLE.update({
    "measure_total_trips": over(MARKET_SHARE, "SELECT CAST(SUM(total_viajes) AS BIGINT) AS total_viajes FROM s", "s"),
    "measure_app_share": _share_of_latest("fhvhv"),
    "measure_yellow_share": _share_of_latest("yellow"),
    "measure_yellow_share_last_present": _share_of_latest("yellow", "WHERE tipo_servicio = 'yellow'"),
    "measure_peak_month": over(MARKET_SHARE, """
, m AS (SELECT DISTINCT anio, mes, total_viajes_mes FROM s)
SELECT (SELECT MAX(total_viajes_mes) FROM m) AS viajes_mes_pico,
  (SELECT anio || '-' || mes FROM m ORDER BY total_viajes_mes DESC, anio DESC, mes DESC LIMIT 1) AS periodo_pico""", "s"),
    "measure_financial": over(FINANCIAL_KPIS, f"""
SELECT CAST(SUM(CAST(ingreso_bruto_total AS DECIMAL(18,2))) AS DOUBLE) AS facturacion_bruta,
  {MEAN2('tarifa_base_promedio')} AS tarifa_base_media, {MEAN2('porcentaje_propina')} / 100.0 AS propina_promedio,
  {MEAN2("CASE WHEN tipo_servicio = 'fhvhv' THEN pago_conductor_promedio_viaje END")} AS pago_conductor_promedio
FROM k""", "k"),
    "measure_top_pickup_borough": over(TERRITORIAL, f"""
, b AS (SELECT pu_borough, CAST(SUM(total_viajes) AS BIGINT) AS viajes FROM d GROUP BY 1),
t AS (SELECT SUM(total_viajes) AS total FROM d)
SELECT pu_borough, viajes, {RATE('viajes', 'total')} AS cuota FROM b, t ORDER BY viajes DESC, pu_borough LIMIT 1""", "d"),
    "measure_top_airport_corridor": over(TERRITORIAL, """
, a AS (SELECT DISTINCT zone AS do_zone FROM zones WHERE service_zone IN ('Airports', 'EWR'))
SELECT pu_borough, do_zone, CAST(SUM(total_viajes) AS BIGINT) AS viajes FROM d
WHERE do_zone IN (SELECT do_zone FROM a) GROUP BY 1, 2 ORDER BY viajes DESC, pu_borough, do_zone LIMIT 1""", "d",
                                         ZONES),
    "measure_peak_hour": over(TEMPORAL, """
, h AS (SELECT hora_dia, CAST(SUM(total_viajes) AS BIGINT) AS viajes FROM t GROUP BY 1)
SELECT hora_dia, viajes, printf('%02d:00 - %02d:00 hrs', hora_dia, (hora_dia + 1) % 24) AS franja
FROM h ORDER BY viajes DESC, hora_dia LIMIT 1""", "t"),
    "measure_peak_days": over(TEMPORAL, """
SELECT dia_semana_num, dia_semana_nombre, CAST(SUM(total_viajes) AS BIGINT) AS viajes FROM t GROUP BY 1, 2
ORDER BY viajes DESC, dia_semana_num LIMIT 2""", "t"),
    "view_share_over_time": over(MARKET_SHARE, """
SELECT anio, mes, MAX(CASE WHEN tipo_servicio = 'yellow' THEN cuota_mercado_pct END) AS yellow,
  MAX(CASE WHEN tipo_servicio = 'green' THEN cuota_mercado_pct END) AS green,
  MAX(CASE WHEN tipo_servicio = 'fhv' THEN cuota_mercado_pct END) AS fhv,
  MAX(CASE WHEN tipo_servicio = 'fhvhv' THEN cuota_mercado_pct END) AS fhvhv
FROM s GROUP BY 1, 2""", "s"),
    "view_fare_by_service_year": over(FINANCIAL_KPIS, f"""
SELECT anio, tipo_servicio, {MEAN2('tarifa_base_promedio')} AS tarifa_por_viaje,
  {MEAN2('tarifa_promedio_por_milla')} AS tarifa_por_milla FROM k GROUP BY 1, 2""", "k"),
    "view_borough_matrix": over(TERRITORIAL, """
SELECT pu_borough, do_borough, CAST(SUM(total_viajes) AS BIGINT) AS viajes FROM d GROUP BY 1, 2""", "d"),
    "view_borough_matrix_wide": over(TERRITORIAL, "SELECT pu_borough, " + ", ".join(
        f"CAST(SUM(total_viajes) FILTER (do_borough = '{b}') AS BIGINT) AS \"{b}\"" for b in
        ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown")) + " FROM d GROUP BY pu_borough", "d"),
    "view_hourly_curve": over(TEMPORAL, """
SELECT tipo_servicio, hora_dia, CAST(SUM(total_viajes) AS BIGINT) AS viajes FROM t
WHERE dia_semana_num IN (1, 2, 3, 4, 5) GROUP BY 1, 2""", "t"),
    "view_hourly_curve_borough": with_views("""
u AS (
  SELECT tipo_taxi AS tipo_servicio, pulocationid, pickup_datetime FROM trips_taxi
  WHERE pickup_datetime IS NOT NULL AND trip_distance > 0 AND fare_amount > 0
  UNION ALL
  SELECT 'fhvhv', pulocationid, pickup_datetime FROM trips_fhvhv
  WHERE pickup_datetime IS NOT NULL AND trip_miles > 0 AND base_passenger_fare > 0
)
SELECT COALESCE(z.borough, 'Unknown') AS pu_borough, u.tipo_servicio, CAST(hour(u.pickup_datetime) AS BIGINT) AS hora_dia,
  COUNT(*) AS viajes
FROM u LEFT JOIN zones z ON u.pulocationid = TRY_CAST(z.locationid AS BIGINT)
WHERE isodow(u.pickup_datetime) IN (1, 2, 3, 4, 5)
GROUP BY 1, 2, 3""", TRIPS_TAXI, TRIPS_FHVHV, ZONES),
    "question_apps_overtake_yellow": over(MARKET_SHARE, """
, p AS (SELECT anio, mes, SUM(CASE WHEN tipo_servicio = 'yellow' THEN total_viajes END) AS yellow,
          SUM(CASE WHEN tipo_servicio = 'fhvhv' THEN total_viajes END) AS fhvhv FROM s GROUP BY 1, 2)
SELECT MIN(anio || '-' || mes) AS primer_mes_apps_superan_yellow FROM p WHERE COALESCE(fhvhv, 0) > COALESCE(yellow, 0)""",
                                          "s"),
    "question_year_on_year": over(MARKET_SHARE, f"""
, dd AS (SELECT tipo_servicio, make_date(CAST(anio AS INT), CAST(mes AS INT), 1) AS d, total_viajes FROM s),
b AS (SELECT tipo_servicio, MIN(d) AS d0, MAX(d) AS d1 FROM dd GROUP BY 1),
cal AS (SELECT tipo_servicio, CAST(unnest(generate_series(d0, d1, INTERVAL 1 MONTH)) AS DATE) AS d FROM b),
dense AS (SELECT c.tipo_servicio, c.d, COALESCE(dd.total_viajes, 0) AS total_viajes
          FROM cal c LEFT JOIN dd ON c.tipo_servicio = dd.tipo_servicio AND c.d = dd.d),
w AS (SELECT *, lag(total_viajes, 12) OVER (PARTITION BY tipo_servicio ORDER BY d) AS prev FROM dense)
SELECT tipo_servicio, strftime(d, '%Y') AS anio, strftime(d, '%m') AS mes, CAST(total_viajes AS BIGINT) AS total_viajes,
  CAST(prev AS BIGINT) AS viajes_anio_anterior, 100.0::DOUBLE * ({RATE('total_viajes - prev', 'prev')}) AS variacion_pct
FROM w""", "s"),
    "question_weekday_weekend_night": over(TEMPORAL, """
SELECT anio, tipo_servicio, CASE WHEN dia_semana_num IN (6, 7) THEN 'fin_de_semana' ELSE 'laborable' END AS tipo_dia,
  CASE WHEN hora_dia IN (22, 23, 0, 1, 2, 3, 4, 5) THEN 'noche' ELSE 'dia' END AS franja,
  CAST(SUM(total_viajes) AS BIGINT) AS viajes FROM t GROUP BY 1, 2, 3, 4""", "t"),
    "question_revenue_per_mile_minute": with_views(f"""
u AS (
  SELECT anio, tipo_taxi AS tipo_servicio, total_amount AS ingreso, trip_distance AS millas,
    date_diff('second', pickup_datetime, dropoff_datetime) AS segundos
  FROM trips_taxi WHERE trip_distance > 0 AND fare_amount > 0 AND total_amount > 0 AND dropoff_datetime >= pickup_datetime
  UNION ALL
  SELECT anio, 'fhvhv', {GROSS}, trip_miles, trip_time FROM trips_fhvhv
  WHERE trip_miles > 0 AND base_passenger_fare > 0 AND trip_time > 0
)
SELECT anio, tipo_servicio, {RATE('SUM(ingreso)', 'SUM(millas)')} AS ingreso_por_milla,
  CAST(SUM(ingreso) AS DOUBLE) * 60.0::DOUBLE / NULLIF(CAST(SUM(segundos) AS DOUBLE), 0) AS ingreso_por_minuto
FROM u GROUP BY 1, 2""", TRIPS_TAXI, TRIPS_FHVHV),
})


def _calendar(fmt: str, start: str) -> str:
    return (f"SELECT '{fmt}' AS formato, strftime(d, '%Y') AS anio, strftime(d, '%m') AS mes FROM "
            f"(SELECT unnest(generate_series(DATE '{start}-01', DATE '2026-11-01', INTERVAL 1 MONTH)) AS d)")


def _passing(tipo: str) -> str:
    lo, hi = WINDOW[tipo]
    rules = [CHRONO, YW(lo, hi), f"COALESCE({NN('fare_amount')}, false)", f"COALESCE({NN('trip_distance')}, false)"]
    if tipo == "green":
        rules.append(PLACEHOLDER_OK)
    return f"SELECT DISTINCT tipo_taxi AS formato, anio, mes FROM taxi_norm WHERE tipo_taxi = '{tipo}' AND {' AND '.join(rules)}"


ORACLE.update({
    "missing_periods": with_norm(f"""
e AS ({_calendar('yellow', '2009-01')} UNION ALL {_calendar('green', '2013-08')}
      UNION ALL {_calendar('fhvhv', '2019-02')} UNION ALL {_calendar('fhv', '2015-01')}),
p AS (SELECT DISTINCT formato, anio, mes FROM all_norm)
SELECT e.formato, e.anio, e.mes, printf('%04d-%02d', CAST(e.anio AS INT), CAST(e.mes AS INT)) AS periodo
FROM e LEFT JOIN p ON e.formato = p.formato AND e.anio = p.anio AND e.mes = p.mes
WHERE p.formato IS NULL"""),
    "pending_periods": with_norm(f"""
r AS (SELECT DISTINCT formato, anio, mes FROM all_norm),
s AS ({_passing('yellow')} UNION ALL {_passing('green')}
  UNION ALL SELECT DISTINCT 'fhv', anio, mes FROM fhv_norm WHERE {_reason('fhv')} IS NULL
  UNION ALL SELECT DISTINCT 'fhvhv', anio, mes FROM trips_fhvhv WHERE {_reason('fhvhv')} IS NULL)
SELECT r.formato, r.anio, r.mes FROM r LEFT JOIN s ON r.formato = s.formato AND r.anio = s.anio AND r.mes = s.mes
WHERE s.formato IS NULL"""),
})


# raw folders written by the job queries: one file per month for taxi, two per month for fhv (two layouts)
ORACLE["profile_volume_files"] = with_views("""
v AS (
  SELECT tipo_taxi AS formato, anio, mes, 1 AS files_per_month FROM trips_taxi
  UNION ALL SELECT 'fhv', anio, mes, 2 FROM trips_fhv
  UNION ALL SELECT 'fhvhv', anio, mes, 2 FROM trips_fhvhv
)
SELECT formato, CAST(COUNT(DISTINCT anio || '-' || mes) * MAX(files_per_month) AS BIGINT) AS archivos,
  COUNT(*) AS filas, MIN(anio || '-' || mes) AS primer_periodo, MAX(anio || '-' || mes) AS ultimo_periodo
FROM v GROUP BY formato""", TRIPS_TAXI, TRIPS_FHV, TRIPS_FHVHV)

# physical types of the written raw folders: formats, columns, declared type, types found
_TYPES = [
    ("yellow green", "congestion_surcharge fare_amount tip_amount tolls_amount total_amount trip_distance", "double",
     "double"),
    ("yellow green", "vendorid", "int32", "int32"),
    ("yellow green", "pulocationid dolocationid", "int32", "double,int32"),
    ("yellow green", "passenger_count", "int64", "double,int64"),
    ("yellow green", "payment_type", "int64", "int64,string"),
    ("yellow green", "fare_amt tip_amt tolls_amt total_amt", None, "double"),
    ("yellow green", "trip_pickup_datetime trip_dropoff_datetime vendor_name", None, "string"),
    ("yellow green", "trip_key trip_line", None, "int64"),
    ("yellow", "tpep_pickup_datetime tpep_dropoff_datetime", "timestamp", "timestamp"),
    ("green", "lpep_pickup_datetime lpep_dropoff_datetime", "timestamp", "timestamp"),
    ("fhv fhvhv", "pickup_datetime dropoff_datetime", "timestamp", "timestamp"),
    ("fhv fhvhv", "dispatching_base_num", "string", "string"),
    ("fhv fhvhv", "event_id", None, "int64"),
    ("fhv", "pulocationid dolocationid", "int64", "double,int64"),
    ("fhvhv", "hvfhs_license_num", "string", "string"),
    ("fhvhv", "trip_miles base_passenger_fare tolls bcf sales_tax congestion_surcharge tips driver_pay", "double", "double"),
    ("fhvhv", "trip_time", "int64", "int64"),
    ("fhvhv", "pulocationid dolocationid", "int32", "int32,int64"),
    ("fhvhv", "airport_fee", "double", "double,int32"),
    ("fhvhv", "wav_match_flag", "string", "int64,string"),
]


def _types(*formats: str) -> str:
    rows = [f"('{f}', '{c}', {repr(declared) if declared else 'NULL'}, '{found}', {str(declared != found).lower()})"
            for fs, cs, declared, found in _TYPES for f in fs.split() if f in formats for c in cs.split()]
    return f"(VALUES {', '.join(rows)}) t(formato, column_name, declared_type, physical_types, drift)"


ORACLE["type_drift_formats"] = f"SELECT * FROM {_types('yellow', 'green', 'fhv', 'fhvhv')}"
ORACLE["type_drift_audit"] = f"SELECT column_name, declared_type, physical_types, drift FROM {_types('yellow')}"

ORACLE["staging_period_rows"] = with_views("""
SELECT anio, mes, COUNT(*) AS total_filas FROM (
  SELECT anio, mes FROM trips_taxi UNION ALL SELECT anio, mes FROM trips_fhvhv UNION ALL SELECT anio, mes FROM trips_fhv
) u GROUP BY anio, mes""", TRIPS_TAXI, TRIPS_FHVHV, TRIPS_FHV)
