"""Data-profiling reports over raw or normalised trips.

Every report is a ``groupBy`` with conditional counts (``count_if``) and partial aggregation,
so a hot key or period is combined map-side.  Inputs carry ``formato`` (format), the file's
period ``anio``/``mes`` and canonical columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triplake.schema import DEDUP_KEYS, FHV_DROPOFF_SENTINEL, LICENSE_LABELS, TAXI_AMOUNT_PARTS, UNKNOWN_ZONES, YEAR_WINDOW
from triplake.functions.numeric import ratio


def _rate(num: Column, den: Column) -> Column:
    return ratio(num, den)


def period_text(anio: str = "anio", mes: str = "mes") -> Column:
    return F.concat_ws("-", F.col(anio), F.col(mes))


def volume_coverage(df: DataFrame) -> DataFrame:
    """Periods (one file each), rows, first and last period per format."""
    p = period_text()
    return df.groupBy("formato").agg(F.count_distinct(p).alias("periodos"),
                                     F.count(F.lit(1)).alias("filas"),
                                     F.min(p).alias("primer_periodo"), F.max(p).alias("ultimo_periodo"))


def inverted_dates(df: DataFrame) -> DataFrame:
    """Rows with dropoff before pickup, by format, vendor and period."""
    inv = F.count_if(F.col("dropoff_datetime") < F.col("pickup_datetime"))
    return (df.groupBy("formato", "vendorid", "anio", "mes")
              .agg(F.count(F.lit(1)).alias("filas"), inv.alias("invertidos"))
              .withColumn("tasa_invertidos", _rate("invertidos", "filas")))


def sentinel_by_year(fhv_raw: DataFrame) -> DataFrame:
    """Fhv dropoffs equal to the 'not reported' sentinel, per pickup year (run before normalising)."""
    s = F.col("dropoff_datetime") == F.lit(FHV_DROPOFF_SENTINEL).cast("timestamp_ntz")
    return (fhv_raw.groupBy(F.year("pickup_datetime").cast("bigint").alias("anio_pickup"))
                   .agg(F.count(F.lit(1)).alias("filas"), F.count_if(s).alias("centinelas")))


def year_overflow(df: DataFrame, column: str = "dropoff_datetime") -> DataFrame:
    """E5: file year vs the real (dropoff or pickup) year; flags the new-year overflow and out-of-window years."""
    real = F.year(column).cast("bigint")
    g = df.groupBy("formato", "anio", real.alias("anio_real")).agg(F.count(F.lit(1)).alias("filas"))
    lo = F.lit(None).cast("bigint")
    hi = F.lit(None).cast("bigint")
    for fmt, (a, b) in YEAR_WINDOW.items():
        lo = F.when(F.col("formato") == fmt, F.lit(a)).otherwise(lo)
        hi = F.when(F.col("formato") == fmt, F.lit(b)).otherwise(hi)
    return (g.where(F.col("anio_real").isNull() | (F.col("anio_real") != F.col("anio").cast("bigint")))
             .withColumn("desborde", F.col("anio_real") == F.col("anio").cast("bigint") + 1)
             .withColumn("fuera_de_rango", ~F.coalesce(F.col("anio_real").between(lo, hi), F.lit(False))))


def duplicate_profile(df: DataFrame, fmt: str) -> DataFrame:
    """Per period, duplicate key groups, largest repetition, extra rows and their rate."""
    keys = DEDUP_KEYS[fmt][0]
    per_key = df.groupBy(*keys, "anio", "mes").agg(F.count(F.lit(1)).alias("n"))
    return (per_key.groupBy("anio", "mes")
                   .agg(F.sum("n").alias("filas"), F.count_if(F.col("n") > 1).alias("grupos_duplicados"),
                        F.max("n").alias("max_repeticion"), F.sum(F.col("n") - 1).alias("filas_sobrantes"))
                   .withColumn("tasa_duplicados", _rate("filas_sobrantes", "filas"))
                   .select(F.lit(fmt).alias("formato"), "*"))


def amount_ranges(df: DataFrame, cols=("fare_amount", "total_amount")) -> DataFrame:
    """Minimum, negative and zero counts of money columns per format and year."""
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")).alias(f"min_{c}"),
                 F.count_if(F.col(c) < 0).alias(f"negativos_{c}"),
                 F.count_if(F.col(c) == 0).alias(f"ceros_{c}")]
    return df.groupBy("formato", "anio").agg(*aggs)


def negative_cash_fares(df: DataFrame, cash_code: int = 2) -> DataFrame:
    """Negative fares paid in cash, by vendor and year."""
    return (df.where((F.col("payment_type") == cash_code) & (F.col("fare_amount") < 0))
              .groupBy("vendorid", "anio").agg(F.count(F.lit(1)).alias("reversos_efectivo")))


def negative_distances(df: DataFrame, col: str = "trip_distance") -> DataFrame:
    """Negative distances by year and format."""
    return df.groupBy("formato", "anio").agg(F.count_if(F.col(col) < 0).alias("distancias_negativas"),
                                             F.count(F.lit(1)).alias("filas"))


def license_label(c: str = "hvfhs_license_num") -> Column:
    out = None
    for k, v in LICENSE_LABELS.items():
        out = F.when(F.col(c) == k, v) if out is None else out.when(F.col(c) == k, v)
    return out.otherwise(F.lit("Other"))


def zero_driver_pay(fhvhv: DataFrame) -> DataFrame:
    """Share of app trips with driver_pay = 0 per licence."""
    return (fhvhv.groupBy("hvfhs_license_num")
                 .agg(F.count(F.lit(1)).alias("filas"), F.count_if(F.col("driver_pay") == 0).alias("pago_cero"))
                 .withColumn("plataforma", license_label())
                 .withColumn("tasa_pago_cero", _rate("pago_cero", "filas")))


def vendor_census(df: DataFrame) -> DataFrame:
    """Rows, first/last pickup and NULL rates per format and vendor."""
    return (df.groupBy("formato", "vendorid")
              .agg(F.count(F.lit(1)).alias("filas"), F.min("pickup_datetime").alias("primer_viaje"),
                   F.max("pickup_datetime").alias("ultimo_viaje"),
                   F.count_if(F.col("ratecodeid").isNull()).alias("nulos_ratecode"),
                   F.count_if(F.col("pulocationid").isNull()).alias("nulos_zona_origen"))
              .withColumn("tasa_nulos_ratecode", _rate("nulos_ratecode", "filas"))
              .withColumn("tasa_nulos_zona_origen", _rate("nulos_zona_origen", "filas")))


def ratecode_flex_contingency(df: DataFrame) -> DataFrame:
    """2x2 table of (ratecodeid IS NULL) x (payment_type = 0)."""
    return (df.groupBy(F.col("ratecodeid").isNull().alias("ratecode_nulo"),
                       F.coalesce(F.col("payment_type") == 0, F.lit(False)).alias("pago_flex"))
              .agg(F.count(F.lit(1)).alias("filas")))


def accounting_gap(df: DataFrame, parts=TAXI_AMOUNT_PARTS, top: int = 10) -> DataFrame:
    """Total minus the sum of its components (exact, in cents), most frequent values and their share.

    The top-k is the report itself.  The share's denominator is the grand total of the same aggregation
    (a rollup), taken along as the first row of the top-k, so the trips are read and counted once.
    """
    cents = "decimal(18,2)"
    comp = None
    for p in parts:
        t = F.coalesce(F.col(p).cast(cents), F.lit(0).cast(cents))
        comp = t if comp is None else comp + t
    gap = (F.col("total_amount").cast(cents) - comp).alias("diferencia")
    rows = df.select(gap).where(F.col("diferencia").isNotNull())
    counts = rows.rollup("diferencia").agg(F.count(F.lit(1)).alias("viajes"), F.grouping("diferencia").alias("todo"))
    first = counts.orderBy(F.col("todo").desc(), F.col("viajes").desc(), F.col("diferencia").asc()).limit(top + 1)
    total = F.max(F.when(F.col("todo") == 1, F.col("viajes"))).over(Window.partitionBy())     # top + 1 rows
    return (first.withColumn("total", total).where(F.col("todo") == 0)
                 .select(F.col("diferencia").cast("double").alias("diferencia"), "viajes",
                         _rate(F.col("viajes"), F.col("total")).alias("proporcion")))


def unknown_zone_share(df: DataFrame) -> DataFrame:
    """Share of pickups and dropoffs in unknown zones (264, 265) or NULL, by format and year."""
    def unknown(c):
        return F.col(c).isNull() | F.col(c).isin(*UNKNOWN_ZONES)
    return (df.groupBy("formato", "anio")
              .agg(F.count(F.lit(1)).alias("filas"), F.count_if(unknown("pulocationid")).alias("pu_desconocido"),
                   F.count_if(unknown("dolocationid")).alias("do_desconocido"))
              .withColumn("tasa_pu_desconocido", _rate("pu_desconocido", "filas"))
              .withColumn("tasa_do_desconocido", _rate("do_desconocido", "filas")))


def volume_from_footers(footer_df: DataFrame, formato: str) -> DataFrame:
    """E1 from metadata only: files, rows (footer row counts) and first/last period of one raw folder."""
    from triplake.sources.files import with_period_of_path
    files = with_period_of_path(footer_df.select("path", "num_rows").distinct())
    p = period_text()
    return files.agg(F.count(F.lit(1)).alias("archivos"), F.sum("num_rows").cast("bigint").alias("filas"),
                     F.min(p).alias("primer_periodo"), F.max(p).alias("ultimo_periodo")) \
                .select(F.lit(formato).alias("formato"), "*")
