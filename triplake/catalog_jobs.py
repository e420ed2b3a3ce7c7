"""Registered queries that run whole jobs: raw files with drifted schemas are derived from the
driver tables, written to the session's shared scratch folder, then scanned, cleaned, staged,
aggregated or streamed.  Each call works in a fresh sub-folder."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.catalog_rules import TAXI_ID
from triplake.functions.dates import anio_of, mes_of
from triplake.operators.normalize import normalize
from triplake.operators import marts
from triplake.operators.quality import REASON
from triplake.plans import incremental as inc
from triplake.plans.clean import clean_periods, read_quarantine
from triplake.schema import FORMATS, RAW_DECLARED, STAGING_TABLE
from triplake.session import at_once, checkpoint_dir
from triplake.sources import adapter
from triplake.sources.commit import Folders
from triplake.sources.files import list_files, raw_periods, staged_periods
from triplake.sources.scan import footers, read_raw, type_drift
from triplake.sources.sinks import (count_rows, read_staging, read_staging_period, read_zone_csv, write_staging,
                                    write_zone_csv)
from triplake.streaming.arrivals import stream_arrivals

YELLOW_DECLARED = dict(RAW_DECLARED["yellow"])


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/triplake-scratch/{name}-{uuid.uuid4().hex[:12]}"


def write_months(rows: DataFrame, folder: str) -> None:
    """One file per month, like the published files: each month lands in one task."""
    rows.repartition("anio", "mes").write.mode("append").partitionBy("anio", "mes").parquet(folder)


def _even_month(c: str = "mes") -> F.Column:
    return F.col(c).cast("int") % 2 == 0


def write_raw_taxi(spark: SparkSession, root: str, raw_root: str) -> None:
    """Yellow and green raw folders; even months use a legacy layout (mixed case, text times, double ids)."""
    t = adapter.trips_taxi(spark, root).persist(StorageLevel.MEMORY_AND_DISK)   # four writes read it
    vendor_text = F.when(F.col("vendorid") == 1, "CMT").when(F.col("vendorid") == 2, "VTS") \
                   .otherwise(F.col("vendorid").cast("string"))
    pay_code = F.coalesce(*[F.when(F.upper("payment_type_raw").isin(*ks), F.lit(v)) for v, ks in
                            ((2, ["CAS", "CASH"]), (1, ["CRD", "CREDIT"]), (3, ["NOC", "NO CHARGE"]),
                             (4, ["DIS", "DISPUTE"]))],
                          F.col("payment_type_raw").try_cast("double").try_cast("bigint"))
    for tipo, ts in (("yellow", "tpep"), ("green", "lpep")):
        rows = t.where(F.col("tipo_taxi") == tipo)
        current = rows.where(~_even_month()).select(
            F.col("vendorid").cast("int").alias("VendorID"),
            F.col("pickup_datetime").alias(f"{ts}_pickup_datetime"),
            F.col("dropoff_datetime").alias(f"{ts}_dropoff_datetime"),
            F.col("trip_line").alias("passenger_count"), "trip_distance",
            F.col("pulocationid").cast("int").alias("PULocationID"),
            F.col("dolocationid").cast("int").alias("DOLocationID"),
            pay_code.alias("payment_type"),
            *[F.col(c).cast("double").alias(c) for c in
              ("fare_amount", "tip_amount", "tolls_amount", "total_amount", "congestion_surcharge")],
            *TAXI_ID, "anio", "mes")
        legacy = rows.where(_even_month()).select(
            vendor_text.alias("vendor_name"),
            F.col("pickup_datetime").cast("string").alias("Trip_Pickup_DateTime"),
            F.col("dropoff_datetime").cast("string").alias("Trip_Dropoff_DateTime"),
            F.col("trip_line").cast("double").alias("Passenger_Count"),
            F.col("trip_distance").alias("Trip_Distance"),
            F.col("pulocationid").cast("double").alias("PULocationID"),
            F.col("dolocationid").cast("double").alias("DOLocationID"),
            F.col("payment_type_raw").alias("Payment_Type"),
            F.col("fare_amount").cast("double").alias("Fare_Amt"),
            F.col("tip_amount").cast("double").alias("Tip_Amt"),
            F.col("tolls_amount").cast("double").alias("Tolls_Amt"),
            F.col("total_amount").cast("double").alias("Total_Amt"),
            F.col("congestion_surcharge").cast("double").alias("congestion_surcharge"),
            F.col("trip_key").alias("Trip_Key"), F.col("trip_line").alias("Trip_Line"), "anio", "mes")
        for part in (current, legacy):
            write_months(part, f"{raw_root}/{tipo}")
    t.unpersist()


def write_raw_fhv(spark: SparkSession, root: str, raw_root: str) -> None:
    """fhv raw folder: two files per period, one with the location ids as double (type drift inside a month)."""
    f = adapter.trips_fhv(spark, root)
    base = [F.col("dispatching_base_num"), F.col("pickup_datetime"), F.col("dropoff_datetime"), "event_id",
            "anio", "mes"]
    whole = f.where(F.col("event_id") % 2 == 0).select(
        *base, F.col("pulocationid").alias("PUlocationID"), F.col("dolocationid").alias("DOlocationID"))
    drifted = f.where(F.col("event_id") % 2 == 1).select(
        *base, F.col("pulocationid").cast("double").alias("PUlocationID"),
        F.col("dolocationid").cast("double").alias("DOlocationID"))
    write_months(whole, f"{raw_root}/fhv")
    write_months(drifted, f"{raw_root}/fhv")


def write_raw_fhvhv(spark: SparkSession, root: str, raw_root: str) -> None:
    """fhvhv raw folder, two files per period: in one the airport fee is int32 (whole units) and the wav match flag a
    number, and the zones are int64."""
    f = adapter.trips_fhvhv(spark, root)
    old = F.col("event_id") % 3 == 0
    base = ["hvfhs_license_num", "dispatching_base_num", "pickup_datetime", "dropoff_datetime", "trip_miles", "trip_time",
            *[F.col(c).cast("double").alias(c) for c in ("base_passenger_fare", "tolls", "bcf", "sales_tax",
                                                         "congestion_surcharge", "tips", "driver_pay")],
            "event_id", "anio", "mes"]
    current = f.where(~old).select(
        *base, F.col("pulocationid").cast("int").alias("PULocationID"), F.col("dolocationid").cast("int").alias(
            "DOLocationID"), F.col("airport_fee").cast("double").alias("airport_fee"),
        F.when(F.col("event_id") % 2 == 0, "Y").otherwise("N").alias("wav_match_flag"))
    legacy = f.where(old).select(
        *base, F.col("pulocationid").alias("PULocationID"), F.col("dolocationid").alias("DOLocationID"),
        F.col("airport_fee").cast("int").alias("airport_fee"), (F.col("event_id") % 2).alias("wav_match_flag"))
    for part in (current, legacy):
        write_months(part, f"{raw_root}/fhvhv")


def write_raw(spark: SparkSession, root: str, raw_root: str) -> None:
    """The raw folders of all four formats, at the same time: a format's writes may keep few cores busy."""
    at_once(*(partial(write, spark, root, raw_root) for write in (write_raw_fhvhv, write_raw_fhv, write_raw_taxi)))


def _all_formats(frames) -> DataFrame:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


SCAN_COLUMNS = [*TAXI_ID, "source_anio", "source_mes", "vendorid", "pickup_datetime", "dropoff_datetime",
                "passenger_count", "payment_type", "fare_amount", "total_amount", "congestion_surcharge",
                "pulocationid", "dolocationid"]


def drifted_scan(spark, root) -> DataFrame:
    """S1/§4.3: files of two schemas in one folder read by fingerprint and canonicalised."""
    raw = scratch(spark, "raw")
    write_raw_taxi(spark, root, raw)
    return read_raw(spark, f"{raw}/yellow", "yellow", keep=TAXI_ID).select(*SCAN_COLUMNS)


def drifted_scan_formats(spark, root) -> DataFrame:
    """S1/§4.3 for the four formats: every folder read by fingerprint; the app's fee and flag change their types."""
    raw = scratch(spark, "raw")
    write_raw(spark, root, raw)

    def rows(fmt: str) -> DataFrame:
        df = read_raw(spark, f"{raw}/{fmt}", fmt)
        own = {c: (F.col(c) if fmt == "fhvhv" else F.lit(None)).cast(t) for c, t in (
            ("airport_fee", "double"), ("wav_match_flag", "string"))}
        return df.select(F.lit(fmt).alias("formato"), "source_anio", "source_mes", "pickup_datetime", "dropoff_datetime",
                         "pulocationid", "dolocationid", *[v.alias(c) for c, v in own.items()])
    return _all_formats(map(rows, FORMATS))


def type_drift_formats(spark, root) -> DataFrame:
    """E2 for the four formats."""
    raw = scratch(spark, "raw")
    write_raw(spark, root, raw)

    def rows(fmt: str) -> DataFrame:
        d = type_drift(footers(spark, f"{raw}/{fmt}"), dict(RAW_DECLARED[fmt]))
        return d.select(F.lit(fmt).alias("formato"), "column_name", "declared_type",
                        F.array_join("physical_types", ",").alias("physical_types"), "drift")
    return _all_formats(map(rows, FORMATS))


def type_drift_audit(spark, root) -> DataFrame:
    """Physical types per column across the raw files, flagged against the declared types."""
    raw = scratch(spark, "raw")
    write_raw_taxi(spark, root, raw)
    d = type_drift(footers(spark, f"{raw}/yellow"), YELLOW_DECLARED)
    return d.select("column_name", "declared_type",
                    F.array_join("physical_types", ",").alias("physical_types"), "drift")


def profile_volume_files(spark, root) -> DataFrame:
    """E1 on raw folders: files, rows and period coverage per format from the Parquet footers alone."""
    from triplake.operators.profile import volume_from_footers
    raw = scratch(spark, "raw")
    write_raw(spark, root, raw)
    return _all_formats(volume_from_footers(footers(spark, f"{raw}/{f}"), f) for f in FORMATS)


def csv_zone_lookup(spark, root) -> DataFrame:
    """The zone lookup written as quoted CSV with a header and read back as all-string columns."""
    path = scratch(spark, "zones_csv")
    write_zone_csv(adapter.zones(spark, root), path)
    return read_zone_csv(spark, path)


STAGED_TAXI = ["tipo_taxi", "anio", "mes", "vendorid", "pickup_datetime", "dropoff_datetime", "payment_type",
               "fare_amount", "trip_distance", "pulocationid", "dolocationid"]


def staging_roundtrip(spark, root) -> DataFrame:
    """S1 -> clean -> S9 -> S3: the cleaning job over drifted raw taxi folders, staging read back."""
    base = scratch(spark, "lake")
    write_raw_taxi(spark, root, f"{base}/raw")
    clean_periods(spark, f"{base}/raw", f"{base}/staging", "taxi", order_by=TAXI_ID, keep=TAXI_ID)
    return read_staging(spark, f"{base}/staging", "taxi").select(*STAGED_TAXI)


def write_raw_by_dropoff(spark: SparkSession, root: str, raw_root: str) -> None:
    """A yellow raw folder whose files are named by the month of the dropoff, so that one holds several pickup months."""
    t = adapter.trips_taxi(spark, root).where(F.col("tipo_taxi") == "yellow")
    named = t.select(F.col("vendorid").alias("VendorID"), F.col("pickup_datetime").alias("tpep_pickup_datetime"),
             F.col("dropoff_datetime").alias("tpep_dropoff_datetime"), "trip_distance",
             F.col("pulocationid").alias("PULocationID"), F.col("dolocationid").alias("DOLocationID"),
             F.col("payment_type_raw").alias("payment_type"), F.col("fare_amount").cast("double").alias("fare_amount"),
             *TAXI_ID, anio_of("dropoff_datetime").alias("anio"), mes_of("dropoff_datetime").alias("mes"))
    write_months(named, f"{raw_root}/yellow")


def staging_by_pickup(spark, root) -> DataFrame:
    """Rows staged in their pickup's month. The last file is published again without its even trip lines: what
    it had put into any month is replaced, the rows of other files in those months stay."""
    base = scratch(spark, "lake")
    job = dict(order_by=TAXI_ID, keep=TAXI_ID, period="pickup")
    write_raw_by_dropoff(spark, root, f"{base}/raw")
    clean_periods(spark, f"{base}/raw", f"{base}/staging", "yellow", **job)
    last = raw_periods(spark, f"{base}/raw/yellow").orderBy(F.desc("anio"), F.desc("mes")).first()
    if last:
        folder = f"yellow/anio={last['anio']}/mes={last['mes']}"
        spark.read.parquet(f"{base}/raw/{folder}").where(F.col("trip_line") % 2 == 1).coalesce(1) \
            .write.parquet(f"{base}/again/{folder}")
        clean_periods(spark, f"{base}/again", f"{base}/staging", "yellow", resume=False, **job)
    return read_staging(spark, f"{base}/staging", "taxi").select(*STAGED_TAXI)


SCOPE = ("2013", "3")            # the year and month that clean_one_period asks for


def clean_one_period(spark, root) -> DataFrame:
    """The job for the taxi formats of one month. That month is read through its own folders, and whatever
    else were staged would be among the rows too."""
    base = scratch(spark, "lake")
    write_raw_taxi(spark, root, f"{base}/raw")
    clean_periods(spark, f"{base}/raw", f"{base}/staging", "taxi", *SCOPE, order_by=TAXI_ID, keep=TAXI_ID)
    period = inc.normalise_period(*SCOPE)
    rest = read_staging(spark, f"{base}/staging", "taxi").where(~inc.in_periods([period]))
    return read_staging_period(spark, f"{base}/staging", "taxi", *period).unionByName(rest).select(*STAGED_TAXI)


def _staging_from_views(spark, root, base) -> dict[str, DataFrame]:
    """The trip views written as staging tables (they already satisfy the rules the marts rely on)."""
    t = adapter.trips_taxi(spark, root).withColumnRenamed("payment_type_raw", "payment_type")
    views = {"yellow": (t, ["tipo_taxi"]), "fhvhv": (adapter.trips_fhvhv(spark, root), []),
             "fhv": (adapter.trips_fhv(spark, root), [])}
    at_once(*(partial(write_staging, normalize(df, fmt, keep=[*own, "anio", "mes"]), base, fmt)
              for fmt, (df, own) in views.items()))
    return inc.load_staging(spark, base, adapter.zones(spark, root))


SHARE_COLUMNS = ["anio", "mes", "tipo_servicio", "total_viajes", "total_viajes_mes", "cuota_mercado_pct"]


def _rebuilt(spark, root) -> str:
    base = scratch(spark, "lake")
    tables = _staging_from_views(spark, root, f"{base}/staging")
    inc.rebuild_marts(spark, tables, f"{base}/mart")
    return f"{base}/mart"


def mart_rebuild(spark, root) -> DataFrame:
    """Full rebuild from staging tables; the share mart read back."""
    return inc.read_mart(spark, _rebuilt(spark, root), "mart_cuota_mercado_mensual").select(*SHARE_COLUMNS)


def mart_rebuild_kpis(spark, root) -> DataFrame:
    """The KPI mart after a full rebuild from staging, whose money columns are double."""
    return inc.read_mart(spark, _rebuilt(spark, root), "mart_kpis_financieros").select(*marts.KPI_COLUMNS)


def mart_row_counts(spark, root) -> DataFrame:
    """Rows that the rebuild reports for each mart, and rows that can be read."""
    base = scratch(spark, "lake")
    report = inc.rebuild_marts(spark, _staging_from_views(spark, root, f"{base}/staging"), f"{base}/mart")
    rows = [(m, report[m], count_rows(spark, f"{base}/mart/{m}")) for m in sorted(marts.ORDER)]
    return spark.createDataFrame(rows, "mart string, escritas bigint, leidas bigint")


LAST_PERIODS = 3                 # periods that the increments of the registered queries append


def _incremental(spark, root) -> str:
    """Rebuild without the last periods, then append them as a list, the last one once more on its own."""
    base = scratch(spark, "lake")
    tables = _staging_from_views(spark, root, f"{base}/staging")
    last = inc.rows_per_period(tables).orderBy(F.desc("anio"), F.desc("mes")).limit(LAST_PERIODS)
    periods = sorted((r["anio"], r["mes"]) for r in last.collect())
    early = {k: (v.where(~inc.in_periods(periods)) if k != "zones" else v) for k, v in tables.items()}
    inc.rebuild_marts(spark, early, f"{base}/mart")
    inc.append_periods(spark, tables, f"{base}/mart", periods)
    for a, m in periods[-1:]:
        inc.append_period(spark, tables, f"{base}/mart", a, m)
    return f"{base}/mart"


def mart_incremental(spark, root) -> DataFrame:
    """Annual time mart finalised from monthly state after increments equals the full computation."""
    mart = _incremental(spark, root)
    return inc.read_mart(spark, mart, "mart_patrones_temporales").select(
        "anio", "tipo_servicio", "dia_semana_num", "dia_semana_nombre", "hora_dia", "total_viajes",
        "tarifa_promedio", "distancia_promedio_millas")


def mart_incremental_share(spark, root) -> DataFrame:
    """The monthly share mart after increments."""
    return inc.read_mart(spark, _incremental(spark, root), "mart_cuota_mercado_mensual").select(*SHARE_COLUMNS)


def mart_incremental_kpis(spark, root) -> DataFrame:
    """The monthly KPI mart after increments."""
    return inc.read_mart(spark, _incremental(spark, root), "mart_kpis_financieros").select(*marts.KPI_COLUMNS)


def mart_incremental_demand(spark, root) -> DataFrame:
    mart = _incremental(spark, root)
    return inc.read_mart(spark, mart, "mart_demanda_territorial").select(
        "anio", "tipo_servicio", "pu_borough", "pu_zone", "do_borough", "do_zone", "total_viajes",
        "distancia_promedio_millas", "monto_total")


def stream_arrival(spark, root) -> DataFrame:
    """Fhv files arrive one per micro-batch; each batch cleans its period; staging read back."""
    base = scratch(spark, "stream")
    write_raw_fhv(spark, root, f"{base}/raw")
    q = stream_arrivals(spark, f"{base}/raw/fhv", "fhv", f"{base}/staging", f"{base}/checkpoint",
                        max_files_per_trigger=1, order_by=["event_id"])
    q.awaitTermination()
    again = stream_arrivals(spark, f"{base}/raw/fhv", "fhv", f"{base}/staging", f"{base}/checkpoint")
    again.awaitTermination()                     # nothing new: the checkpoint remembers every file
    return read_staging(spark, f"{base}/staging", "fhv").select(
        "anio", "mes", "dispatching_base_num", "pickup_datetime", "dropoff_datetime", "pulocationid",
        "dolocationid", "sr_flag", "affiliated_base_number")


def stream_quarantine(spark, root) -> DataFrame:
    """Rows that the arrival stream rejects, counted by period and reason."""
    base = scratch(spark, "stream")
    write_raw_fhv(spark, root, f"{base}/raw")
    stream_arrivals(spark, f"{base}/raw/fhv", "fhv", f"{base}/staging", f"{base}/checkpoint",
                    max_files_per_trigger=1, order_by=["event_id"],
                    quarantine_root=f"{base}/quarantine").awaitTermination()
    return read_quarantine(spark, f"{base}/quarantine", "fhv").groupBy("anio", "mes", "reject_reason").agg(
        F.count(F.lit(1)).alias("filas"))


def _merged_stream(spark, base: str, fmt: str, of_file, kept) -> DataFrame:
    """Staged and rejected rows of a format whose files were merged some at a time, after a file of the last month
    (one that ``of_file`` picks by its schema) was published again with the rows ``kept``."""
    raw, staging, quarantine = f"{base}/raw/{fmt}", f"{base}/staging-{fmt}", f"{base}/quarantine"

    def arrive():
        stream_arrivals(spark, raw, fmt, staging, f"{base}/checkpoint-{fmt}", max_files_per_trigger=40,
                        merge_staged=True, quarantine_root=quarantine).awaitTermination()
    arrive()
    last = raw_periods(spark, raw).orderBy(F.desc("anio"), F.desc("mes")).first()
    files = list_files(spark, f"{raw}/anio={last['anio']}/mes={last['mes']}").collect() if last else []
    for path in (r["path"] for r in files):
        rows = spark.read.parquet(path)
        if of_file(rows.schema):
            rows.where(kept).repartition(1).write.parquet(f"{base}/again-{fmt}")
            _put_in_place(spark, f"{base}/again-{fmt}", path)
    arrive()
    staged = read_staging(spark, staging, STAGING_TABLE[fmt]).withColumn(REASON, F.lit(None).cast("string"))
    if "tipo_taxi" in staged.columns:
        staged = staged.where(F.col("tipo_taxi") == fmt)
    rejected = read_quarantine(spark, quarantine, fmt)
    return staged.select(*rejected.columns).unionByName(rejected)


def stream_merge(spark, root) -> DataFrame:
    """Files merged into their months some at a time, for yellow (many months) and fhv (two files a month);
    then one file of each format's last month is published again with some of its rows. Staged rows (their key) and
    rejected ones with their reason."""
    base = scratch(spark, "stream")

    def merged_yellow() -> DataFrame:
        write_raw_taxi(spark, root, f"{base}/raw")
        return _merged_stream(spark, base, "yellow", lambda schema: True, F.col("trip_line") % 2 == 1)

    def merged_fhv() -> DataFrame:
        write_raw_fhv(spark, root, f"{base}/raw")
        return _merged_stream(spark, base, "fhv", lambda schema: schema["PUlocationID"].dataType.typeName() == "double",
                              F.col("event_id") % 4 == 1)                     # the file of the odd ids
    yellow, fhv = at_once(merged_yellow, merged_fhv)             # each format has a staging root of its own
    cols = ["anio", "mes", "pickup_datetime", "dropoff_datetime", REASON]
    return yellow.select(F.lit("yellow").alias("formato"), F.col("vendorid").cast("string").alias("clave"), *cols,
                         "fare_amount", F.lit(None).cast("bigint").alias("pulocationid"),
                         F.lit(None).cast("bigint").alias("dolocationid")).unionByName(
        fhv.select(F.lit("fhv").alias("formato"), F.col("dispatching_base_num").alias("clave"), *cols,
                   F.lit(None).cast("double").alias("fare_amount"), "pulocationid", "dolocationid"))


def _put_in_place(spark, folder: str, path: str) -> None:
    """The Parquet file of ``folder`` under the name of the file ``path``."""
    folders = Folders(spark)
    name = next(n for n in folders.names(folder) if n.endswith(".parquet"))
    folders.delete(path)
    folders.move(f"{folder}/{name}", path)


def rerun_empty_period(spark, root) -> DataFrame:
    """The last yellow period is published again with nothing but rejected rows; its staged rows go."""
    base = scratch(spark, "lake")
    write_raw_taxi(spark, root, f"{base}/raw")
    clean_periods(spark, f"{base}/raw", f"{base}/staging", "yellow", order_by=TAXI_ID, keep=TAXI_ID)
    last = raw_periods(spark, f"{base}/raw/yellow").orderBy(F.desc("anio"), F.desc("mes")).first()
    if last:
        folder = f"yellow/anio={last['anio']}/mes={last['mes']}"
        rows = spark.read.parquet(f"{base}/raw/{folder}")
        fare = next(c for c in rows.columns if c.lower() in ("fare_amount", "fare_amt"))
        rows.withColumn(fare, F.lit(-1.0)).write.parquet(f"{base}/again/{folder}")
        clean_periods(spark, f"{base}/again", f"{base}/staging", "yellow", order_by=TAXI_ID, keep=TAXI_ID,
                      resume=False)
    return read_staging(spark, f"{base}/staging", "taxi").select(*STAGED_TAXI)


def rerun_unreadable_period(spark, root) -> DataFrame:
    """Everything is cleaned again after the last yellow file broke; its month keeps what was staged."""
    base = scratch(spark, "lake")
    write_raw_taxi(spark, root, f"{base}/raw")
    job = dict(order_by=TAXI_ID, keep=TAXI_ID, quarantine_root=f"{base}/quarantine")
    clean_periods(spark, f"{base}/raw", f"{base}/staging", "yellow", **job)
    last = raw_periods(spark, f"{base}/raw/yellow").orderBy(F.desc("anio"), F.desc("mes")).first()
    if last:
        folder = f"{base}/raw/yellow/anio={last['anio']}/mes={last['mes']}"
        spark.range(1).select(F.lit("no Parquet file").alias("value")).coalesce(1).write.mode("overwrite").text(folder)
        Folders(spark).move(*_text_as_parquet(spark, folder))
        clean_periods(spark, f"{base}/raw", f"{base}/staging", "yellow", resume=False, skip_unreadable=True, **job)
    return read_staging(spark, f"{base}/staging", "taxi").select(*STAGED_TAXI)


def _text_as_parquet(spark, folder: str) -> tuple[str, str]:
    """(the text file of a folder, the name under which a scan takes it for Parquet)."""
    name = next(n for n in Folders(spark).names(folder) if n.endswith(".txt"))
    return f"{folder}/{name}", f"{folder}/broken.parquet"


def period_listings(spark, root) -> DataFrame:
    """Periods of the raw folders and of the staged table, from file listings alone."""
    base = scratch(spark, "lake")
    write_raw(spark, root, f"{base}/raw")
    staging = {f: f"{base}/staging-{f}" for f in ("yellow", "fhvhv")}         # one run at a time per staging root
    at_once(lambda: clean_periods(spark, f"{base}/raw", staging["yellow"], "yellow", order_by=TAXI_ID, keep=TAXI_ID),
            lambda: clean_periods(spark, f"{base}/raw", staging["fhvhv"], "fhvhv"))
    parts = [raw_periods(spark, f"{base}/raw/{f}", nonempty_only=True).select(F.lit(f"raw {f}").alias("listado"), "*")
             for f in FORMATS]
    parts += [staged_periods(spark, f"{staging[f]}/{STAGING_TABLE[f]}", f if f == "yellow" else None).select(
        F.lit(f"staged {f}").alias("listado"), "*") for f in staging]
    return _all_formats(parts)


QUERIES = {
    "drifted_scan": drifted_scan,
    "drifted_scan_formats": drifted_scan_formats,
    "type_drift_audit": type_drift_audit,
    "type_drift_formats": type_drift_formats,
    "csv_zone_lookup": csv_zone_lookup,
    "profile_volume_files": profile_volume_files,
    "staging_roundtrip": staging_roundtrip,
    "staging_by_pickup": staging_by_pickup,
    "clean_one_period": clean_one_period,
    "mart_row_counts": mart_row_counts,
    "mart_rebuild": mart_rebuild,
    "mart_rebuild_kpis": mart_rebuild_kpis,
    "mart_incremental": mart_incremental,
    "mart_incremental_share": mart_incremental_share,
    "mart_incremental_kpis": mart_incremental_kpis,
    "mart_incremental_demand": mart_incremental_demand,
    "stream_arrival": stream_arrival,
    "stream_quarantine": stream_quarantine,
    "stream_merge": stream_merge,
    "rerun_empty_period": rerun_empty_period,
    "rerun_unreadable_period": rerun_unreadable_period,
    "period_listings": period_listings,
}
