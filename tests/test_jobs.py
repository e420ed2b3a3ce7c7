"""Drifted scan (§4.3, E2), period discovery (S6-S8, R1, J3, J4), staging writes, rebuild vs increments,
streaming arrival (R2, R3)."""

import datetime as dt

from pyspark.sql import functions as F

import pytest
from conftest import SF_SMALL, plan_text
from triplake.catalog_jobs import write_raw_fhv, write_raw_taxi, _staging_from_views
from triplake.operators import marts
from triplake.plans import incremental as inc
from triplake.plans.clean import clean_periods, expand_formats
from triplake.sources import adapter
from triplake.sources.files import expected_periods, list_files, missing_periods, raw_periods
from triplake.sources.scan import footers, read_raw, type_drift
from triplake.sources.sinks import read_staging
from triplake.streaming.arrivals import stream_arrivals


def _write_drifted(spark, root):
    """passenger_count as bigint, double and text in three months; mixed-case names in one."""
    t = dt.datetime(2020, 5, 3, 10)
    spark.createDataFrame([(1, t, t + dt.timedelta(minutes=9), 2, 1.5)],
                          "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
                          "passenger_count bigint, trip_distance double").write.parquet(f"{root}/anio=2020/mes=04")
    spark.createDataFrame([(2, t, t + dt.timedelta(minutes=9), 3.0, 2.5)],
                          "vendorid bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
                          "passenger_count double, trip_distance double").write.parquet(f"{root}/anio=2020/mes=05")
    spark.createDataFrame([("CMT", "2009-01-04 02:52:00", "2009-01-04 03:02:00", "1", "1.0")],
                          "vendor_name string, Trip_Pickup_DateTime string, Trip_Dropoff_DateTime string, "
                          "Passenger_Count string, Trip_Distance string").write.parquet(f"{root}/anio=2009/mes=01")


def test_drifted_scan_reads_every_variant(spark, tmp_path):
    root = str(tmp_path / "yellow")
    _write_drifted(spark, root)
    # a single read of all files fails on the type conflict; the fingerprint scan does not
    out = read_raw(spark, root, "yellow").orderBy("source_anio", "source_mes").collect()
    assert [(r.source_anio, r.source_mes, r.vendorid, r.passenger_count) for r in out] == \
        [("2009", "01", 1, 1), ("2020", "04", 1, 2), ("2020", "05", 2, 3)]


def test_type_drift_audit_flags_disagreement(spark, tmp_path):
    root = str(tmp_path / "yellow")
    _write_drifted(spark, root)
    d = {r.column_name: r for r in type_drift(footers(spark, root), {"passenger_count": "bigint",
                                                                     "trip_distance": "double"}).collect()}
    assert d["passenger_count"].drift and set(d["passenger_count"].physical_types) == {"double", "int64", "string"}
    assert d["trip_distance"].drift            # text in the 2009 file


def test_zero_byte_files_count_as_missing(spark, tmp_path):
    root = tmp_path / "fhv"
    (root / "anio=2019" / "mes=03").mkdir(parents=True)
    (root / "anio=2019" / "mes=03" / "empty.parquet").write_bytes(b"")
    spark.range(1).write.parquet(str(root / "anio=2019" / "mes=04"))
    (root / "bad_key").mkdir()
    spark.range(1).write.parquet(str(root / "bad_key" / "x"))
    assert sorted(map(tuple, raw_periods(spark, str(root), nonempty_only=True).collect())) == [("2019", "04")]
    assert list_files(spark, str(root)).count() >= 3


def test_missing_periods_calendar(spark):
    present = spark.createDataFrame([("fhvhv", "2019", "03")], "formato string, anio string, mes string")
    exp = expected_periods(spark, ["fhvhv"], "2019-06")
    got = sorted(map(tuple, missing_periods(exp, present).select("formato", "anio", "mes").collect()))
    assert got == [("fhvhv", "2019", "02"), ("fhvhv", "2019", "04"), ("fhvhv", "2019", "05")]


def test_expand_formats():
    assert expand_formats("taxi") == ["yellow", "green"] and expand_formats(None) == ["yellow", "green", "fhv", "fhvhv"]


def test_clean_job_is_idempotent_and_resumes(spark, tmp_path):
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    write_raw_taxi(spark, SF_SMALL, raw)
    r1 = clean_periods(spark, raw, staging, "taxi", order_by=["trip_key", "trip_line"], keep=["trip_key", "trip_line"])
    first = sorted(map(tuple, read_staging(spark, staging, "taxi").collect()))
    r2 = clean_periods(spark, raw, staging, "taxi")                        # resume: nothing pending
    assert r2 == {"yellow": [], "green": []} and r1["yellow"]
    clean_periods(spark, raw, staging, "taxi", order_by=["trip_key", "trip_line"], keep=["trip_key", "trip_line"],
                  resume=False)                                            # forced rerun replaces, never duplicates
    assert sorted(map(tuple, read_staging(spark, staging, "taxi").collect())) == first


def _rows(df):
    return sorted((tuple((v is not None, v) for v in r) for r in df.collect()), key=repr)


def test_incremental_equals_rebuild_for_all_marts(spark, tmp_path):
    tables = _staging_from_views(spark, SF_SMALL, str(tmp_path / "staging"))
    full, part = str(tmp_path / "full"), str(tmp_path / "part")
    inc.rebuild_marts(spark, tables, full)
    periods = sorted(map(tuple, tables["taxi"].select("anio", "mes").distinct().collect()))[-2:] + [("2024", "01")]
    held = F.lit(False)
    for a, m in periods:
        held = held | ((F.col("anio") == a) & (F.col("mes") == m))
    inc.rebuild_marts(spark, {k: (v.where(~held) if k != "zones" else v) for k, v in tables.items()}, part)
    for a, m in periods:
        rep = inc.append_period(spark, tables, part, a, m)
        assert rep["staging_rows"] > 0
    inc.append_period(spark, tables, part, *periods[0])                   # rerun of a period changes nothing
    for mart in inc.MONTHLY + inc.ANNUAL:
        a, b = inc.read_mart(spark, full, mart), inc.read_mart(spark, part, mart)
        assert _rows(a) == _rows(b.select(*a.columns)), mart


def test_a_list_of_periods_equals_one_by_one(spark, tmp_path):
    tables = _staging_from_views(spark, SF_SMALL, str(tmp_path / "staging"))
    periods = sorted((r["anio"], r["mes"]) for r in inc.rows_per_period(tables).orderBy("anio", "mes").collect())[-3:]
    early = {k: (v.where(~inc.in_periods(periods)) if k != "zones" else v) for k, v in tables.items()}
    for name in ("single", "list"):
        inc.rebuild_marts(spark, early, str(tmp_path / name))
    for a, m in periods:
        inc.append_period(spark, tables, str(tmp_path / "single"), a, m)
    out = inc.append_periods(spark, tables, str(tmp_path / "list"), [(int(a), int(m)) for a, m in periods[::-1]])
    assert out["periodos"] == [f"{a}-{m}" for a, m in periods] and out["skipped"] == []
    for mart in inc.MONTHLY + inc.ANNUAL:
        one, many = (spark.read.parquet(str(tmp_path / n / mart)) for n in ("single", "list"))
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    again = inc.append_periods(spark, tables, str(tmp_path / "list"), periods, skip_if_present=True)
    assert again["periodos"] == [] and len(again["skipped"]) == 3
    with pytest.raises(inc.PeriodMissing, match="1999-01"):
        inc.append_periods(spark, tables, str(tmp_path / "list"), [*periods, ("1999", "01")])


def test_period_guards(spark, tmp_path):
    tables = _staging_from_views(spark, SF_SMALL, str(tmp_path / "staging"))
    mart = str(tmp_path / "mart")
    inc.rebuild_marts(spark, tables, mart)
    try:
        inc.append_period(spark, tables, mart, 1990, 1)
        raise AssertionError("expected PeriodMissing")
    except inc.PeriodMissing:
        pass
    rep = inc.append_period(spark, tables, mart, "2024", "1", skip_if_present=True)
    assert rep["skipped"] and rep["periodo"] == "2024-01"


def test_stream_twice_processes_each_file_once(spark, tmp_path):
    base = str(tmp_path)
    write_raw_fhv(spark, SF_SMALL, f"{base}/raw")
    q = stream_arrivals(spark, f"{base}/raw/fhv", "fhv", f"{base}/staging", f"{base}/ckpt", max_files_per_trigger=1,
                        order_by=["event_id"])
    q.awaitTermination()
    batches = q.lastProgress is not None
    first = _rows(read_staging(spark, f"{base}/staging", "fhv"))
    q2 = stream_arrivals(spark, f"{base}/raw/fhv", "fhv", f"{base}/staging", f"{base}/ckpt")
    q2.awaitTermination()
    assert batches and (q2.lastProgress is None or q2.lastProgress["numInputRows"] == 0)
    assert _rows(read_staging(spark, f"{base}/staging", "fhv")) == first
    # equals the batch job over the same folder
    rows, _ = __import__("triplake.plans.clean", fromlist=["clean"]).clean(
        read_raw(spark, f"{base}/raw/fhv", "fhv", keep=["event_id"]), "fhv", order_by=["event_id"], keep=["event_id"])
    assert len(first) == rows.count()


def test_views_prune_partitions(spark, tmp_path):
    from conftest import plan_text
    from triplake.sources.views import register_views
    tables = _staging_from_views(spark, SF_SMALL, str(tmp_path / "staging"))
    inc.rebuild_marts(spark, tables, str(tmp_path / "mart"))
    names = register_views(spark, str(tmp_path / "staging"), str(tmp_path / "mart"))
    assert {"taxi", "fhv", "fhvhv", "mart_cuota_mercado_mensual", "mart_patrones_temporales"} <= set(names)
    q = spark.sql("SELECT COUNT(*) FROM fhvhv WHERE anio = '2024' AND mes = '01'")
    plan = plan_text(q)
    assert "PartitionFilters: [isnotnull(anio" in plan and q.first()[0] > 0
    # the share count needs no data column at all: Parquet answers from row-group metadata
    share_plan = plan_text(marts.monthly_counts(tables["taxi"], tables["fhvhv"], tables["fhv"]))
    assert "ReadSchema: struct<>" in share_plan


def test_declared_read_of_agreeing_files(spark, tmp_path):
    from triplake.sources.views import read_declared
    t = dt.datetime(2024, 1, 1, 9)
    spark.createDataFrame([("HV0003", t, t)], "hvfhs_license_num string, pickup_datetime timestamp_ntz, "
                                              "dropoff_datetime timestamp_ntz") \
         .write.parquet(str(tmp_path / "fhvhv" / "anio=2024" / "mes=01"))
    r = read_declared(spark, str(tmp_path), "fhvhv").first()
    assert r.hvfhs_license_num == "HV0003" and r.mes == "01" and r.trip_miles is None


def test_cli_clean_rebuild_increment_gaps(spark, tmp_path, capsys):
    from triplake import cli
    from triplake.sources.sinks import write_zone_csv
    raw, staging, mart, zones = (str(tmp_path / x) for x in ("raw", "staging", "mart", "zones"))
    write_raw_taxi(spark, SF_SMALL, raw)
    write_zone_csv(adapter.zones(spark, SF_SMALL), zones)
    cli.main(["clean", "--raw", raw, "--staging", staging, "--formato", "taxi", "--quarantine", str(tmp_path / "q")])
    cli.main(["rebuild", "--staging", staging, "--zones", zones, "--marts", mart])
    cli.main(["increment", "--staging", staging, "--zones", zones, "--marts", mart, "--anio", "2016", "--mes", "3"])
    cli.main(["gaps", "--raw", raw, "--as-of", "2012-01", "--formato", "yellow"])
    cli.main(["audit", "--raw", raw, "--formato", "yellow"])
    import json
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    audit = {r["column_name"]: r for r in lines[4]}
    assert audit["passenger_count"]["drift"] and audit["fare_amount"]["drift"] is False
    assert lines[0]["yellow"] and lines[1]["mart_cuota_mercado_mensual"] > 0
    assert lines[2]["periodo"] == "2016-03" and lines[2]["staging_rows"] > 0
    assert "2009-01" in lines[3]["yellow"]
    assert spark.read.parquet(str(tmp_path / "q" / "green")).count() > 0


def test_source_period_is_a_partition_constant(spark, tmp_path):
    from conftest import plan_text
    root = str(tmp_path / "yellow")
    _write_drifted(spark, root)
    df = read_raw(spark, root, "yellow")
    assert "regexp_extract" not in plan_text(df, "formatted")       # no per-row path parsing
    flat = str(tmp_path / "flat")
    spark.createDataFrame([(1, 2.0)], "vendorid bigint, trip_distance double").write.parquet(flat)
    r = read_raw(spark, flat, "yellow").first()
    assert r.source_anio is None and r.vendorid == 1                 # flat layout: no period, rows kept


def test_stream_merge_mode_equals_batch_clean(spark, tmp_path):
    from triplake.plans.clean import clean
    base = str(tmp_path)
    write_raw_fhv(spark, SF_SMALL, f"{base}/raw")          # two files per month
    q = stream_arrivals(spark, f"{base}/raw/fhv", "fhv", f"{base}/staging", f"{base}/ckpt", max_files_per_trigger=1,
                        merge_staged=True)
    q.awaitTermination()
    streamed = _rows(read_staging(spark, f"{base}/staging", "fhv"))
    rows, _ = clean(read_raw(spark, f"{base}/raw/fhv", "fhv"), "fhv")
    batch = _rows(rows.select(*read_staging(spark, f"{base}/staging", "fhv").columns))
    assert streamed == batch and len(streamed) > 0


def test_hot_period_write_is_split(spark, tmp_path):
    """One period holding nearly all rows is written by several tasks (AQE splits the rebalance)."""
    from triplake.schema import CANONICAL
    from triplake.sources.sinks import write_staging
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in CANONICAL["fhv"].fields if f.name != "dispatching_base_num"]
    df = (spark.range(0, 200_000).select(F.concat(F.lit("B"), F.col("id").cast("string")).alias("dispatching_base_num"),
                                         *cols)
          .withColumn("anio", F.when(F.col("dispatching_base_num") == "B0", "2019").otherwise("2020"))
          .withColumn("mes", F.lit("01")))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_staging(df, str(tmp_path), "fhv")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = [f for f in (tmp_path / "fhv" / "anio=2020" / "mes=01").iterdir() if f.name.endswith(".parquet")]
    assert len(hot) > 1
    assert read_staging(spark, str(tmp_path), "fhv").count() == 200_000


def test_corrupt_file_is_named_not_crashed(spark, tmp_path):
    from triplake.sources.scan import UnreadableFiles
    root = tmp_path / "yellow"
    _write_drifted(spark, str(root))
    bad = root / "anio=2020" / "mes=06"
    bad.mkdir(parents=True)
    (bad / "broken.parquet").write_bytes(b"PAR1 not really parquet")
    try:
        read_raw(spark, str(root), "yellow")
        raise AssertionError("expected UnreadableFiles")
    except UnreadableFiles as e:
        assert "broken.parquet" in str(e)
    assert read_raw(spark, str(root), "yellow", skip_unreadable=True).count() == 3


def test_cli_stream_available_now(spark, tmp_path, capsys):
    from triplake import cli
    raw, staging, ckpt = (str(tmp_path / x) for x in ("raw", "staging", "ckpt"))
    write_raw_fhv(spark, SF_SMALL, raw)
    cli.main(["stream", "--raw", f"{raw}/fhv", "--staging", staging, "--formato", "fhv", "--checkpoint", ckpt,
              "--available-now"])
    assert '"stopped"' in capsys.readouterr().out
    assert read_staging(spark, staging, "fhv").count() > 0


def _raw_month(spark, root, fare: float, n: int = 5):
    rows = [(i, f"2020-01-0{i + 1} 10:00:00", f"2020-01-0{i + 1} 10:30:00", 1.0, fare, 1, 2) for i in range(n)]
    df = spark.createDataFrame(rows, "VendorID int, a string, b string, trip_distance double, fare_amount double, "
                                     "PULocationID int, DOLocationID int")
    df.select("VendorID", F.col("a").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
              F.col("b").cast("timestamp_ntz").alias("tpep_dropoff_datetime"), "trip_distance", "fare_amount",
              "PULocationID", "DOLocationID").coalesce(1).write.mode("overwrite").parquet(
        f"{root}/yellow/anio=2020/mes=01")


def test_forced_rerun_empties_a_period_whose_rows_are_all_rejected(spark, tmp_path):
    from triplake.sources.sinks import read_staging
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    _raw_month(spark, raw, 10.0)
    clean_periods(spark, raw, staging, "yellow")
    assert read_staging(spark, staging, "taxi").count() == 5
    _raw_month(spark, raw, -1.0)                           # every fare negative
    assert clean_periods(spark, raw, staging, "yellow", resume=False, quarantine_root=str(tmp_path / "q")) == {
        "yellow": ["2020-01"]}
    assert read_staging(spark, staging, "taxi").count() == 0
    assert spark.read.parquet(str(tmp_path / "q" / "yellow")).count() == 5


def test_skipped_unreadable_month_stays_pending(spark, tmp_path):
    raw, staging = tmp_path / "raw", str(tmp_path / "staging")
    _raw_month(spark, str(raw), 10.0)
    bad = raw / "yellow" / "anio=2020" / "mes=02"
    bad.mkdir(parents=True)
    (bad / "x.parquet").write_bytes(b"not parquet at all")
    first = clean_periods(spark, str(raw), staging, "yellow", skip_unreadable=True)
    assert len(first["yellow_unreadable"]) == 1 and "mes=02" in first["yellow_unreadable"][0]
    (bad / "x.parquet").unlink()
    spark.read.parquet(str(raw / "yellow" / "anio=2020" / "mes=01")).write.mode("overwrite").parquet(str(bad))
    assert clean_periods(spark, str(raw), staging, "yellow")["yellow"] == ["2020-02"]   # processed on the next run


def _second_month(spark, raw):
    spark.read.parquet(f"{raw}/yellow/anio=2020/mes=01").withColumns(
        {c: F.col(c) + F.expr("INTERVAL 1 MONTH") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    ).coalesce(1).write.mode("overwrite").parquet(f"{raw}/yellow/anio=2020/mes=02")


def _staged(spark, staging):
    return sorted((r.anio, r.mes, r["count"]) for r in read_staging(spark, staging, "taxi").groupBy(
        "anio", "mes").count().collect())


def test_unreadable_month_keeps_its_staged_rows_and_quarantine(spark, tmp_path):
    raw, staging, q = tmp_path / "raw", str(tmp_path / "staging"), str(tmp_path / "q")
    _raw_month(spark, str(raw), 10.0)
    _second_month(spark, str(raw))
    clean_periods(spark, str(raw), staging, "yellow", quarantine_root=q)
    for f in (raw / "yellow" / "anio=2020" / "mes=02").glob("*.parquet"):
        f.write_bytes(b"not parquet")
    again = clean_periods(spark, str(raw), staging, "yellow", resume=False, skip_unreadable=True, quarantine_root=q)
    assert again["yellow"] == ["2020-01"] and "mes=02" in again["yellow_unreadable"][0]
    assert _staged(spark, staging) == [("2020", "01", 5), ("2020", "02", 5)]


@pytest.mark.parametrize("moves", range(4))
def test_a_run_that_ends_inside_its_commit_is_finished_by_the_next(spark, tmp_path, monkeypatch, moves):
    """Two periods with staging and quarantine to replace: eight moves, ended at one of them."""
    from triplake.sources import commit
    raw, staging, q = str(tmp_path / "raw"), str(tmp_path / "staging"), str(tmp_path / "q")
    _raw_month(spark, raw, 10.0)
    _second_month(spark, raw)
    clean_periods(spark, raw, staging, "yellow", quarantine_root=q)
    _raw_month(spark, raw, -1.0)                           # January is now rejected, all of it
    left, move = [moves], commit.Folders.move

    def ending(self, source, target):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        move(self, source, target)
    monkeypatch.setattr(commit.Folders, "move", ending)
    with pytest.raises(KeyboardInterrupt):
        clean_periods(spark, raw, staging, "yellow", resume=False, quarantine_root=q)
    monkeypatch.setattr(commit.Folders, "move", move)
    assert commit.recover(spark, staging, q) == 1 and commit.recover(spark, staging, q) == 0
    assert _staged(spark, staging) == [("2020", "02", 5)]
    assert spark.read.parquet(f"{q}/yellow").where("mes = '01'").count() == 5


def test_a_run_that_ends_before_its_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    from triplake.plans import clean as plan
    from triplake.sources import commit
    raw, staging, q = str(tmp_path / "raw"), str(tmp_path / "staging"), str(tmp_path / "q")
    _raw_month(spark, raw, 10.0)
    clean_periods(spark, raw, staging, "yellow", quarantine_root=q)
    _raw_month(spark, raw, -1.0)

    def failing(*_):
        raise OSError("no space for the quarantine")
    with monkeypatch.context() as m:
        m.setattr(plan, "write_quarantine", failing)       # between staging and quarantine
        with pytest.raises(OSError):
            clean_periods(spark, raw, staging, "yellow", resume=False, quarantine_root=q)
    assert _staged(spark, staging) == [("2020", "01", 5)]
    assert commit.recover(spark, staging, q) == 0 and _staged(spark, staging) == [("2020", "01", 5)]
    assert clean_periods(spark, raw, staging, "yellow", resume=False, quarantine_root=q)["yellow"] == ["2020-01"]
    assert _staged(spark, staging) == []


def test_a_lost_staging_table_stops_a_rebuild(spark, tmp_path):
    import shutil
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    write_raw_fhv(spark, SF_SMALL, raw)
    _raw_month(spark, raw, 10.0)
    for fmt in ("fhv", "yellow"):
        clean_periods(spark, raw, staging, fmt)
    zones = adapter.zones(spark, SF_SMALL)
    assert inc.load_staging(spark, staging, zones)["fhvhv"].count() == 0            # never cleaned: empty
    shutil.move(f"{staging}/fhv", f"{tmp_path}/elsewhere")
    with pytest.raises(FileNotFoundError, match="fhv"):
        inc.load_staging(spark, staging, zones)


def test_tables_are_put_back_when_a_swap_fails(spark, tmp_path):
    from triplake.sources.sinks import swap_in
    for name in ("a", "b", "new_a"):
        spark.range(1 if name.startswith("new") else 2).write.parquet(f"{tmp_path}/{name}")
    with pytest.raises(Exception):                         # new_b does not exist
        swap_in(spark, [(f"{tmp_path}/new_a", f"{tmp_path}/a"), (f"{tmp_path}/new_b", f"{tmp_path}/b")])
    assert [spark.read.parquet(f"{tmp_path}/{n}").count() for n in ("a", "b", "new_a")] == [2, 2, 1]


def test_rebuild_from_a_wrong_staging_path_keeps_the_marts(spark, tmp_path):
    from triplake.plans import incremental as inc
    from triplake.sources import adapter
    with pytest.raises(FileNotFoundError):
        inc.load_staging(spark, str(tmp_path / "nothing"), adapter.zones(spark, SF_SMALL))


def test_cleaning_pushes_the_year_window_to_the_scan(spark, tmp_path):
    from triplake.plans.clean import clean
    from triplake.sources.scan import read_raw
    raw = str(tmp_path / "raw")
    _raw_month(spark, raw, 10.0)
    plan = plan_text(clean(read_raw(spark, f"{raw}/yellow", "yellow"), "yellow")[0])
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan and "LessThan" in plan


def test_state_skips_nan_and_values_beyond_the_decimal(spark):
    from triplake.plans import incremental as inc
    df = spark.createDataFrame([("2020", 1.0), ("2020", float("nan")), ("2020", 1e17)], "anio string, tarifa double")
    r = df.groupBy("anio").agg(inc._exact_sum("tarifa").alias("s"), inc._exact_count("tarifa").alias("c")).first()
    assert float(r.s) == 1.0 and r.c == 1


def _span(spark, root, period: str, pickups: list[str]):
    """A yellow file of ``period`` with trips of the given days."""
    a, m = period.split("-")
    spark.createDataFrame([(i, d, 10.0) for i, d in enumerate(pickups)], "VendorID int, d string, fare_amount double") \
        .select("VendorID", F.col("d").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
                F.expr("CAST(d AS TIMESTAMP_NTZ) + INTERVAL 1 HOUR").alias("tpep_dropoff_datetime"), "fare_amount") \
        .coalesce(1).write.mode("overwrite").parquet(f"{root}/yellow/anio={a}/mes={m}")


def _two_spanning_files(spark, root):
    _span(spark, root, "2020-05", ["2020-04-30", "2020-05-01", "2020-05-02"])
    _span(spark, root, "2020-06", ["2020-05-31", "2020-06-01"])


def test_rows_staged_by_pickup_month_are_replaced_by_file(spark, tmp_path):
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    _two_spanning_files(spark, raw)
    first = clean_periods(spark, raw, staging, "yellow", period="pickup")
    assert first == {"yellow": ["2020-05", "2020-06"], "yellow_touched": ["2020-04", "2020-05", "2020-06"]}
    assert _staged(spark, staging) == [("2020", "04", 1), ("2020", "05", 3), ("2020", "06", 1)]
    assert clean_periods(spark, raw, staging, "yellow", period="pickup") == {"yellow": []}      # by file month
    _span(spark, raw, "2020-05", ["2020-05-07", "2020-07-01"])          # April's row goes, the other file's rows stay
    again = clean_periods(spark, raw, staging, "yellow", "2020", "5", resume=False, period="pickup")
    assert again["yellow_touched"] == ["2020-04", "2020-05", "2020-07"]
    assert _staged(spark, staging) == [("2020", "05", 2), ("2020", "06", 1), ("2020", "07", 1)]
    assert read_staging(spark, staging, "taxi").columns[-2:] == ["anio", "mes"]


def test_one_staging_table_has_one_layout(spark, tmp_path):
    from triplake.sources.sinks import MixedLayout
    raw = str(tmp_path / "raw")
    _two_spanning_files(spark, raw)
    for first, second in (("file", "pickup"), ("pickup", "file")):
        staging = str(tmp_path / first)
        clean_periods(spark, raw, staging, "yellow", period=first)
        before = _staged(spark, staging)
        with pytest.raises(MixedLayout):
            clean_periods(spark, raw, staging, "yellow", resume=False, period=second)
        assert _staged(spark, staging) == before


def test_a_file_without_rows_left_is_logged_by_pickup_too(spark, tmp_path):
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    _span(spark, raw, "2020-05", ["1999-01-01"])
    assert clean_periods(spark, raw, staging, "yellow", period="pickup") == {"yellow": ["2020-05"], "yellow_touched": []}
    assert clean_periods(spark, raw, staging, "yellow", period="pickup") == {"yellow": []}


def test_stream_by_pickup_month_equals_the_job(spark, tmp_path):
    raw, staging, streamed = str(tmp_path / "raw"), str(tmp_path / "staging"), str(tmp_path / "streamed")
    _two_spanning_files(spark, raw)
    clean_periods(spark, raw, staging, "yellow", period="pickup")
    stream_arrivals(spark, f"{raw}/yellow", "yellow", streamed, str(tmp_path / "cp"), max_files_per_trigger=1,
                    period="pickup").awaitTermination()
    assert _rows(read_staging(spark, streamed, "taxi")) == _rows(read_staging(spark, staging, "taxi"))
    with pytest.raises(ValueError, match="file period"):
        stream_arrivals(spark, f"{raw}/yellow", "yellow", streamed, str(tmp_path / "cp2"), merge_staged=True,
                        period="pickup")


def test_merge_mode_finishes_what_a_lost_batch_left(spark, tmp_path, monkeypatch):
    """The batch ends between its moves; replayed, it finds whole periods and adds nothing twice."""
    from triplake.sources import commit
    from triplake.sources.files import list_files
    from triplake.streaming.arrivals import merge_new_files
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    _raw_month(spark, raw, 10.0)
    merge_new_files(spark, list_files(spark, f"{raw}/yellow"), "yellow", staging)
    _raw_month(spark, raw, 20.0)
    new, move, left = list_files(spark, f"{raw}/yellow"), commit.Folders.move, [1]

    def ending(self, source, target):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        move(self, source, target)
    monkeypatch.setattr(commit.Folders, "move", ending)
    with pytest.raises(OSError, match="lost"):
        merge_new_files(spark, new, "yellow", staging)
    monkeypatch.setattr(commit.Folders, "move", move)
    merge_new_files(spark, new, "yellow", staging)
    assert _staged(spark, staging) == [("2020", "01", 10)]


def _fhv_file(spark, path, rows):
    """One fhv raw file of (base, pickup day) under a fixed name; day 0 has no pickup time and is rejected."""
    from triplake.sources.commit import Folders
    made = f"{path}-made"
    df = spark.createDataFrame([(b, f"2020-01-{d:02d} 10:00:00" if d else None) for b, d in rows], "b string, t string")
    at = F.col("t").cast("timestamp_ntz")
    df.select(F.col("b").alias("dispatching_base_num"), at.alias("pickup_datetime"),
              (at + F.expr("INTERVAL 10 MINUTE")).alias("dropoff_datetime"), F.lit(1).alias("PUlocationID"),
              F.lit(2).alias("DOlocationID")).coalesce(1).write.parquet(made)
    folders = Folders(spark)
    name = next(n for n in folders.names(made) if n.endswith(".parquet"))
    folders.delete(path)
    folders.move(f"{made}/{name}", path)
    folders.delete(made)


def _bases(spark, staging, quarantine):
    from triplake.plans.clean import read_quarantine
    return (sorted(r[0] for r in read_staging(spark, staging, "fhv").select("dispatching_base_num").collect()),
            sorted(r[0] for r in read_quarantine(spark, quarantine, "fhv").select("dispatching_base_num").collect()))


def test_merge_mode_knows_its_files(spark, tmp_path):
    """Unchanged files add nothing, a replaced one takes its rows along (not those another file has too)."""
    from triplake.sources.files import list_files
    from triplake.streaming.arrivals import FilesGone, merge_new_files
    raw, staging, q = str(tmp_path / "raw" / "fhv"), str(tmp_path / "staging"), str(tmp_path / "q")
    month = f"{raw}/anio=2020/mes=01"

    def merge():
        return merge_new_files(spark, list_files(spark, raw), "fhv", staging, q)
    _fhv_file(spark, f"{month}/a.parquet", [("both", 1), ("a", 1), ("bad-a", 0)])
    assert merge() == [("2020", "01")]
    _fhv_file(spark, f"{month}/b.parquet", [("both", 1), ("b", 1), ("bad-b", 0)])
    _fhv_file(spark, f"{raw}/anio=2020/mes=02/a.parquet", [("feb", 2)])
    assert merge() == [("2020", "01"), ("2020", "02")]
    first = ["a", "b", "both", "feb"], ["bad-a", "bad-b"]
    assert _bases(spark, staging, q) == first
    assert merge() == [] and _bases(spark, staging, q) == first          # replayed: nothing is added twice
    _fhv_file(spark, f"{month}/a.parquet", [("new", 1), ("bad-new", 0), ("bad-new", 0)])
    assert merge() == [("2020", "01")]
    assert _bases(spark, staging, q) == (["b", "both", "feb", "new"], ["bad-b", "bad-new", "bad-new"])
    # a stream's own list goes by name; what was replaced is found when it starts
    job = dict(merge_staged=True, quarantine_root=q)
    stream_arrivals(spark, raw, "fhv", staging, str(tmp_path / "cp"), **job).awaitTermination()
    _fhv_file(spark, f"{month}/a.parquet", [("new", 1), ("newer", 1)])
    stream_arrivals(spark, raw, "fhv", staging, str(tmp_path / "cp"), **job).awaitTermination()
    assert _bases(spark, staging, q) == (["b", "both", "feb", "new", "newer"], ["bad-b"])
    # with another file gone its rows could not be made again: nothing changes
    (tmp_path / "raw" / "fhv" / "anio=2020" / "mes=01" / "b.parquet").unlink()
    _fhv_file(spark, f"{month}/a.parquet", [("late", 1)])
    with pytest.raises(FilesGone, match="b.parquet"):
        merge()
    assert _bases(spark, staging, q) == (["b", "both", "feb", "new", "newer"], ["bad-b"])


def test_merge_mode_cleans_a_month_of_another_job_whole(spark, tmp_path):
    from triplake.sources.commit import logged_files
    from triplake.sources.files import list_files
    from triplake.streaming.arrivals import merge_new_files
    raw, staging, q = str(tmp_path / "raw"), str(tmp_path / "staging"), str(tmp_path / "q")
    month, periods = f"{raw}/fhv/anio=2020/mes=01", [("2020", "01")]
    _fhv_file(spark, f"{month}/a.parquet", [("a", 1), ("bad-a", 0)])
    clean_periods(spark, raw, staging, "fhv", quarantine_root=q)
    _fhv_file(spark, f"{month}/b.parquet", [("b", 1)])
    assert merge_new_files(spark, list_files(spark, f"{raw}/fhv"), "fhv", staging, q) == periods
    assert _bases(spark, staging, q) == (["a", "b"], ["bad-a"])
    assert logged_files(spark, staging, "fhv", periods).count() == 2
    clean_periods(spark, raw, staging, "fhv", quarantine_root=q, resume=False)
    assert logged_files(spark, staging, "fhv", periods).count() == 0     # whole periods keep no file log
    assert _bases(spark, staging, q) == (["a", "b"], ["bad-a"])


def test_tasks_are_bounded_for_trip_queries_only(spark):
    import __spark_entry__ as e
    from conftest import SF_SMALL
    from triplake.session import FIRST_PARTITIONS, bound_tasks
    first, writers = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    try:
        e.queries()["rule_flags"](spark, SF_SMALL)
        assert int(spark.conf.get(first)) == FIRST_PARTITIONS and spark.conf.get(writers) == "2"
        e.queries()["op6_bpe"](spark, SF_SMALL)
        assert spark.conf.get(writers) == before and spark.conf.get(first, None) is None
    finally:
        bound_tasks(spark, False)


def test_jobs_at_once_return_in_order_and_raise():
    import time
    from triplake.session import at_once
    assert at_once(lambda: (time.sleep(0.2), 1)[1], lambda: 2) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        at_once(lambda: 1 / 0, lambda: 2)


def test_stream_batches_run_in_the_session_of_the_caller(spark, tmp_path, monkeypatch):
    from triplake.streaming import arrivals
    spark.range(3).write.parquet(str(tmp_path / "raw/anio=2024/mes=01"))
    seen = []
    monkeypatch.setattr(arrivals, "clean_touched_periods", lambda s, batch, *a: seen.append(
        (s is spark, s.conf.get("spark.sql.adaptive.enabled"))))
    monkeypatch.setattr(arrivals, "merge_new_files", lambda s, batch, *a: seen.append(
        (s is spark, s.conf.get("spark.sql.adaptive.enabled"))))
    for n, merge in enumerate((False, True)):
        arrivals.stream_arrivals(spark, str(tmp_path / "raw"), "fhv", str(tmp_path / "staging"), str(tmp_path / f"c{n}"),
                                 merge_staged=merge).awaitTermination()
    assert seen and all(x == (True, "true") for x in seen)
