"""Full rebuild and one-period increments of the marts.

Storage under ``mart_root``:
  mart_cuota_mercado_mensual/anio=/mes=/      monthly, replaced per period
  mart_kpis_financieros/anio=/mes=/           monthly, replaced per period
  state_demanda_territorial/anio=/mes=/       monthly (sum, count) state of the annual demand mart
  state_patrones_temporales/anio=/mes=/       monthly (sum, count) state of the annual time mart
  mart_demanda_territorial/anio=/             annual, finalised from the state, replaced per year
  mart_patrones_temporales/anio=/             annual, finalised from the state, replaced per year

Annual marts hold averages, which cannot be merged; the state holds exact decimal sums and
counts, so finalising after any sequence of increments gives the same table as a rebuild.
Every write replaces only the partitions it carries, so reruns are idempotent (no guard
that refuses a retry, no duplicate rows on ``force``).
"""

from __future__ import annotations

import uuid
from functools import partial, reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.functions.numeric import ratio, round2
from triplake.operators import marts
from triplake.schema import STAGING_TABLE
from triplake.session import at_once
from triplake.sources.commit import Folders
from triplake.sources.sinks import read_staging, staged_tables, swap_in, write_table

STATE_SUM = "decimal(22,6)"   # exact for amounts and distances with up to 6 decimals

MONTHLY = ("mart_cuota_mercado_mensual", "mart_kpis_financieros")
ANNUAL = ("mart_demanda_territorial", "mart_patrones_temporales")
STATE = {"mart_demanda_territorial": "state_demanda_territorial",
         "mart_patrones_temporales": "state_patrones_temporales"}


class EmptyRebuild(RuntimeError):
    """Staging holds no rows: the existing marts are kept."""


class PeriodMissing(RuntimeError):
    """Staging has no rows for the requested period."""


def load_staging(spark: SparkSession, staging_root: str, zones: DataFrame) -> dict[str, DataFrame]:
    """The staging tables; a table that no format was cleaned into yet is empty. A root without any table, or a missing
    table of a format that the processed-periods log knows, is an error."""
    from triplake.plans.clean import processed_log
    present = staged_tables(spark, staging_root)
    if not present:
        raise FileNotFoundError(f"no staging table ({', '.join(sorted(set(STAGING_TABLE.values())))}) in {staging_root}")
    lost = sorted({t for f, t in STAGING_TABLE.items() if t not in present
                   and Folders(spark).exists(processed_log(staging_root, f))})
    if lost:
        raise FileNotFoundError(f"cleaned before, but missing in {staging_root}: {', '.join(lost)}")
    return {"taxi": read_staging(spark, staging_root, "taxi"), "fhvhv": read_staging(spark, staging_root, "fhvhv"),
            "fhv": read_staging(spark, staging_root, "fhv"), "zones": zones}


def period_tables(spark: SparkSession, staging_root: str, zones: DataFrame, anio, mes) -> dict[str, DataFrame]:
    """The three staging tables restricted to one period by folder (S5: no listing of other periods)."""
    from triplake.sources.sinks import read_staging_period
    anio, mes = normalise_period(anio, mes)
    return {t: read_staging_period(spark, staging_root, t, anio, mes) for t in ("taxi", "fhvhv", "fhv")} | \
        {"zones": zones}


def _exact_sum(c) -> F.Column:
    return F.sum(F.col(c).try_cast(STATE_SUM))


def _exact_count(c) -> F.Column:
    """Values that the exact sum holds: NaN and values beyond the decimal are neither summed nor counted."""
    return F.count(F.col(c).try_cast(STATE_SUM))


# ------------------------------------------------------------------ monthly state of the annual marts
def demand_state(taxi: DataFrame, fhvhv: DataFrame, zones: DataFrame) -> DataFrame:
    """Monthly labelled (count, exact sums, counts) of the demand mart."""
    trips = marts.demand_trips(taxi, fhvhv, extra=("mes",))
    return marts.label_demand(marts.demand_by_ids(trips, extra=("mes",), exact=STATE_SUM), zones, extra=("mes",))


def finalize_demand(state: DataFrame) -> DataFrame:
    keys = ["anio", "tipo_servicio", "pu_borough", "pu_zone", "do_borough", "do_zone"]
    agg = state.groupBy(*keys).agg(F.sum("total_viajes").cast("bigint").alias("total_viajes"),
                                   F.sum("s_millas").alias("s_millas"), F.sum("c_millas").alias("c_millas"),
                                   F.sum("s_monto").alias("s_monto"))
    return marts.finish_demand(agg)


def temporal_state(taxi: DataFrame, fhvhv: DataFrame) -> DataFrame:
    trips = marts.temporal_trips(taxi, fhvhv)
    keys = ["anio", "mes"] + marts.TEMPORAL_KEYS[1:]
    return trips.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_viajes"),
                                    _exact_sum("tarifa").alias("s_tarifa"), _exact_count("tarifa").alias("c_tarifa"),
                                    _exact_sum("distancia").alias("s_distancia"),
                                    _exact_count("distancia").alias("c_distancia"))


def finalize_temporal(state: DataFrame) -> DataFrame:
    agg = state.groupBy(*marts.TEMPORAL_KEYS).agg(
        F.sum("total_viajes").alias("total_viajes"), F.sum("s_tarifa").alias("s_tarifa"),
        F.sum("c_tarifa").alias("c_tarifa"), F.sum("s_distancia").alias("s_distancia"),
        F.sum("c_distancia").alias("c_distancia"))
    return agg.select(*marts.TEMPORAL_KEYS, F.col("total_viajes").cast("bigint").alias("total_viajes"),
                      round2(ratio("s_tarifa", "c_tarifa")).alias("tarifa_promedio"),
                      round2(ratio("s_distancia", "c_distancia")).alias("distancia_promedio_millas"))


# ------------------------------------------------------------------ jobs
def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _monthly_and_state(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"mart_cuota_mercado_mensual": marts.market_share(t["taxi"], t["fhvhv"], t["fhv"]),
            "mart_kpis_financieros": marts.financial_kpis(t["taxi"], t["fhvhv"]),
            "state_demanda_territorial": demand_state(t["taxi"], t["fhvhv"], t["zones"]),
            "state_patrones_temporales": temporal_state(t["taxi"], t["fhvhv"])}


def _finalize(spark: SparkSession, mart_root: str, years: list[str] | None) -> dict[str, int]:
    # a year whose state became empty is emptied too
    """Annual marts from the monthly state: the given years, or every year (a full rebuild)."""
    def write(mart: str, fin) -> int:
        st = spark.read.parquet(_path(mart_root, STATE[mart]))
        if years is not None:
            st = st.where(F.col("anio").isin(years))
        return write_table(fin(st), _path(mart_root, mart), ["anio"], static=years is None,
                           folders=[f"anio={y}" for y in years or ()])
    finals = {"mart_demanda_territorial": finalize_demand, "mart_patrones_temporales": finalize_temporal}
    return dict(zip(finals, at_once(*(partial(write, mart, fin) for mart, fin in finals.items())), strict=True))


def rebuild_marts(spark: SparkSession, tables: dict[str, DataFrame], mart_root: str) -> dict[str, int]:
    """Every mart and state from the whole staging; tables are replaced; rows written per table.

    Everything is built in a folder of its own and put in place only when it is complete and not empty.
    """
    report, new = {}, f"{mart_root.rstrip('/')}/_rebuild-{uuid.uuid4().hex}"
    frames = _monthly_and_state(tables)

    def write(name: str) -> int:
        return write_table(frames[name], _path(new, name), ["anio", "mes"], static=True)
    first, *others = frames
    report[first] = write(first)
    if not report[first]:
        raise EmptyRebuild("no staging rows: the marts are left as they are")
    report |= zip(others, at_once(*(partial(write, name) for name in others)), strict=True)
    report.update(_finalize(spark, new, None))
    swap_in(spark, [(_path(new, name), _path(mart_root, name)) for name in (*MONTHLY, *STATE.values(), *ANNUAL)])
    return {m: report[m] for m in MONTHLY + ANNUAL}


def staging_rows_for_period(tables: dict[str, DataFrame], anio: str, mes: str) -> int:
    """Rows of the period in the three staging tables (partition-pruned), summed."""
    cond = (F.col("anio") == anio) & (F.col("mes") == mes)
    u = None
    for k in ("taxi", "fhvhv", "fhv"):
        part = tables[k].where(cond).select(F.lit(1).alias("one"))
        u = part if u is None else u.unionByName(part)
    return u.count()


def rows_per_period(tables: dict[str, DataFrame]) -> DataFrame:
    """J5 for every period at once: rows of the three staging tables per (anio, mes), summed."""
    u = None
    for k in ("taxi", "fhvhv", "fhv"):
        part = tables[k].select("anio", "mes")
        u = part if u is None else u.unionByName(part)
    return u.groupBy("anio", "mes").agg(F.count(F.lit(1)).alias("total_filas"))


def normalise_period(anio, mes) -> tuple[str, str]:
    return str(anio).strip(), str(mes).strip().zfill(2)


def in_periods(periods) -> F.Column:
    """The rows of these (anio, mes): partition filters, one for each year."""
    years: dict[str, list[str]] = {}
    for a, m in periods:
        years.setdefault(a, []).append(m)
    return reduce(or_, ((F.col("anio") == a) & F.col("mes").isin(ms) for a, ms in sorted(years.items())), F.lit(False))


def append_periods(spark: SparkSession, tables: dict[str, DataFrame], mart_root: str, periods,
                   skip_if_present: bool = False) -> dict:
    """S12 for a list of periods: each monthly mart and state is computed once over all of them, and each year they
    touch is finalised once. A period without staging rows raises (C1) before anything is written."""
    periods = sorted({normalise_period(a, m) for a, m in periods})
    chosen = {k: (v.where(in_periods(periods)) if k != "zones" else v) for k, v in tables.items()}
    counted = {(r.anio, r.mes): r.total_filas for r in rows_per_period(chosen).collect()}     # a period list
    empty = [f"{a}-{m}" for a, m in periods if (a, m) not in counted]
    if empty:
        raise PeriodMissing(f"no staging rows for {', '.join(empty)}")
    skipped = []
    if skip_if_present:                                                            # C2, opt-in only
        skipped = _present(spark, mart_root, periods)
        periods = [p for p in periods if p not in skipped]
        chosen = {k: (v.where(in_periods(periods)) if k != "zones" else v) for k, v in tables.items()}
    report = {"periodos": [f"{a}-{m}" for a, m in periods], "skipped": [f"{a}-{m}" for a, m in skipped],
              "staging_rows": {f"{a}-{m}": n for (a, m), n in sorted(counted.items())}}
    if not periods:
        return report
    frames = _monthly_and_state(chosen)
    rows = at_once(*(partial(write_table, df, _path(mart_root, name), ["anio", "mes"],
                             folders=[f"anio={a}/mes={m}" for a, m in periods]) for name, df in frames.items()))
    report.update((name, n) for name, n in zip(frames, rows, strict=True) if name in MONTHLY)
    report.update(_finalize(spark, mart_root, sorted({a for a, _ in periods})))
    return report


def _present(spark: SparkSession, mart_root: str, periods) -> list[tuple[str, str]]:
    """Which of these periods the share mart holds, from its folders."""
    folders = Folders(spark)
    mart = _path(mart_root, "mart_cuota_mercado_mensual")
    return [(a, m) for a, m in periods if folders.exists(f"{mart}/anio={a}/mes={m}")]


def append_period(spark: SparkSession, tables: dict[str, DataFrame], mart_root: str, anio, mes,
                  skip_if_present: bool = False) -> dict:
    """Recompute one period of the monthly marts and state, then re-finalise that year."""
    out = append_periods(spark, tables, mart_root, [(anio, mes)], skip_if_present)
    period, = out.pop("staging_rows").items()
    skipped = bool(out.pop("skipped"))
    out.pop("periodos")
    return {"periodo": period[0], "skipped": skipped, "staging_rows": period[1], **out}


def read_mart(spark: SparkSession, mart_root: str, mart: str) -> DataFrame:
    df = spark.read.parquet(_path(mart_root, mart))
    cols = marts.KPI_COLUMNS if mart == "mart_kpis_financieros" else None
    return df.select(*cols) if cols else df
