"""Named queries: (spark, sf_dir) -> DataFrame, one per inventory item the checker compares."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from triplake.operators import marts
from triplake.sources import adapter

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark, root):
    return adapter.trip_tables(spark, root)


def q_market_share(spark, root):
    t = _t(spark, root)
    return marts.market_share(t["taxi"], t["fhvhv"], t["fhv"])


def q_financial_kpis(spark, root):
    t = _t(spark, root)
    return marts.financial_kpis(t["taxi"], t["fhvhv"])


def q_app_kpis(spark, root):
    return marts.app_kpis(adapter.trips_fhvhv(spark, root))


def q_territorial(spark, root):
    t = _t(spark, root)
    return marts.territorial_demand(t["taxi"], t["fhvhv"], t["zones"])


def q_temporal(spark, root):
    t = _t(spark, root)
    return marts.temporal_patterns(t["taxi"], t["fhvhv"])


QUERIES: dict[str, Query] = {
    "market_share_monthly": q_market_share,
    "financial_kpis_monthly": q_financial_kpis,
    "app_kpis_monthly": q_app_kpis,
    "territorial_demand": q_territorial,
    "temporal_patterns": q_temporal,
}


def queries() -> dict[str, Query]:
    from triplake import catalog_analysis, catalog_jobs, catalog_rules
    out = dict(QUERIES)
    out.update(catalog_rules.QUERIES)
    out.update(catalog_analysis.QUERIES)
    out.update(catalog_jobs.QUERIES)
    return out
