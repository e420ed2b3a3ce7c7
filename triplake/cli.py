"""Command-line jobs (run with spark-submit or python -m triplake.cli ...).

  clean      raw -> staging for a format ('taxi' = yellow + green; default all), optionally one year/month
  rebuild    every mart from the whole staging
  increment  one period of the monthly marts and the annual marts' state
  gaps       expected months per format minus the months present in the raw folders
  audit      physical Parquet types per column across a format's raw files vs its declared types (E2)
  stream     keep cleaning files as they land (or once, with --available-now)

Each prints a JSON report.  The session comes from spark-submit; result-relevant settings are applied.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from triplake.plans import incremental as inc
from triplake.plans.clean import clean_periods, expand_formats
from triplake.session import build_session
from triplake.sources.files import expected_periods, missing_periods, raw_periods
from triplake.sources.sinks import read_zone_csv
from triplake.streaming.arrivals import stream_arrivals


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="triplake")
    ap.add_argument("--cluster", action="store_true", help="apply the large-cluster sizing settings")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--raw", required=True)
    c.add_argument("--staging", required=True)
    c.add_argument("--formato")
    c.add_argument("--anio")
    c.add_argument("--mes")
    c.add_argument("--force", action="store_true", help="reprocess periods already staged")
    c.add_argument("--quarantine", help="folder for rejected rows with their reason")
    c.add_argument("--period", choices=("file", "pickup"), default="file", help="month a row is staged in")
    c.add_argument("--skip-unreadable", action="store_true", help="leave out files without a readable footer")
    r = sub.add_parser("rebuild")
    i = sub.add_parser("increment")
    for p in (r, i):
        p.add_argument("--staging", required=True)
        p.add_argument("--zones", required=True, help="zone lookup CSV")
        p.add_argument("--marts", required=True)
    i.add_argument("--anio", required=True)
    i.add_argument("--mes", required=True)
    i.add_argument("--skip-if-present", action="store_true")
    g = sub.add_parser("gaps")
    g.add_argument("--raw", required=True)
    g.add_argument("--as-of", required=True, help="report month YYYY-MM (months before it are expected)")
    g.add_argument("--formato")
    au = sub.add_parser("audit")
    au.add_argument("--raw", required=True)
    au.add_argument("--formato", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--raw", required=True, help="landing folder of one format")
    s.add_argument("--staging", required=True)
    s.add_argument("--formato", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--period", choices=("file", "pickup"), default="file", help="month a row is staged in")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--merge", action="store_true", help="merge new files into staged months instead of cleaning them anew")
    s.add_argument("--quarantine", help="keep rejected rows here")
    a = ap.parse_args(argv)

    spark = build_session(app=f"triplake-{a.cmd}", cluster=a.cluster)
    if a.cmd == "clean":
        out = clean_periods(spark, a.raw, a.staging, a.formato, a.anio, a.mes, resume=not a.force,
                            quarantine_root=a.quarantine, skip_unreadable=a.skip_unreadable, period=a.period)
    elif a.cmd == "rebuild":
        out = inc.rebuild_marts(spark, inc.load_staging(spark, a.staging, read_zone_csv(spark, a.zones)), a.marts)
    elif a.cmd == "increment":
        tables = inc.period_tables(spark, a.staging, read_zone_csv(spark, a.zones), a.anio, a.mes)
        out = inc.append_period(spark, tables, a.marts, a.anio, a.mes, skip_if_present=a.skip_if_present)
    elif a.cmd == "gaps":
        fmts = expand_formats(a.formato)
        present = None
        for f in fmts:
            p = raw_periods(spark, f"{a.raw.rstrip('/')}/{f}", nonempty_only=True).select(F.lit(f).alias("formato"), "*")
            present = p if present is None else present.unionByName(p)
        gaps = missing_periods(expected_periods(spark, fmts, a.as_of), present)
        out = {f: [] for f in fmts}
        for row in gaps.collect():                                   # a month list per format
            out[row["formato"]].append(row["periodo"])
    elif a.cmd == "audit":
        from triplake.schema import RAW_DECLARED
        from triplake.sources.scan import footers, type_drift
        d = type_drift(footers(spark, f"{a.raw.rstrip('/')}/{a.formato}"), dict(RAW_DECLARED[a.formato]))
        out = [r.asDict() for r in d.orderBy("column_name").collect()]     # one row per column
    else:
        q = stream_arrivals(spark, a.raw, a.formato, a.staging, a.checkpoint, available_now=a.available_now,
                            period=a.period, merge_staged=a.merge, quarantine_root=a.quarantine)
        q.awaitTermination()
        out = {"stream": "stopped"}
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
