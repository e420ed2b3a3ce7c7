"""Write the final (post-AQE) formatted physical plan of key queries to docs/plans/<name>.txt.

usage: python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from triplake import catalog  # noqa: E402
from triplake.session import build_session  # noqa: E402

KEY = ["market_share_monthly", "financial_kpis_monthly", "territorial_demand", "temporal_patterns",
       "clean_taxi_staging", "dedup_yellow", "profile_accounting_gap", "question_year_on_year"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    for name in KEY:
        df = catalog.queries()[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        text = re.sub(r"file:/[^,\]\s]*/", "file:.../", text)
        with open(os.path.join(out, f"{name}.txt"), "w") as fh:
            fh.write(text)


if __name__ == "__main__":
    main()
