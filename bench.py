"""Seconds per headline query: median of several runs after a warm-up pass over all; one JSON line.

Next to the seconds, for the series with many products: rows a second and core, and what planning takes of a run.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from navspan.plans.queries import QUERIES
from navspan.session import build_session
from navspan.sources.derived import nav_parts, nav_suppliers

HEADLINE = [
    "returns_windows", "returns_periods", "returns_strict", "valuation_count", "volatility_windows",
    "volatility_periods", "volatility_list", "sharpe", "max_drawdown_windows", "max_drawdown_periods",
    "calmar", "drawdown_windows", "drawdown_periods", "metrics_bundle", "volatility_asof", "metrics_asof", "point_metric",
    "asof_start", "packed_parse", "nav_last_per_day", "supplier_returns", "supplier_volatility",
    "part_max_drawdown", "part_calmar", "part_bundle", "all_indicators",
]
# A run that takes longer than this in the warm-up is measured once.
LONG = 8


def main():
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session({
        "app_name": "bench", "master": f"local[{cpus}]", "shuffle_partitions": cpus,
        "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    plans = {}

    def run(name):
        start = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df._jdf.queryExecution().executedPlan()
        plans[name] = round(time.perf_counter() - start, 3)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    cold = {name: round(run(name), 3) for name in names}
    seconds, rates = {}, {}
    rows = {"supplier": nav_suppliers(spark, sf_dir).count(), "part": nav_parts(spark, sf_dir).count()}
    rows["all"] = rows["part"]
    for name in names:
        seconds[name] = round(statistics.median(run(name) for _ in range(1 if cold[name] > LONG else runs)), 3)
        if name.split("_")[0] in rows:
            rates[name] = round(rows[name.split("_")[0]] / seconds[name] / int(cpus))
        print(f"{name} {seconds[name]} (first {cold[name]}, planning {plans[name]})", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
        "first_run": cold, "planning": plans, "rows_per_second_and_core": rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
