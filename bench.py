"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed to completion through the ``noop`` sink (nothing is
collected to the driver).  Nothing is kept from one query to the next.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.session import local_session  # noqa: E402
from tessera.workloads import load_all  # noqa: E402

# relational / statistics headline queries, then the reference's timed model workloads
HEADLINE = [
    "flagship", "count_by", "n_distinct_by", "median_by", "range_stats", "min_rank", "lag_lead", "cumsum_col",
    "gap_groups", "pivot_wider", "complete_keys", "fill_down", "delay_share", "hour_autocorr", "month_dest_heat",
    "price_cut_paradox", "stat_histogram", "stat_density", "stat_boxplot", "stat_letter_value", "stat_hex", "skim",
    "roc_curve", "roc_auc", "conf_mat_summary",
    # reference baselines: OLS fit, glm workflow fit, lasso tuning, forest tuning, forest last fit, nn tuning / fit
    "lm_price", "late_flights", "tune_grid_list", "tune_grid_auto", "last_fit", "children_mlp", "fit_mlp",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = local_session(cores=cpus)
    reg = load_all()
    # warm-up: JVM start and first file listing are not part of any query
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for key in only or HEADLINE:
        spark.catalog.clearCache()
        t0 = time.time()
        df = reg[key].run(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t0, 3)
        print(f"{key}: {times[key]}s", file=sys.stderr)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_total_wall_clock", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
