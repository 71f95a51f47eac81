"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query is planned and run to the
end twice; the better time counts, so JVM warm-up does not.
"""

from __future__ import annotations

import json
import os
import time

from tickloom import plans
from tickloom.session import clear_staged, local_session

HEADLINE = [
    "bars",
    "describe_bars",
    "count_by_date",
    "group_mean",
    "keyed_state_join",
    "minmax_scale",
    "row_number_display",
    "lag_window_features",
    "ols_fit",
    "ols_summary",
    "ols_fit_lineitem",
    "studentized_outliers_lineitem",
    "lowess_smooth",
    "lowess_lineitem",
    "pca_features",
    "elastic_net_close",
    "l1_path_cv",
    "knn_errors",
    "sequence_forecast",
    "boosted_trees_l1",
    "scan_bars_csv",
    "stream_count_by_date",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    run = plans.queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(2):
            start = time.perf_counter()
            run[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            clear_staged(spark)
        seconds[name] = round(min(times), 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
