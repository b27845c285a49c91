"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quayside.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "conversion_by_price", "chi_square_2x2", "conversion_by_segment", "cumulative_sum_by_group",
    "weekly_active", "weekly_messages", "rolling_count", "interval_join",
    "inspection_rollup", "multi_hot", "visit_frequency", "describe_numeric", "summary_by_segment", "column_profile",
    "correlation_matrix", "min_max_scale", "box_stats", "histogram", "kmeans_assign", "fit_kmeans",
    "fill_series", "seasonal_decompose", "autocorrelation", "adf_stationarity", "forecast_arima",
    "tokenize", "find_phrases", "apply_phrases", "bag_of_words", "tfidf", "topic_coherence", "classification_metrics",
    "fit_logistic",
]

#: Searches over many fits: timed too, but not part of the total, which stays comparable from round to round.
SEARCHES = ["grid_search", "recursive_elimination", "single_feature_scores", "kmeans_sweep"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["value_counts"](spark, folder).write.format("noop").mode("overwrite").save()  # start the workers

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    times = {name: timed(name) for name in HEADLINE}
    searches = {name: timed(name) for name in SEARCHES}
    print(json.dumps({"metric": "total time of the headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "searches": searches,
                      "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
