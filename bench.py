"""Time the headline queries; prints one JSON line.

Every query writes its full result to the no-op sink. Stored inputs (silver, models) are written
before the clock starts, as a job that scores finds them; flows that build them are timed as such.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from catalog import tables
from catalog.queries import QUERIES

HEADLINE = [
    "bronze_import", "bronze_update", "dense_sno", "chunk_assign", "fetch_outcome", "page_extract",
    "remove_urls", "silver_insert", "silver_build", "token_windows", "window_scores", "sentiment",
    "emotion", "labels_head", "labels_salted", "labels_arrow", "keyed_predictions", "gold_all_batches",
    "gold_latest", "gold_arrow", "stream_gold",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables.silver_path(spark, sf_dir)
    tables.model_root(spark, sf_dir)
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median_low(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
