"""Times the headline queries and prints one JSON line.

Every query runs over whole tables and is written to Spark's no-op sink, so that
all rows and columns are computed and none is sent to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tessera import plans
from tessera.session import get_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = [
    "group_min_max_avg",
    "group_mean",
    "sql_stack_count",
    "group_first_last",
    "group_collect",
    "filter_date_range",
    "top_n",
    "describe_long",
    "class_counts",
    "word_count",
    "word_count_norm",
    "word_count_by_doc",
    "na_fill_mean",
    "na_fill_median",
    "na_fill_mode",
    "na_fill_knn",
    "sample_plan",
    "sample_few_classes",
    "sample_equal",
    "sample_materialize",
    "csv_declared_schema",
    "vector_features",
    "feature_roundtrip",
    "image_features",
    "image_bytes_features",
    "na_fill_knn_euclidean",
    "na_fill_knn_hamming",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = get_session(
        "tessera-bench",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.path.abspath("spark-warehouse/_bench"),
        },
        master=f"local[{CPUS}]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.queries()

    def run(name: str) -> None:
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in HEADLINES:
        run(name)
        timings[name] = round(min(seconds(lambda: run(name)) for _ in range(2)), 3)
        print(name, timings[name], file=sys.stderr)

    images = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "vectors_as_images_per_sec": round(images / timings["image_features"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
