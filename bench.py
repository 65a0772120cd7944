"""Time the headline queries on one machine and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stayflow.catalog.queries import REGISTRY, model_table  # noqa: E402
from stayflow.operators.split import hash_split  # noqa: E402
from stayflow.plans import training  # noqa: E402
from stayflow.session import session, settle  # noqa: E402

HEADLINE = [
    "churn_feature_table",
    "churn_feature_table_7d",
    "user_features",
    "user_features_7d",
    "past_n_days",
    "user_page_pivot",
    "user_song_metrics",
    "churn_users",
    "churn_rate",
    "page_counts",
    "column_counts",
    "describe_users",
    "describe_diff",
    "feature_correlation",
    "dedup_events",
    "insert_only_upsert",
    "parse_json_events",
    "scan_json_events",
    "sink_partitioned",
    "gold_user_features",
    "stream_page_counts",
    "stream_silver",
    "roc_curve",
    "area_under_roc",
    "gbt_predictions",
    "cv_metrics_gbt",
    "select_best_model",
]
SEARCHES = {
    "gbt_grid_search": training.gbt_family,
    "lr_grid_search": training.lr_family,
    "rf_grid_search": training.rf_family,
}


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    settle(spark)
    consume(REGISTRY["churn_feature_table"](spark, folder))  # start the JVM before anything is timed

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        began = time.perf_counter()
        consume(REGISTRY[name](spark, folder))
        seconds[name] = round(time.perf_counter() - began, 3)
    if not only or set(only) & set(SEARCHES):
        train, _ = hash_split(model_table(spark, folder))
        for name, family in SEARCHES.items():
            began = time.perf_counter()
            training.grid_search(train, family(), folds=3, parallelism=8)
            seconds[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
