"""Time the headline queries and print one JSON line.

Every query runs in full into the ``noop`` sink, so no column is pruned away by a count.
"""

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from emberwatch.plans.registry import QUERIES  # noqa: E402
from emberwatch.session import build_session  # noqa: E402

HEADLINE = [
    "zone_board",
    "latest_by_max_id",
    "latest_by_max_id_pruned",
    "latest_by_time",
    "latest_abnormal",
    "recent_history",
    "status_kpis",
    "plant_banner",
    "current_board",
    "incident_log",
    "sensor_explorer",
    "metric_trend",
    "trend_reference",
    "web_overview",
    "web_zone_summary",
    "web_filter",
    "numbered_history",
    "online_probability_table",
    "prepare_predictions",
    "parse_json",
    "validate_readings",
    "threshold_classify",
    "load_frame",
    "confusion_matrix",
    "multiclass_metrics",
    "display_measure",
    "alert_index",
    "alert_message",
    "alert_message_parts",
    "score",
    "train_random_forest",
    "train_decision_tree",
    "train_logistic",
]
SLOW = {"train_random_forest", "train_decision_tree", "train_logistic", "score", "alert_message_parts"}


def timed(spark, name, folder):
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "emberwatch-bench",
        master=f"local[{cpus}]",
        settings={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(spark, name, folder)  # first run: code generation and class loading
        runs = 1 if name in SLOW else 3
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 4)
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "rows": rows,
                "rows_per_second": {name: round(rows / value) for name, value in seconds.items()},
            }
        )
    )


if __name__ == "__main__":
    main()
