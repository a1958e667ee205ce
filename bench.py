"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each time is the median of $BENCH_RUNS runs (3).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from dqspark.session import Scratch, get_spark  # noqa: E402

HEADLINE = (
    "clean_text", "strip_accents", "parse_money", "std_state", "clean_email", "parse_dates",
    "drop_full_duplicates", "full_duplicates", "key_duplicates", "dedup_by_key", "duplicate_counts",
    "impute_income_by_group", "handle_missing", "dq_report", "dq_before_after", "missing_summary",
    "cardinality", "describe_text", "describe_numeric", "quantiles", "outliers_iqr", "customer_segments",
    "segment_summary", "avg_rank", "corr_pearson", "corr_spearman", "test_pearson", "test_welch_t",
    "test_mann_whitney", "test_anova", "test_battery", "histogram", "kde_grid", "boxplot_stats",
    "scatter_bins", "fuzzy_duplicates", "fuzzy_part_names",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        with Scratch(spark):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("std_state", "quantiles", "test_welch_t"):  # warm the JVM and the Python workers
        timed(name)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {name: round(median(timed(name) for _ in range(runs)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
