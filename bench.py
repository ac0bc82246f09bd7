"""Wall time of the headline queries. Prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaugeflow.queries import REGISTRY  # noqa: E402
from gaugeflow.session import get_session  # noqa: E402

HEADLINE = [
    "s2_decimal_comma_scan", "s10_fixed_width_scan", "k1_parquet_sink",
    "m3_missing_counts", "m4_null_fraction_drop", "m5_mean_imputation", "m9_rush_hour_flag", "m11_median_binarisation",
    "x1_find_emails", "x14_round_half_even", "a7_correlation_matrix", "a8_histogram", "a8_density", "a11_class_report",
    "a13_regression_metrics", "a16_token_frequency", "a17_token_association", "a18_mean_by_hour",
    "w6_latest_per_location", "u4_update_first", "u7_apply_changes",
    "l2_standardise_sample", "l3_hash_split", "l4_least_squares", "l5_elastic_net_search", "l7_forest_classification",
    "l9_kmeans", "l10_elbow", "l11_pca", "l21_nearest_centre",
    "h1_health_score", "h16_scored_record", "t1_stream_scoring", "t2_malformed_routing", "t3_latest_per_location",
    "j1_clean", "j2_clean_for_exploration", "j3_train_and_compare", "j4_train_service_models", "j5_batch_score",
    "j8_cluster_study", "j9_compare_classifiers",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = get_session(
        "gaugeflow-bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["a4_value_counts"].run(spark, sf).collect()  # start-up cost is not a query's

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
