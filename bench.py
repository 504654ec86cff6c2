"""Time the headline queries on one machine and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from workload.queries import all_queries

HEADLINE = (
    "quality_score", "impute_global", "panel_features", "match_exact", "match_stratified",
    "propensity", "match_knn", "match_ipw", "effect_gee", "naive_effect", "wilcoxon",
    "rank_or_sign", "bootstrap_by_arm", "bootstrap_poisson", "evaluate_all", "evaluate_phases",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = all_queries()
    catalog["study_count"](spark, sf_dir).collect()  # start-up is not part of any query
    seconds = {}
    for name in HEADLINE:
        started = time.time()
        catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 2)
    print(
        json.dumps({
            "metric": "headline_total", "value": round(sum(seconds.values()), 2), "unit": "sec",
            "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()
