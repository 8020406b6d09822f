"""Times headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON."""

from __future__ import annotations

import json
import os
import sys
import time

QUERIES = ("panel_build", "lag_features", "rolling_mean", "rolling_std", "price_momentum", "promotion_flags", "hierarchy_share", "price_percentile_zscore", "baseline_seasonal_naive", "row_weights", "hierarchical_wrmsse", "metrics_pooled", "validate_duplicates")


def smoke(spark) -> float:
    """Seconds of the training run over the small synthetic panel (76,650 rows), from panel to scores and files."""
    import tempfile

    from tidewright.plans.config import load_config
    from tidewright.plans.train import run
    from tidewright.sources.synthetic import Synthetic

    config = load_config(env={})
    with tempfile.TemporaryDirectory() as config.train.out:
        began = time.time()
        run(spark, config, Synthetic().panel(spark))
        return time.time() - began


def main() -> None:
    root = os.path.dirname(os.path.abspath(__file__))
    sys.path.insert(0, root)
    os.environ["PYTHONPATH"] = root + os.pathsep + os.environ.get("PYTHONPATH", "")
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession

    from tidewright.queries import QUERIES as known

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known[QUERIES[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # the JVM warms up
    took = {}
    for name in QUERIES:
        best = float("inf")
        for _ in range(2):
            began = time.time()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - began)
        took[name] = round(best, 3)
    took["training_smoke"] = round(smoke(spark), 3)
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
