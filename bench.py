"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from profitlens.plans.queries import all_queries  # noqa: E402
from profitlens.session import drop_staged, local_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

HEADLINE = (
    "macro_kpis",
    "monthly_trend",
    "customer_agg",
    "customer_clv",
    "category_agg",
    "category_health",
    "product_agg",
    "market_agg",
    "region_agg",
    "shipping_agg",
    "geo_nodes",
    "segment_elasticity",
    "correlation_matrix",
    "discount_curve",
    "discount_sensitivity",
    "discount_whatif",
    "cap_sensitivity",
    "profit_histogram",
    "filtered_kpis",
    "outliers_zscore",
    "outliers_iqr",
    "cleaning_report",
    "rfm_segments",
    "customer_segmentation",
    "pareto_curve",
    "abc_classification",
    "product_efficiency",
    "product_quadrants",
    "top_customers_profit",
    "cohort_retention",
    "roc_auc",
    "ltv_features",
    "churn_scores",
)


def seconds(spark, build) -> float:
    start = time.perf_counter()
    build(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def scale() -> float | str:
    name = Path(FOLDER).name.removeprefix("sf")
    return float(name) if name.replace(".", "", 1).isdigit() else name


def main() -> None:
    spark = local_session(tempfile.mkdtemp(prefix="bench-"), CPUS, shuffle_partitions=CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    times = {}
    for name in HEADLINE:
        seconds(spark, queries[name])  # compiling is not part of the query
        times[name] = round(seconds(spark, queries[name]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": scale(),
            }
        )
    )
    drop_staged(spark)
    spark.stop()


if __name__ == "__main__":
    main()
