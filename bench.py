"""Time the headline queries; prints one JSON line.

Every query is executed in full into the no-op sink. The shared stage tables
are timed on their own, so that no query hides or carries their cost.
"""

from __future__ import annotations

import json
import os
import sys
import time


def main() -> None:
    from aislecast.plans.queries import QUERIES
    from aislecast.plans.tables import Tables
    from aislecast.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables.of(spark, sf_dir)
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    def execute(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # Start the executors and the parquet reader outside the timings.
    tables.table("lineitem").write.format("noop").mode("overwrite").save()
    for stage in ("curated", "features", "anomalies", "products", "neighbours", "forecasts"):
        timed(f"stage_{stage}", lambda stage=stage: getattr(tables, stage))
    for name in (
        "e1_daily_rollup",
        "f1_fill_prices",
        "e2_daily_shelf",
        "j3_dense_curated",
        "k12_review_scores",
        "e11_sentiment_by_sku",
        "k1_features",
        "f7_z_score",
        "k10_anomalies",
        "j8_category_peers",
        "j9_substitute_available",
        "l9_point_in_time",
        "j6_part_substitutes",
        "k6_feature_drift",
        "k8_seasonal_baseline",
        "m1_quality_gate",
        "e13_sku_scoreboard",
        "e18_bi_measures",
        "o3_co_stocked_pairs",
        "h1_union_distinct",
        "p10_normalize_export",
        "s1_stream_landing",
        "k2_model_predictions",
        "k4_recursive_forecast",
    ):
        timed(name, execute(name))
    scale = os.path.basename(sf_dir.rstrip("/"))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": scale.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
