"""Seconds per headline query; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 16g pyspark-shell")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wicketflow.plans import catalogue  # noqa: E402
from wicketflow.session import local_session  # noqa: E402

HEADLINE = (
    "f_scorecard", "f03_cumulative_runs", "f09_powerplay_runs", "f16_over_cumulatives",
    "l_player_features", "l20_hat_tricks", "m01_player_match_stats", "m20_batting_position",
    "q07_null_profile", "q12_match_overs_stats", "q21_over_length_factors",
    "p07_match_metadata", "p15_similar_names", "u06_overs", "u09_deliveries", "u13_players",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries = catalogue.queries()
    spent = {}
    spark.range(1000).selectExpr("sum(id)").collect()
    start = time.perf_counter()
    catalogue.flat_tables(spark, sf_dir)
    catalogue.match_documents(spark, sf_dir)
    preparation = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(spent.values()), 3), "unit": "sec",
                "queries": spent, "preparation": preparation, "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
