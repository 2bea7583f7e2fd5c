"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from touchline.plans.registry import QUERIES  # noqa: E402
from touchline.session import clear_scratch, local_session  # noqa: E402

HEADLINE = [
    "doodle_valid_count",
    "doodle_country_distance",
    "stroke_country_counts",
    "adjacency",
    "pagerank_step",
    "pagerank_3",
    "pass_accuracy",
    "shot_effectiveness",
    "minutes_played",
    "contribution",
    "incidents",
    "player_rating",
    "chemistry",
    "profile",
    "rating_regression",
    "match_info",
    "win_chance_plain",
    "event_framing",
    "match_info_by_pair",
    "clusters",
    "win_chance",
    "stream_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), folder=tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # One small run first, so that the figures are not the start-up of the session.
    QUERIES["pass_accuracy"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds, build = {}, {}
    for name in names:
        start = time.perf_counter()
        result = QUERIES[name](spark, sf_dir)
        build[name] = round(time.perf_counter() - start, 3)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        clear_scratch(spark)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "before_result": build,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
