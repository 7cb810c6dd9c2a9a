"""Times the headline queries and prints one JSON line.

The derived input tables are stored first, so the figures are those of the
operators. Each query runs over whole tables; the figure is the median of warm
runs, with every row computed (and, for the chained run and the stream, every
result table written).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from stayline.plans.queries import QUERIES
from stayline.session import local_session, written
from stayline.sources import testdata

HEADLINE = (
    "user_summary", "churn_scores", "churn_detail", "report_rollup", "report_metrics",
    "recommendations", "feature_gap_ranked", "alerts_table", "user_360", "run_analysis",
    "stream_score_refresh",
)
RUNS = 3


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session("bench", cpus, **{"spark.driver.memory": "12g"})
    names = sys.argv[1:] or HEADLINE
    inputs = testdata.load(spark, sf_dir)
    stored = testdata.Inputs(*(written(df, f"bench-{name}") for name, df in inputs._asdict().items()))
    testdata.load = lambda *_: stored  # the queries take their inputs from here
    seconds = {}
    for name in names:  # warm-up: code generation and compilation
        timed(spark, name, sf_dir)
    for name in names:
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of warm medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
