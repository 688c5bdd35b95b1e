"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. Demo inputs are derived and staged first and not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curbwise.session import local_session  # noqa: E402
from verification import inputs  # noqa: E402
from verification.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "merge_all_days", "merge_months_from_tsv", "spot_stats", "candidate_chains", "recommended_spots",
    "cluster_labels", "named_recommendations", "persisted_details", "published_documents", "batch_lookup",
    "heat_query", "heat_query_clustered", "road_snapping", "ellipsoid_distance", "geohash_encode",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("order", "order_ext", "poi", "road", "address", "request"):
        inputs.demo(spark, sf_dir, name)
    inputs.detail(spark, sf_dir)
    seconds = {}
    for name in HEADLINE:
        started = time.time()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
