"""Run the headline queries and print one JSON line with their seconds.

$BENCH_SF_DIR names the input folder, $BENCH_CPUS the number of local cores and
$BENCH_REPEATS how often each query runs; the best time counts.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from namelink.catalog import QUERIES  # noqa: E402
from namelink.session import local_session  # noqa: E402

HEADLINE = [
    "nysiis",
    "build_entity_index",
    "refresh_party_index",
    "find_entity_matches",
    "find_party_matches",
    "duplicate_pairs",
    "duplicate_clusters",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session(cpus)
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
