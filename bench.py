"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sessionloom.config import get_session  # noqa: E402
from sessionloom.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "multi_search",
    "multi_search_euclidean",
    "indexed_search",
    "history_search",
    "signal_item_join",
    "user_embeddings",
    "session_state_trace",
    "maximal_marginal_relevance",
    "train_scalar_quantizer",
    "quantize_scalar",
    "sketch_collection",
    "random_batch",
    "personalized_batch",
    "sampled_batch",
    "next_batch",
    "signal_stream",
]


def _warm(batches):
    import numpy as np

    np.ones((64, 64)) @ np.ones((64, 64))
    yield from batches


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Python workers and table reading are warm before the first timing.
    spark.range(0, 1000, 1, int(cpus)).mapInArrow(_warm, "id long").count()
    spark.read.parquet(f"{sf_dir}/embeddings.parquet").groupBy("label").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]} s", file=sys.stderr)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n_sessions = events.select("user_id").distinct().count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "next_batch_sessions_per_sec": round(n_sessions / times["next_batch"], 1),
                "trace_events_per_sec": round(events.count() / times["session_state_trace"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
