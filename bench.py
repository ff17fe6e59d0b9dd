"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores. Every query
is executed in full; its rows go to a sink which discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parley.plans.catalog import catalog  # noqa: E402
from parley.session import local_session  # noqa: E402

HEADLINE = [
    "top_users_per_channel", "count_by_channel_user", "users_per_channel", "count_by_thread_user",
    "conversations", "user_activity", "timediff_conversations", "timediff_threads",
    "timediff_users", "timediff_sliced", "extract_tags", "nodes", "edges_interacts",
    "edges_reacts", "edges_refers", "edges_interacts_b", "upsert_unique", "upsert_group",
    "replay", "messages_from_pages", "threads_from_pages", "reactions_from_messages",
    "polls_from_pages", "row_index", "token_frequency", "word_forms", "thank_you_posts",
]


#: Runs of each query; the median counts.
RUNS = 3


def execute(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app="parley-bench")
    names = sys.argv[1:] or HEADLINE
    queries = catalog()
    # Start the JVM's compilers and the Python workers outside the measured time.
    for name in ("count_by_channel", "decode_literal_pages"):
        execute(queries[name], spark, folder)
    times = {name: round(median(execute(queries[name], spark, folder) for _ in range(RUNS)), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries, median of three runs each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
