"""Headline queries at one scale; prints one JSON line with seconds per query.

BENCH_SF_DIR chooses the tables, BENCH_CPUS the cores. Every query runs once at the smallest scale to
warm up, then once on the tables into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINES = (
    "batch_rows", "column_profile", "dq_metrics", "dq_before_after", "clean_impute", "duplicates", "items", "itemsets", "rules_top",
    "rules_recheck", "drift_quartile", "drift_chisq", "drift_target", "drift_verdict", "label_encode", "standardize", "strat_split",
    "roc_auc", "batch_performance", "perturb_spike", "champion", "stream_profile", "train_models",
)


def main() -> None:
    from tidewatch.queries import all_queries
    from tidewatch.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session("bench", cores, partitions=8)
    queries, _ = all_queries()
    warm = str(Path(folder).parent / "sf0.001")
    seconds = {}
    for name in names:
        if os.path.isdir(warm):
            queries[name](spark, warm).write.format("noop").mode("overwrite").save()
        started = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
