"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print ONE JSON line.

Each query is executed completely into Spark's ``noop`` sink (no collect to
the driver) three times, in rounds of a different order each, after a warm-up
on the smallest test tables; its time is the median.
"""

from __future__ import annotations

import json
import os
import random
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skein.plans.catalog import REGISTRY  # noqa: E402
from skein.session import local_session  # noqa: E402

HEADLINE = [
    "flagship", "normalise", "slang_stats", "doc_top_terms", "vocabulary", "tfidf_weights", "cosine_tfidf",
    "pair_metrics", "evaluate_rollup", "sentiment_label", "sentence_scores", "summarise", "hashtags",
    "enrich_with_topics", "histogram", "density", "split_exact", "dedupe", "assemble_threads", "encode_pairs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, partitions=int(cpus) * 2, app="skein-bench", memory="16g")
    # Warm-up on the smallest tables (JIT of the regex / higher-order-function
    # code paths), never on the data being measured.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("flagship", "sentiment_label"):
            REGISTRY[name].run(spark, warm_dir).write.format("noop").mode("overwrite").save()
    runs: dict[str, list[float]] = {name: [] for name in names}
    order = random.Random(42)
    for _ in range(3):
        for name in order.sample(names, len(names)):
            t0 = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - t0)
    times = {name: round(statistics.median(runs[name]), 3) for name in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
