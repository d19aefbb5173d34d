"""Headline queries on one machine. Prints one JSON line.

Every query starts from the given tables: what it derives (threads, index, models) is built anew
and counted in its time, except for the names ending in _warm, which find the index already stored.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caseweave.plans import bindings, registry  # noqa: E402
from caseweave.session import local_session  # noqa: E402

COLD = ["extract_brand", "dedup_tweets", "conversation_threads", "intent_frequency", "label_documents",
        "text_statistics_documents", "vocabulary_diversity", "brand_ranking", "tfidf_weights", "golden_set",
        "search_topk", "triage_rules", "triage_model", "evaluation_record"]
PROFILE = ["null_counts", "direction_counts", "text_statistics", "date_range", "brand_ranking"]  # timed as one job
WARM = ["search_topk", "triage_rules", "triage_model", "judge_summary"]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.time()
    registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.time() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or COLD
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, sf_dir, "assign_role")  # starts the JVM's code paths; not counted
    times = {}
    for name in names:
        bindings.forget()
        times[name] = run(spark, sf_dir, name)
        print(name, times[name], file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        times["profile"] = round(sum(run(spark, sf_dir, name) for name in PROFILE), 3)
        for name in WARM:
            times[name + "_warm"] = run(spark, sf_dir, name)
            print(name + "_warm", times[name + "_warm"], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
