"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adjudica.plans.registry import load_all  # noqa: E402
from adjudica.session import local_session  # noqa: E402

HEADLINE = [
    "normalize_ticket", "resolve_entities", "field_conflicts", "dedupe_first", "insert_ignore", "mask_text",
    "asof_latest", "vehicle_days", "evaluate_rules", "classify", "select_top1", "search_documents",
    "tokenize", "check_unique", "content_fingerprint", "scan_queue_records", "answer_questions", "run_files",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench", memory="12g")
    queries = load_all()
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    times = {}
    for name in names:
        # Each query runs once on the smallest tables first, so that loading classes is not charged to it.
        if os.path.isdir(small):
            queries[name].run(spark, small).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
