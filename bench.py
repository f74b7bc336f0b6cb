"""Wall seconds of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (best of).
Each query is read to the end through the ``noop`` sink in one warm session. The
tables have one row group each, so they are dealt to a partition per core, in the timed query.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from prosestat.plans.queries import QUERIES  # noqa: E402
from prosestat.session import build_session  # noqa: E402

HEADLINE = (
    "wordfreq_corpus", "wordfreq_by_doc", "top20_corpus", "top20_by_doc", "top20_by_source", "body_strict",
    "sentiment_by_doc", "sentiment_by_doc_large_lexicon", "readability", "syntactic_by_source", "unique_words",
    "facts_dedup", "normalized_records", "direct_records", "record_payloads", "cohort_deltas", "cohort_summary",
    "output_validation", "polarity_gap", "written_volumes", "written_volumes_by_line",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = sys.argv[1:] or HEADLINE
    cores = int(cpus) if cpus.isdigit() else 8
    spark = build_session(f"local[{cpus}]", cores, app="bench", input_partitions=cores, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["wordfreq_corpus"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in wanted:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, best of %d, warm session" % runs, "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "input_partitions": cores}))


if __name__ == "__main__":
    main()
