"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``; every column of the result is materialised through
the ``noop`` sink (``count()`` would let Catalyst prune the work away).
One warm-up run, then the median of ``$BENCH_RUNS`` (default 3) runs.
``$BENCH_REPLICATE=k`` repeats every input row k times (ids offset per copy)
to compare plans on more rows.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scanpress.plans.queries import QUERIES  # noqa: E402
from scanpress.session import cleanup_scratch, get_spark  # noqa: E402

# parser paths, the named article documents, HTML to text, slugs, missing
# scans, cost by model, and the corpus build.
HEADLINE = [
    "extract_articles",
    "extract_articles_irregular",
    "article_html",
    "html_to_text",
    "slugify",
    "unique_names",
    "missing_scans",
    "cost_by_model",
    "first_success",
    "html_meta",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    replicate = int(os.environ.get("BENCH_REPLICATE", "1"))
    spark = get_spark(
        app="scanpress-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        extra={"spark.driver.memory": "16g"},
    )
    if replicate > 1:
        spark.conf.set("scanpress.bench.replicate", str(replicate))
    timings: dict[str, float] = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
        cleanup_scratch(spark)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_query_seconds_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
        "replicate": replicate,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
