"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line with per-query wall-clock seconds.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans.all_queries import QUERIES  # noqa: E402
from quire.session import build_session  # noqa: E402

HEADLINE = [
    "term_frequency", "ocr_quality_filter", "ocr_quality_summary", "drop_first_lines",
    "marker_trim", "drop_matching_lines", "metadata_stopwords", "collection_blocklist",
    "harvest_stats", "collection_stats", "key_parsing", "keyword_scores", "knn_topk",
    "neighbor_histogram", "nonword_corrections", "replace_nonwords", "labelled_table",
    "layout_projection",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = build_session(f"local[{cpus}]", app="quire-bench",
                          shuffle_partitions=int(cpus))
    # warm-up (not timed): JVM start-up and JIT of the tokenize / explode /
    # aggregate path that most queries share
    from pyspark.sql import functions as F

    from quire.functions.text import tokenize
    from quire.sources.tables import table
    warm = (table(spark, sf_dir, "documents").select(F.explode(tokenize("text")).alias("w"))
            .groupBy("w").count())
    warm.write.format("noop").mode("overwrite").save()
    # start the Python workers once (Arrow-batched stages reuse them)
    spark.range(0, 64, 1, int(cpus)).mapInPandas(lambda it: it, "id long") \
        .write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 -- report and keep timing the others
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"# {name}: FAILED {failed[name]}", file=sys.stderr, flush=True)
            continue
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
