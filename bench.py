"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_REPEAT (default 1,
best of N). Each query is run to completion with the ``noop`` sink (full
execution, nothing collected to the driver). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "clean_table",          # C1-E3-D1-B5: the ETL
    "label_totals",         # F4 dashboard (flagship)
    "genre_counts",         # F3 dashboard
    "message_tokens",       # I1-I8 tokenizer over whole texts
    "tfidf_weights",        # J1-J4 relational TF-IDF
    "spell_suggestions",    # I15 deletion-key join
    "sentence_vectors",     # J9
    "similar_words",        # G3
    "upsampled_train",      # H0-H4
    "label_metrics",        # F9-F11
    "stream_event_windows", # S2 event-time stream
    "stream_scores",        # S1 scoring stream (fit in batch, score as a stream)
    "multilabel_predictions",  # K1-K2 fit + A8 save/load + predict
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from msgtriage.plans.catalog import REGISTRY
    from msgtriage.session import get_session

    spark = get_session(
        f"local[{cpus}]",
        "msgtriage-bench",
        shuffle_partitions=max(8, 2 * cpus),
        conf={"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": "32m"},
    )
    # warm the JVM, codegen and the parquet reader once on the smallest data (not timed)
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        REGISTRY["clean_table"].fn(spark, small).write.format("noop").mode("overwrite").save()
    else:
        spark.read.parquet(os.path.join(sf_dir, "region.parquet")).count()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            try:
                REGISTRY[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as ex:  # report, keep going
                errors[name] = repr(ex)[:300]
                break
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        if best is not None:
            times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
