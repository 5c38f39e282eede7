"""Benchmark: headline queries and a written two-run sync.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3). Each query is executed to completion with the
``noop`` sink (no collect); the reported figure per query is the median of
the repeats after one JVM warm-up query. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.timex import ts_literal  # noqa: E402
from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.plans.sync import run_sync  # noqa: E402
from tidemark.session import build_session, scratch_dir  # noqa: E402
from tidemark.sources.fixtures import FIXTURE_EXTRACTED_COL, fixture_inputs  # noqa: E402

HEADLINE = ["orders_latest", "identity_map_full", "shop_links", "shop_map", "customer_profile",
            "orders_mart", "journey_mart", "upsert_orders"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="tidemark-bench",
                          extra={"spark.driver.memory": "16g"})
    _run(QUERIES["contact_pairs"](spark, sf_dir))  # warm-up
    results: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(repeats):
            t = time.perf_counter()
            _run(QUERIES[name](spark, sf_dir))
            times.append(time.perf_counter() - t)
        results[name] = round(statistics.median(times), 3)

    # The written pipeline: run 1 then run 2 into a fresh warehouse folder.
    base = fixture_inputs(spark, sf_dir)
    run1 = fixture_inputs(spark, sf_dir, F.col("updated_at") < ts_literal("2001-01-01 00:00:00"))
    kw = dict(extracted_col=FIXTURE_EXTRACTED_COL, customer_tiebreak=FIXTURE_EXTRACTED_COL)
    warehouse = f"{scratch_dir(spark)}/bench-{int(time.time() * 1000)}"
    t = time.perf_counter()
    run_sync(spark, run1, warehouse, "2001-01-01 00:00:00", **kw)
    results["sync_run1_written"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    run_sync(spark, base, warehouse, "2002-01-01 00:00:00", **kw)
    results["sync_run2_written"] = round(time.perf_counter() - t, 3)

    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_sec", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
