"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default HEADLINE).
Each query is executed in full through Spark's ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sales_fact",
    "enriched_sales",
    "customer_month_mart",
    "customer_day_mart",
    "sales_team_month_mart",
    "sales_team_month_mart_by_month",
    "product_enriched_sales",
    "ingested_sales",
    "quarantined_lines",
    "monthly_billing_report",
    "partitioned_mart_pruned",
    "ledger_current",
    "pipeline_sales_team_mart",
]


def reference_day(spark, rows: int = 400_000) -> dict[str, float]:
    """The modelled system's largest stated input: one 400,000-row sales day, run through the whole job.

    The landed CSV comes from the synthetic generator (G2); dimensions are the seed rows.
    """
    from salesmart.operators.synth import synth_sales
    from salesmart.plans.pipeline import run_pipeline
    from salesmart.session import work_dir
    from tests.seed import dimensions

    wd = work_dir(spark, "reference-day")
    t0 = time.perf_counter()
    synth_sales(spark.range(rows), start="2023-08-20", end="2023-08-20").write.option("header", True).csv(
        f"{wd}/landing/day"
    )
    t1 = time.perf_counter()
    customer, store, product, team = dimensions(spark)
    run_pipeline(spark, f"{wd}/landing", f"{wd}/out", customer, store, team, product=product)
    t2 = time.perf_counter()
    return {"reference_day_400k_generate": round(t1 - t0, 3), "reference_day_400k_pipeline": round(t2 - t1, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from salesmart.plans.queries import QUERIES
    from salesmart.session import build_session

    spark = build_session(
        master=f"local[{cpus}]",
        app_name="salesmart-bench",
        shuffle_partitions=max(cpus, 8),
        extra_conf={"spark.driver.memory": "16g"},
    )
    # Warm-up (JVM, codegen caches) on the smallest scale; not timed.
    QUERIES["sales_team_month_mart"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    if os.environ.get("BENCH_REFERENCE_DAY", "1") == "1":
        times.update(reference_day(spark))
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
