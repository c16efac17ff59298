"""Wall-clock time of the headline queries; prints one JSON line.

Every query starts from the raw tables and its whole result is computed (written to the no-op sink). The best of
``BENCH_RUNS`` runs counts, after one unmeasured run over all queries to warm up the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from tillwright.plans import registry
from tillwright.session import local_session, release

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "dq_summary_snapshot",
    "dq_duplicate_keys",
    "dq_id_gaps",
    "dq_quantity_profile",
    "stg_customers",
    "stg_orders",
    "master_sales",
    "master_sales_ext",
    "fact_sales",
    "v_base_sales",
    "v_sales_daily",
    "v_sales_monthly",
    "v_kpi_overview_monthly",
    "v_category_performance",
    "v_city_performance",
    "v_top_products",
    "v_mix_share_monthly",
    "v_city_category_monthly",
    "v_aov_category_monthly",
    "v_customer_activity",
    "v_sales_monthly_yoy",
    "view_rfm",
    "view_monthly_cohort",
    "view_pareto_products",
    "view_clv_simple",
    "guard_global_parity",
    "guard_month_coverage",
    "guard_rfm_coverage",
    "guard_problem_samples",
    "city_tiers_all",
    "sl_repeat_rate",
    "sl_dashboard_slice_aov_by_month",
)


def timed(spark, name: str) -> float:
    start = time.perf_counter()
    registry.run(name, spark, FOLDER).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    release(spark)
    return seconds


def main() -> None:
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8, app="tillwright-bench")
    for name in chosen:
        timed(spark, name)
    seconds = {name: round(min(timed(spark, name) for _ in range(RUNS)), 3) for name in chosen}
    sf = Path(FOLDER).name.removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf)}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
