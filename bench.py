"""Times loading and the headline queries and prints one JSON line.

Loading is timed once, cold. Each query runs twice and the second run counts, so compiling its plan
is not part of it. ``python bench.py all`` takes every registered query, and names pick some.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse.operators.rollups import ROLLUPS
from tallyhouse.plans import queries as q
from tallyhouse.session import local_session

HEADLINE = """
scan_source_1 source_insert_if_absent landing_parse landing_inventory normalize_defaults
union_sources required_fields_gate dim_date dim_product_scd1 fact_sales fact_dedupe
fact_idempotent_reload load_counters sales_enriched
daily_sales_summary monthly_sales_by_category top_products_by_revenue weekly_sales_trends
quarterly_sales_summary daily_sales_by_product view_info
sales_summary top_products sales_trends_daily sales_trends_weekly sales_trends_monthly
sales_trends_quarterly sales_by_category retailer_performance recent_sales database_statistics
dq_run_all dq_report dq_summary
rpt_daily_dashboard rpt_top_products rpt_top_product_trends rpt_retailer_comparison
rpt_category_growth chart_daily_pivot chart_category_pivot panel_top_quantity
panel_category_monthly doc_top_by_name doc_retailers_last_quarter newest_rows
""".split()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run(frame) -> None:
    """Compute every row and column without keeping them."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(q.QUERIES)
    spark = local_session("bench", cores, shuffle_partitions=int(cores))

    # What the queries read is built first and timed on its own, so no query pays for it.
    loads = {
        "load_star": lambda: q.warehouse(spark, folder),
        "load_rollups": lambda: [q.warehouse(spark, folder).views[name] for name in ROLLUPS],
        "load_landing": lambda: q._landing_root(spark, folder),
        "load_raw_feeds": lambda: q._normalized_maps(spark, folder),
        "load_records": lambda: q._loaded(spark, folder),
    }
    seconds = {name: timed(load) for name, load in loads.items()}
    for name in names:
        run(q.QUERIES[name](spark, folder))
        seconds[name] = timed(lambda name=name: run(q.QUERIES[name](spark, folder)))
    print(json.dumps({
        "metric": "total seconds of loading and headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cores),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
