"""Wall time per registered query; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name or prefix ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.queries import load_all  # noqa: E402
from tallyloom.session import build_session  # noqa: E402

# One or two queries per group of operators, and the whole chain up to the dashboard.
HEADLINE = (
    "supplier_market", "supplier_market_by_month", "locale_decimal", "strip_markup_pages",
    "name_keys", "fold_keys", "method_classes", "measures_and_flags", "unpivot_by_suffix",
    "latest_order_per_customer", "last_event_flags", "numbered_orders", "canonical_spellings",
    "member_set_keys", "unlisted_priorities", "without_mirrored_orders", "record_linkage",
    "leader_and_runner_up", "rescaled_polls", "largest_remainders", "orders_fingerprint",
    "customer_history", "table_checks", "delimited_text", "zipped_csv", "html_tables",
    "devices_counted_batch", "devices_counted_stream", "visits_per_day_stream", "staged_polls",
    "polls_fact", "institute_dimension", "intention_fact", "registry_links", "panel_row",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    known = load_all()
    wanted = sys.argv[1:]
    names = [n for n in known if any(n.startswith(w) for w in wanted)] if wanted else HEADLINE
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
