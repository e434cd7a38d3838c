"""Times the headline queries once each, after one warm-up, and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from monthwise.session import local_session  # noqa: E402
from registered.queries import REGISTRY  # noqa: E402

HEADLINES = (
    "stg_trade", "fct_trade", "product_metrics", "flow_balance", "partner_shares", "top_partner",
    "partner_concentration", "price_changes", "price_index", "origin_features", "forecast_targets",
    "ar1_fits", "forecast_predictions", "forecast_metrics", "wide_ingest", "cube_decode",
    "series_coverage", "freshness_trade", "scope_replace", "dq_preservation",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(
        os.environ.get("BENCH_CPUS", "8"), "16g", **{"spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["price_changes"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
