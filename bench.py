"""Headline queries on the bench tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from snapflow.queries import QUERIES
from snapflow.session import build_session, drop_work

HEADLINE = [
    "latest_price_per_pair",
    "upsert_state",
    "upsert_changes",
    "page_price_batch",
    "price_series_rows",
    "snapshot_upsert",
    "range_search",
    "card_records",
    "card_content_hash",
    "card_actions",
    "card_state",
    "card_run_log",
    "catalogue_upsert",
    "dimension_get_or_create",
    "resolve_link_ids",
    "line_positions",
    "run_totals_all",
    "changed_cards_per_run",
    "run_messages",
    "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        drop_work(spark)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
