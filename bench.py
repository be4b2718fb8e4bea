"""Time the queries: one warm-up, then the median of five runs, each over all rows and columns.

The session is warmed up before the first query.

Prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the cores, and BENCH_QUERIES
(comma-separated, or "all") the queries; by default the headline set runs.
"""

import json
import os
import statistics
import sys
import time

from wiremere import session
from wiremere.plans.queries import QUERIES

HEADLINE = [
    "gold_signal_summary",
    "gold_report",
    "gold_grand_total",
    "sentiment_share",
    "sentiment_trend",
    "competitor_activity",
    "competitor_activity_star",
    "risk_week",
    "risk_heatmap",
    "broker_matrix",
    "dim_entities",
    "fact_signals",
    "intelligence_feed",
    "news_table",
    "timeline_week",
    "feed_articles",
    "feed_dedup",
    "content_hash_articles",
    "articles_dedup",
    "bronze_insert_ignore",
    "bronze_dedup_report",
    "status_current",
    "work_queue",
    "dead_letter_queue",
    "lineage",
    "lake_stats",
    "lexicon_classify",
    "lexicon_classify_articles",
    "action_rules",
    "route_outcomes",
    "silver_rows",
    "extract_model",
    "signal_to_noise",
    "feed_files",
    "parse_payload",
    "extract_lexicon",
    "whole_run",
    "stream_gold",
    "stream_ingest",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = session.build(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for _ in range(5):
        seconds(lambda: QUERIES[HEADLINE[0]](spark, sf_dir))
    for name in names:
        def run(query=QUERIES[name]):
            return query(spark, sf_dir)

        seconds(run)
        times[name] = round(statistics.median(seconds(run) for _ in range(5)), 4)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": f"total of {len(times)} queries, median of 5 warm runs each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
