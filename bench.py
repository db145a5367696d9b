"""Time the headline queries on one folder and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores. Every query is
run to the end without collecting its rows.
"""

import json
import os
import sys
import time

from galewire.session import local_session
from galewire.workload.queries import QUERIES

HEADLINE = [
    "flatten_post", "parse_post", "topic_filter", "dedup_by_id",
    "dedup_by_text", "dedup_chain", "dedup_outcomes", "dedup_greedy", "dedup_vs_history",
    "clean_text", "geo_resolve", "nearest_station", "weather_enrich", "lang_profile_score",
    "lang_cascade", "lexicon_sentiment", "sentiment_route", "final_analytics",
    "scan_partitioned_parquet", "q1_sentiment_distribution", "q2_negative_locations",
    "q3_sentiment_by_event", "q4_daily_trend", "q5_language_distribution", "q6_geo_quality",
    "q7_match_quality", "q8_emoji_buckets", "q9_weather_severity", "q10_heatmap_export",
    "stats_top_hashtags", "stream_daily_trend", "enriched_posts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cores, shuffle_partitions=int(cores))
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    posts = spark.read.parquet(f"{folder}/documents.parquet").count()
    line = {
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cores),
        "posts": posts,
    }
    if "enriched_posts" in seconds:
        line["whole_chain_posts_per_sec"] = round(posts / seconds["enriched_posts"], 1)
    print(json.dumps(line))


if __name__ == "__main__":
    main()
