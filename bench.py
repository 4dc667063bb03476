"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 5), BENCH_SETTLE (untimed runs before, default 2). Every query runs once in a warm-up pass, then each
is timed BENCH_REPEAT times back to back; the median is reported. Queries are forced with the ``noop`` sink so
the whole plan runs without pulling rows to the driver.

Besides the registered queries, two stress shapes run on replicated hits
(every event x10 as distinct visitors, and x10 with one visitor holding a
third of all rows) to compare the session form with the join form once the
data is large enough to shuffle.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "5"))
SETTLE = int(os.environ.get("BENCH_SETTLE", "2"))


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("clickcredit-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(CPUS))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def replicated_hits(spark, sf: str, copies: int, hot_share: float = 0.0):
    """Event hits x ``copies``; each copy is a new set of visitors.

    With ``hot_share`` > 0 that share of rows is moved to one visitor (a
    deterministic hash decides which rows), the skew case.
    """
    from clickcredit.sources.hits import load_event_hits
    hits = load_event_hits(spark, sf)
    rep = hits.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    ip = F.concat(F.col("ip"), F.lit("-"), F.col("_copy").cast("string"))
    if hot_share > 0:
        bucket = F.pmod(F.xxhash64("hit_id", "_copy"), F.lit(1000))
        ip = F.when(bucket < int(hot_share * 1000), F.lit("10.9.9.9")).otherwise(ip)
    return rep.withColumn("ip", ip).withColumn(
        "hit_id", F.col("hit_id") * copies + F.col("_copy")).drop("_copy")


def main() -> None:
    from clickcredit.operators.attribution import keyword_revenue, keyword_revenue_join
    from clickcredit.operators.enrich import enrich_hits
    from clickcredit.plans.catalog import ORDER, QUERIES

    spark = session()
    headline = ["keyword_revenue", "keyword_revenue_join", "keyword_revenue_first",
                "keyword_revenue_lax", "visitor_sessions", "attributed_purchases", "report_summary",
                "top_keywords", "enriched_hits", "referrer_keyword", "file_manifest",
                "status_events", "latest_file_status"]
    jobs = {name: (lambda n=name: QUERIES[n](spark, SF_DIR)) for name in headline}
    jobs["keyword_revenue_x10"] = lambda: keyword_revenue(
        enrich_hits(replicated_hits(spark, SF_DIR, 10)), order_by=ORDER)
    jobs["keyword_revenue_join_x10"] = lambda: keyword_revenue_join(
        enrich_hits(replicated_hits(spark, SF_DIR, 10)), order_by=ORDER)
    jobs["keyword_revenue_hot_x10"] = lambda: keyword_revenue(
        enrich_hits(replicated_hits(spark, SF_DIR, 10, hot_share=1 / 3)), order_by=ORDER)
    jobs["keyword_revenue_join_hot_x10"] = lambda: keyword_revenue_join(
        enrich_hits(replicated_hits(spark, SF_DIR, 10, hot_share=1 / 3)), order_by=ORDER)

    # One warm-up pass over every job first, so no query pays the JVM's
    # warm-up for the others; then each query is timed in steady state.
    for build in jobs.values():
        build().write.format("noop").mode("overwrite").save()
    def timed(build) -> float:
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Each query is repeated back to back, like a dedicated job per input file.
    # (Interleaving different queries measured 20-100% slower per query: the
    # JIT sees a rotating mix of generated classes at the same call sites.)
    runs = {}
    for name, build in jobs.items():
        for _ in range(SETTLE if name in headline else 2 * SETTLE):  # settle (JIT at this data size)
            timed(build)
        runs[name] = [timed(build) for _ in range(REPEAT)]
    times = {name: round(statistics.median(r), 4) for name, r in runs.items()}

    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    total = round(sum(times[n] for n in headline), 4)
    print(json.dumps({"metric": "headline_total_median_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": CPUS, "repeat": REPEAT}))
    spark.stop()


if __name__ == "__main__":
    main()
