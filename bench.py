"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.session import build_session  # noqa: E402

HEADLINE = [
    "ohlcv_bars", "tick_bars", "dedup_first", "validate_rules", "quality_report", "latest_per_ticker", "sma_set", "bollinger", "rsi_b", "ema_macd",
    "lag_roll_features", "processed_dataset", "gap_fill", "rolling_corr", "cv_fold_stats", "month_blocks", "leak_summary", "trades",
    "backtest_metrics", "monte_carlo", "asof_features", "training_set", "latest_features", "vector_report", "score_batch", "sequences",
    "event_counters", "bucket_quantile", "latency_index_stats", "counter_rate", "windowed_quantiles", "sustained_alerts", "stream_bars", "stream_rate",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = build_session("tickloom-bench", f"local[{cpus}]", int(cpus), spark__ui__enabled="false", spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    from tickloom.plans import catalog

    queries = catalog.queries()
    for warm in ("ohlcv_bars", "returns"):  # class loading and the first code generation are not a query's cost
        queries[warm](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    from tickloom.operators.validate import validate_bars
    from tickloom.plans.datasets import table
    from pyspark.sql import functions as F

    lines = table(spark, folder, "lineitem")
    price = F.col("l_extendedprice")
    bars = lines.select(F.col("l_suppkey").cast("string").alias("ticker"), F.col("l_shipdate").cast("date").alias("date"), price.alias("open"),
                        price.alias("high"), price.alias("low"), price.alias("close"), (F.col("l_quantity") * 10000).cast("bigint").alias("volume"))
    rows = validate_bars(bars).agg(F.count("*"), F.count("validation_error")).first()[0]
    rate = rows / (time.perf_counter() - start)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "validation_rows_per_sec": round(rate),
    }))


if __name__ == "__main__":
    main()
