"""Service metrics over samples (ts, metric, labels, value).

Samples of one metric are unbounded, so nothing here orders a whole metric in one task: counters, gauges and
histograms are plain aggregates; sliding windows are sums of short fixed steps; changes of a counter are taken inside
time slices (:mod:`tickloom.functions.slices`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.slices import newest_rows, order_statistics, with_previous

# Histogram bounds by metric.
BUCKETS: dict[str, tuple[float, ...]] = {
    "http_requests_duration_seconds": (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0),
    "model_inference_duration_seconds": (0.01, 0.025, 0.05, 0.1, 0.25, 0.5),
    "model_prediction_confidence": (0.5, 0.6, 0.7, 0.8, 0.9, 0.95),
    "database_query_duration_seconds": (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0),
}

# Kept requests and the index fractions of the latency summary.
KEPT_REQUESTS = 1000
LATENCY_POINTS = {"median_latency": 0.5, "p95_latency": 0.95, "p99_latency": 0.99}


def label_set(labels: Column) -> Column:
    """A map of labels as a sorted array, which can be grouped and joined."""
    return F.array_sort(F.map_entries(labels))


def label(labels: Column, name: str) -> Column:
    """Value of one label of a ``label_set``."""
    return F.get(F.filter(labels, lambda e: e["key"] == name), F.lit(0))["value"]


def matches(labels: Column, equal: Mapping[str, str] | None = None, regex: Mapping[str, str] | None = None) -> Column:
    """Label conditions on a ``label_set``; a pattern must match the whole value."""
    ok = F.lit(True)
    for k, v in (equal or {}).items():
        ok = ok & F.coalesce(label(labels, k) == v, F.lit(False))
    for k, pattern in (regex or {}).items():
        ok = ok & F.coalesce(label(labels, k).rlike(f"^({pattern})$"), F.lit(False))
    return ok


def counters(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("samples"), F.sum(value).alias("total"))


def gauges(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Last value of each series. Both parts have fixed width, so Spark hashes them and need not sort the samples."""
    return df.groupBy(*keys).agg(F.max(ts).alias("last_seen"), F.max_by(value, ts).alias("value"))


def _bucket_counts(value: str, bounds: Sequence[float]) -> list[Column]:
    return [F.count_if(F.col(value) <= F.lit(float(b))) for b in bounds] + [F.count(value)]


def bucket_array(counts: Sequence[Column], bounds: Sequence[float]) -> Column:
    """Cumulative buckets with the bound and the count below each of them."""
    les = [float(b) for b in bounds] + [float("inf")]
    lows = [min(0.0, les[0])] + les[:-1]
    below = [F.lit(0).cast("bigint"), *counts[:-1]]
    return F.array(*[
        F.struct(F.lit(le).alias("le"), c.cast("bigint").alias("count"), F.lit(lo).alias("lower"), b.cast("bigint").alias("below"))
        for le, lo, c, b in zip(les, lows, counts, below)
    ])


def histogram(df: DataFrame, keys: Sequence[str], bounds: Sequence[float], value: str = "value") -> DataFrame:
    """``buckets`` (cumulative, with +Inf), ``sum`` and ``count`` of each series from one pass."""
    names = [f"__b{i}" for i in range(len(bounds) + 1)]
    counted = df.groupBy(*keys).agg(*[c.alias(n) for n, c in zip(names, _bucket_counts(value, bounds))], F.sum(value).alias("sum"))
    buckets = bucket_array([F.col(n) for n in names], bounds)
    return counted.select(*keys, buckets.alias("buckets"), "sum", F.col(names[-1]).alias("count"))


def bucket_rows(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = hist.select(*keys, F.explode("buckets").alias("b"))
    return rows.select(*keys, F.col("b.le").alias("le"), F.col("b.count").alias("count"))


def bucket_quantile(buckets: Column, q: float) -> Column:
    """Quantile estimated from cumulative buckets: linear inside a bucket; in the top one its lower bound.

    Give the buckets as a column of the frame, since they are read more than once.
    """
    total = F.element_at(buckets, -1)["count"]
    rank = F.lit(float(q)) * total

    def inside(hit: Column) -> Column:
        share = F.try_divide(rank - hit["below"], (hit["count"] - hit["below"]).cast("double"))
        between = hit["lower"] + (hit["le"] - hit["lower"]) * share
        return F.when(hit["le"] == float("inf"), hit["lower"]).when(hit["le"] <= 0, hit["le"]).otherwise(between)

    reached = F.slice(F.filter(buckets, lambda b: b["count"] >= rank), 1, 1)
    return F.when(total > 0, F.get(F.transform(reached, inside), F.lit(0)))


def latency_stats(df: DataFrame, keys: Sequence[str], duration: str, failed: Column, order: Sequence[str],
                  keep: int | None = KEPT_REQUESTS) -> DataFrame:
    """Requests, errors and latency points per key.

    Totals cover all requests. Latencies cover the ``keep`` newest ones (all of them with ``keep=None``); a point is the
    sorted value at index floor(n * q), without interpolation. The kept requests of a key fit one sorted array; without
    that bound the points come from ranks over value slices.
    """
    keys = list(keys)
    totals = df.groupBy(*keys).agg(F.count("*").alias("total_requests"), F.count_if(failed).alias("error_count"))
    totals = totals.withColumn("error_rate", F.try_divide(F.col("error_count").cast("double"), F.col("total_requests").cast("double")))
    spread = [F.min(duration).alias("min_latency"), F.max(duration).alias("max_latency"), F.avg(duration).alias("mean_latency")]
    if keep is None:
        return totals.join(df.groupBy(*keys).agg(*spread), keys).join(order_statistics(df, keys, duration, LATENCY_POINTS), keys)
    kept = newest_rows(df.select(*dict.fromkeys([*keys, duration, *order])), keys, order, keep)
    points = kept.groupBy(*keys).agg(*spread, F.array_sort(F.collect_list(duration)).alias("__sorted"))
    index = {n: F.floor(F.size("__sorted") * F.lit(q)).cast("int") for n, q in LATENCY_POINTS.items()}
    points = points.select(*keys, "min_latency", "max_latency", "mean_latency", *[F.get("__sorted", i).alias(n) for n, i in index.items()])
    return totals.join(points, keys)


def service_stats(df: DataFrame, keys: Sequence[str], failed: Column, ts: str = "ts") -> DataFrame:
    """Requests, errors, error rate, time span and requests per second."""
    span = (F.unix_micros(F.max(F.col(ts).cast("timestamp"))) - F.unix_micros(F.min(F.col(ts).cast("timestamp")))) / 1e6
    out = df.groupBy(*keys).agg(F.count("*").alias("requests"), F.count_if(failed).alias("errors"), span.alias("uptime_seconds"))
    n = F.col("requests").cast("double")
    return out.withColumns({
        "error_rate": F.coalesce(F.try_divide(F.col("errors").cast("double"), n), F.lit(0.0)),
        "request_rate": F.coalesce(F.try_divide(n, F.col("uptime_seconds")), F.lit(0.0)),
    })


def counter_increases(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", ties: Sequence[str] = ()) -> DataFrame:
    """``increase`` of each sample over the one before it; a fall means that the counter restarted from zero."""
    out = with_previous(df, keys, ts, value, "__before", ties)
    v, p = F.col(value), F.col("__before")
    return out.withColumn("increase", F.when(p.isNull(), F.lit(0.0)).when(v < p, v).otherwise(v - p)).drop("__before")


def step_end(ts: str | Column, step: int) -> Column:
    """End of the half-open step (end - step, end] that holds a time, in seconds since the epoch."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.ceil(F.unix_micros(c.cast("timestamp")) / F.lit(step * 1000000.0)) * step


def sliding(df: DataFrame, keys: Sequence[str], seconds: int, step: int, partial: Mapping[str, Column],
            merge: Mapping[str, Column], ts: str = "ts") -> DataFrame:
    """Aggregates over (t - seconds, t] for every ``t`` on the step grid at which the window holds a sample.

    Samples are first reduced to one row per step (``partial``); only those rows are repeated into the windows that
    cover them and merged, so the repetition does not grow with the samples.
    """
    if seconds % step:
        raise ValueError("the window must be a multiple of the step")
    steps = df.withColumn("__end", step_end(ts, step)).groupBy(*keys, "__end").agg(*[c.alias(n) for n, c in partial.items()])
    ahead = F.transform(F.sequence(F.lit(0), F.lit(seconds // step - 1)), lambda i: F.col("__end") + i * step)
    spread = steps.withColumn("__at", F.explode(ahead))
    out = spread.groupBy(*keys, "__at").agg(*[c.alias(n) for n, c in merge.items()])
    return out.withColumn("eval_ts", F.timestamp_seconds("__at")).drop("__at")


def rate(increases: DataFrame, keys: Sequence[str], seconds: int = 300, step: int = 30, column: str = "increase", ts: str = "ts") -> DataFrame:
    """``increase`` and per-second ``rate`` over a sliding window of event increments."""
    out = sliding(increases, keys, seconds, step, {"__s": F.sum(column)}, {"increase": F.sum("__s")}, ts)
    return out.withColumn("rate", F.col("increase") / seconds)


def windowed_quantiles(df: DataFrame, keys: Sequence[str], bounds: Sequence[float], quantiles: Mapping[str, float],
                       seconds: int = 300, step: int = 30, value: str = "value", ts: str = "ts") -> DataFrame:
    """Bucket quantiles over a sliding window."""
    names = [f"__b{i}" for i in range(len(bounds) + 1)]
    out = sliding(df, keys, seconds, step, dict(zip(names, _bucket_counts(value, bounds))), {n: F.sum(n) for n in names}, ts)
    out = out.withColumn("__buckets", bucket_array([F.col(n) for n in names], bounds))
    return out.select(*keys, "eval_ts", *[bucket_quantile(F.col("__buckets"), q).alias(n) for n, q in quantiles.items()])


def ratio_in_one_pass(df: DataFrame, keys: Sequence[str], top: Column, bottom: Column, seconds: int, step: int, ts: str = "ts") -> DataFrame:
    """Ratio of two event rates with equal labels: both are counted in the same windows, without a join."""
    out = sliding(df, keys, seconds, step, {"__t": F.count_if(top), "__b": F.count_if(bottom)},
                  {"top": F.sum("__t"), "bottom": F.sum("__b")}, ts)
    return out.withColumn("ratio", F.try_divide(F.col("top").cast("double"), F.col("bottom").cast("double")))


def absence_periods(df: DataFrame, keys: Sequence[str], quiet: int, hold: int, ts: str = "ts", ties: Sequence[str] = (), as_of: Column | None = None) -> DataFrame:
    """Silences: no sample came for ``quiet`` seconds, and none for ``hold`` more.

    A series that is still silent at ``as_of`` (the latest sample of the table by default) has an open one, with null in
    ``resolved_at``; also a series of a single sample.
    """
    slim = df.select(*keys, *ties, F.col(ts).cast("timestamp").alias(ts))
    gaps = with_previous(slim, keys, ts, ts, "last_seen", ties).select(*keys, "last_seen", F.col(ts).alias("resolved_at"), F.col(ts).alias("until"))
    now = slim.agg(F.max(ts).alias("now")) if as_of is None else slim.agg(as_of.cast("timestamp").alias("now"))
    tails = slim.groupBy(*keys).agg(F.max(ts).alias("last_seen")).select(*keys, "last_seen", F.lit(None).cast("timestamp").alias("resolved_at"), now.scalar().alias("until"))
    silent = gaps.union(tails).where(F.unix_micros("until") - F.unix_micros("last_seen") >= (quiet + hold) * 1000000)
    return silent.select(
        *keys, "last_seen", (F.col("last_seen") + F.make_dt_interval(secs=F.lit(float(quiet)))).alias("pending_at"),
        (F.col("last_seen") + F.make_dt_interval(secs=F.lit(float(quiet + hold)))).alias("firing_at"), "resolved_at",
    )
